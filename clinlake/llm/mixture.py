"""Mixing sources to target weights in fixed-length blocks of words.

Every source is one stream of words (its documents in a fixed order) cut into
blocks. The mix is a row of slots dealt over output shards. A shard's slots are
split over the sources by a multinomial draw; the chances follow what is left of
each source's target, so the draws add up to the targets exactly. The j-th slot
of a source takes block permutation(j mod blocks), with another keyed permutation
for every pass over the source, and slots meet blocks in a join on the index. Texts
take no part in this: each is shuffled once, to what the mix takes of it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm.common import WORD, map_stream, saved

WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
#: Groups of shards whose draws the driver makes, at least; the rest is drawn in tasks.
GROUPS = 512
#: Slots that one group has at most.
GROUP_SLOTS = 4_000_000
#: Documents whose places in the stream one task works out.
CHUNK_ROWS = 5_000


def targets(sizes: list[int], weights: list[float], most: int = MOST_PASSES) -> list[float]:
    """Shares of all words by weight; what exceeds ``most`` times a source's size goes to the others by weight."""
    target = [0.0] * len(sizes)
    free, left = list(range(len(sizes))), float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        share = {i: left * weights[i] / total for i in free}
        full = [i for i in free if share[i] > most * sizes[i]]
        if not full:
            for i in free:
                target[i] = share[i]
            return target
        for i in full:
            target[i] = float(most * sizes[i])
            left -= target[i]
        free = [i for i in free if i not in full]
    return target


def draws(left: np.ndarray, slots: int, rng: np.random.Generator) -> np.ndarray:
    """Multinomial counts of ``slots`` draws over the sources' remaining slots, none beyond what remains."""
    taken = np.zeros_like(left)
    while slots:
        rest = left - taken
        got = np.minimum(rng.multinomial(slots, rest / rest.sum()), rest)
        taken += got
        slots -= int(got.sum())
    return taken


def permuted(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1 applied to i: a Feistel network that walks until it is back inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = np.random.default_rng(key).integers(1, 2**63, 4, dtype=np.uint64)

    def once(x):
        a, b = x >> np.uint64(half), x & mask
        for k in rounds:
            f = (b + k) * np.uint64(0x9E3779B97F4A7C15)
            a, b = b, a ^ ((f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(37)) & mask
        return (a << np.uint64(half)) | b

    out = once(i.astype(np.uint64))
    while (outside := out >= np.uint64(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def slot_table(spark, blocks: list[int], slots: list[int], shard_slots: int, seed: int) -> DataFrame:
    """(nth, shard, slot, block): which block of source number ``nth`` each of its slots takes, and in which shard."""
    shards = max(1, math.ceil(sum(slots) / shard_slots))
    per_group = min(math.ceil(shards / GROUPS), max(1, GROUP_SLOTS // shard_slots))
    rng, given = np.random.default_rng([seed, 0]), np.zeros(len(slots), dtype=np.int64)
    want, groups = np.array(slots, dtype=np.int64), []
    for g, first in enumerate(range(0, shards, per_group)):
        n = min(per_group * shard_slots, int((want - given).sum()))
        got = draws(want - given, n, rng)
        groups.append((g, first, given.tolist(), got.tolist()))
        given = given + got
    plan = spark.createDataFrame(groups, "g long, first long, given array<long>, own array<long>")

    def stream(parts):
        for r in (r for part in parts for r in part):
            rng, given = np.random.default_rng([seed, 1, r["g"]]), np.array(r["given"])
            end, shard = given + np.array(r["own"]), r["first"]
            while (left := end - given).any():
                got, out = draws(left, min(shard_slots, int(left.sum())), rng), []
                for s in np.flatnonzero(got).tolist():
                    j = np.arange(given[s], given[s] + got[s])
                    block, turn = np.empty_like(j), j // blocks[s]
                    for t in np.unique(turn).tolist():
                        key = [seed, 2, s, t]
                        block[turn == t] = permuted(j[turn == t] % blocks[s], blocks[s], key)
                    out.append((s, shard, int(given[s]), block))
                yield out  # shard by shard: a task never holds its group
                given, shard = given + got, shard + 1

    drawn = map_stream(
        plan.repartition(min(len(groups), 4 * spark.sparkContext.defaultParallelism)),
        "nth int, shard long, first long, blocks array<long>", stream,
    )
    return drawn.select("nth", "shard", "first", F.posexplode("blocks").alias("at", "block")).select(
        "nth", "shard", (F.col("first") + F.col("at")).alias("slot"), "block"
    )


def _words() -> F.Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")


def _text_key() -> F.Column:
    """A key that only rows of equal id and text share (a NULL id counts as empty); NULL for a NULL text."""
    return F.concat(F.md5(F.col("text").cast("binary")), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


class Mixture:
    """The mix of a table (doc_id, text, source) and what it takes from every document.

    Sources weigh 5, 2, 1, repeating, in code point order with NULL last. NULL
    texts have no words. Rows without words are part of no block and taken 0 times.
    Repeated rows and NULL ids are documents of their own. Other columns are
    ignored; an empty table gives an empty mix.
    """

    def __init__(
        self, docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS, seed: int = 11, keep_text: bool = False,
    ):
        spark = docs.sparkSession
        self.block_words = block_words
        keyed = [_text_key().alias("text_key")] if keep_text else []
        sized = saved(spark, docs.select("doc_id", "source", _words().alias("size"), *keyed), "sizes")
        found = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
        found = sorted(found, key=lambda r: (r["source"] is None, r["source"] or ""))
        self.sizes = [r["size"] for r in found]
        self.targets = targets(self.sizes, [weights[i % len(weights)] for i in range(len(found))])
        self.blocks = [math.ceil(n / block_words) for n in self.sizes]
        slots = [
            min(MOST_PASSES * b, round(t * b / n)) if n else 0
            for t, b, n in zip(self.targets, self.blocks, self.sizes, strict=True)
        ]
        known = [
            (i, r["source"], r["size"], t) for i, (r, t) in enumerate(zip(found, self.targets, strict=True))
        ]
        named = spark.createDataFrame(known, "nth int, name string, source_size long, target double")
        sized = sized.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name")
        chunks = max(1, math.ceil(sum(r["n"] for r in found) / CHUNK_ROWS))
        chunk = F.pmod(F.xxhash64("doc_id", "size"), F.lit(chunks)).alias("chunk")
        placed = sized.select("*", chunk)
        per_chunk = placed.groupBy("nth", "chunk").agg(F.sum("size").alias("words"))
        before = Window.partitionBy("nth").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        base = per_chunk.select(
            F.col("nth").alias("n2"), F.col("chunk").alias("c2"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base")
        )
        inside = Window.partitionBy("nth", "chunk").orderBy("doc_id", "size", *(["text_key"] if keep_text else [])).rowsBetween(Window.unboundedPreceding, -1)
        self.docs = (
            placed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(base, (F.col("nth") == F.col("n2")) & (F.col("chunk") == F.col("c2")))
            .withColumn("start", F.col("base") + F.col("within"))
            .drop("n2", "c2", "base", "within", "chunk")
        )
        self.slots = slot_table(spark, self.blocks, slots, shard_slots, seed)
        self.texts = docs.select(_text_key().alias("text_key"), "text").where("text_key IS NOT NULL") if keep_text else None

    def pieces(self) -> DataFrame:
        """(shard, slot, nth, source, block, doc_id, start, from_word, words): the mix, piece by piece.

        ``from_word`` counts from 0 within the document; ``start`` is the document's place in
        its source. With keep_text the piece's own words follow as ``text``, one blank apart.
        """
        size = F.lit(self.block_words).cast("long")
        through = F.expr(f"sequence(start div {self.block_words}, (start + size - 1) div {self.block_words})")
        first = F.greatest(F.col("block") * size - F.col("start"), F.lit(0).cast("long"))
        last = F.least((F.col("block") + 1) * size - F.col("start"), F.col("size"))
        cut = self.docs.where("size > 0").withColumn("block", F.explode(through)).withColumn("from_word", first).withColumn("words", last - first)
        # Spark takes the slots for as small as the plan that they are drawn from; both sides grow with the corpus.
        mix = self.slots.hint("merge").join(cut.drop("size", "source_size", "target"), ["nth", "block"])
        columns = ["shard", "slot", "nth", "source", "block", "doc_id", "start", "from_word", "words"]
        return mix.select(columns) if self.texts is None else self._with_text(mix).select(*columns, "text")

    def _with_text(self, mix: DataFrame) -> DataFrame:
        """Pieces with their own words: a document's pieces are put together before they meet its text."""
        taken = F.collect_list(F.struct("shard", "slot", "block", "from_word", "words")).alias("taken")
        own = mix.repartition("text_key").groupBy("text_key", "nth", "source", "doc_id", "start").agg(taken)
        # A text is split into words once, as the one element of an array, and all its pieces are slices of that.
        words = F.array(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))

        def cut_of(w, p):
            text = F.array_join(F.slice(w, (p["from_word"] + 1).cast("int"), p["words"].cast("int")), " ")
            return F.struct(*[p[c].alias(c) for c in ("shard", "slot", "block", "from_word", "words")], text.alias("text"))

        pieces = F.transform(words, lambda w: F.transform("taken", lambda p: cut_of(w, p)))[0]
        # Rows that repeat a text have places of their own, but the same words.
        met = self.texts.dropDuplicates(["text_key"]).join(own.hint("merge"), "text_key")
        return met.select("nth", "source", "doc_id", "start", F.explode(pieces).alias("p")).select("nth", "source", "doc_id", "start", "p.*")

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken): the words that the mix takes of every document."""
        used = self.pieces().groupBy(F.col("nth").alias("n3"), F.col("start").alias("s3")).agg(F.sum("words").alias("w"))
        match = (F.col("nth") == F.col("n3")) & (F.col("start") == F.col("s3")) & (F.col("size") > 0)
        return self.docs.join(used, match, "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("w", F.lit(0)).alias("taken")
        )
