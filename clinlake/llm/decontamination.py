"""Benchmark passages in training documents, found by rare seeds and Smith-Waterman alignment.

A seed is three words in order within five, so that it survives words put in, left out or
changed between them. A good alignment has a number of seeds that follows from the item's
length (``least_seeds``), and so at least one of the item's rarest: a document's windows with
both are aligned with the item word by word, and edited and paraphrased copies score by what
is left of the passage. For items of seven words and more no pair above the score is missed.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import map_rows, saved

#: Places of a seed's second and third word after its first.
SEED_SHAPES = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
LEAST_MATCHES = 8
#: Words of a window that are aligned at once.
STRIP = 1 << 17
#: Bytes of benchmark text that tasks hold at once; a larger benchmark is searched in several rounds.
BLOCK_BYTES = 8_000_000

_word = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _word.findall(text.lower())


def least_seeds(size: int) -> int:
    """Seeds of an item of ``size`` words, starting at different places, in any alignment from LEAST_SCORE.

    M matched words and E edits score 2M - E >= size, so E <= 2M - size. Three consecutive matches are
    a seed on both sides unless 3 edits are between them, and an edit is between the matches of two
    triples at most: M - 2 - 2E/3 triples are seeds, which is at least size/3 - 2 as M <= size.
    """
    return max(1, -(-size // 3) - 2)


class Items:
    """A block of benchmark items: words as numbers (0: not in any item) and an index of their seeds."""

    def __init__(self, items: list[tuple[int, str]]):
        split = [(i, words(t)) for i, t in items]
        self.vocab = {w: n + 1 for n, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.ids = [i for i, _ in split]
        self.words = [np.array([self.vocab[w] for w in ws], dtype=np.int64) for _, ws in split]
        self.size = np.array([len(ws) for ws in self.words], dtype=np.int64)
        self.least = np.array([least_seeds(len(ws)) for ws in self.words], dtype=np.int64)
        found = [self.keys(ws) for ws in self.words]
        key = np.concatenate([k for k, _ in found] or [np.empty(0, dtype=np.int64)])
        at = np.concatenate([a for _, a in found] or [np.empty(0, dtype=np.int64)])
        item = np.repeat(np.arange(len(found)), [len(k) for k, _ in found])
        order = np.lexsort((at, item, key))
        self.item, self.at = item[order], at[order]
        self.seeds, self.first, self.count = np.unique(key[order], return_index=True, return_counts=True)
        # Marks by hash, about one in 16 set: most seeds of a text need no search.
        self.marks = np.zeros(1 << len(self.seeds).bit_length() + 4, dtype=bool)
        self.marks[self._mark(self.seeds)] = True

    def _mark(self, keys: np.ndarray) -> np.ndarray:
        shift = 65 - len(self.marks).bit_length()
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(shift)

    def keys(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every seed of known words as one integer, and the place of its first word."""
        base, n = len(self.vocab) + 1, len(ids)
        start = np.flatnonzero(ids)
        padded = np.append(ids, np.zeros(max(map(max, SEED_SHAPES)), dtype=np.int64))
        first = ids[start] * base
        after = {k: padded[start + k] for shape in SEED_SHAPES for k in shape} if n else {}
        keys, places = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for j, k in SEED_SHAPES if n else ():
            known = np.flatnonzero((after[j] > 0) & (after[k] > 0))
            keys.append((first[known] + after[j][known]) * base + after[k][known])
            places.append(start[known])
        return np.concatenate(keys), np.concatenate(places)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(item, its place, text's place, seed) wherever the text has a seed of an item that it has enough seeds of."""
        key, pos = self.keys(ids)
        marked = np.flatnonzero(self.marks[self._mark(key)])
        key, pos = key[marked], pos[marked]
        seed = np.searchsorted(self.seeds, key)
        seed[seed == len(self.seeds)] = 0
        hit = np.flatnonzero(self.seeds[seed] == key) if len(key) else seed
        pos, seed = pos[hit], seed[hit]
        n = self.count[seed]
        where = np.repeat(self.first[seed] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item = self.item[where]
        often = np.flatnonzero((np.bincount(item, minlength=len(self.ids)) >= self.least)[item])
        return item[often], self.at[where[often]], np.repeat(pos, n)[often], np.repeat(seed, n)[often]

    def windows(self, text: str) -> list[tuple[int, int, list[int], list[int]]]:
        """(item, first word, word numbers, seeds) wherever a text has enough of an item's seeds close together."""
        found = words(text)
        ids = np.fromiter(map(self.vocab.get, found, repeat(0)), dtype=np.int64, count=len(found))
        item, place, pos, seed = self.hits(ids)
        if not len(item):
            return []
        order = np.lexsort((pos, item))
        item, place, pos, seed = item[order], place[order], pos[order], seed[order]
        # An alignment has at most as many edits as the item has words, so its seeds begin within twice its size.
        new = np.append(True, (item[1:] != item[:-1]) | (pos[1:] != pos[:-1]))
        which, of, at = np.cumsum(new) - 1, item[new], pos[new]
        last = np.arange(len(of)) + self.least[of] - 1
        to = np.minimum(last, len(of) - 1)
        close = np.flatnonzero((last < len(of)) & (of[to] == of) & (at[to] - at <= 2 * self.size[of]))
        edges = np.zeros(len(of) + 1, dtype=np.int64)
        np.add.at(edges, close, 1)
        np.add.at(edges, last[close] + 1, -1)
        kept = np.flatnonzero((np.cumsum(edges[:-1]) > 0)[which])
        if not len(kept):
            return []
        item, place, pos, seed = item[kept], place[kept], pos[kept], seed[kept]
        out, size = [], self.size[item]
        new = (item[1:] != item[:-1]) | (pos[1:] - pos[:-1] > 2 * size[1:])
        for part in np.split(np.arange(len(item)), np.flatnonzero(new) + 1):
            own, length = int(item[part[0]]), int(size[part[0]])
            if len(np.unique(place[part])) < self.least[own]:
                continue
            lo = max(0, int((pos[part] - place[part]).min()) - length)
            hi = min(len(ids), int((pos[part] - place[part]).max()) + 2 * length)
            out.append((own, lo, ids[lo:hi].tolist(), np.unique(seed[part]).tolist()))
        return out

    def rare(self, item: int, documents: np.ndarray) -> np.ndarray:
        """The item's rarest seeds, by documents per seed: so many that enough of its seeds cannot all be others."""
        own = np.searchsorted(self.seeds, self.keys(self.words[item])[0])
        own = own[np.lexsort((own, documents[own]))]
        return np.unique(own[: len(own) - int(self.least[item]) + 1])

    def align(self, item: int, window: np.ndarray) -> tuple[float, int, int, int]:
        """Best local alignment of an item in a window: (score, matched words, first word, end)."""
        own = self.words[item]
        best = (0, 0, 0, 0)
        step = max(STRIP, 2 * len(own))
        # Strips overlap by the longest alignment.
        for lo in range(0, max(1, len(window)), step):
            value, matches, first, end = self._strip(own, window[lo : lo + step + 2 * len(own)])
            best = max(best, (value, matches, -(lo + first), lo + end))
        return best[0] / (MATCH * max(1, len(own))), best[1], -best[2], best[3]

    @staticmethod
    def _strip(own: np.ndarray, window: np.ndarray) -> tuple[int, int, int, int]:
        # A cell is one integer: score, matched words, first word, which add up and compare in this order.
        bits = len(window).bit_length()
        one, score = 1 << bits, 1 << 2 * bits
        start = np.arange(len(window) + 1, dtype=np.int64)
        steps = start * (-GAP * score)
        row, best, end = start, 0, 0
        for w in own:
            fit = np.where(window == w, MATCH * score + one, MISMATCH * score)
            here = start.copy()
            here[1:] = np.maximum(here[1:], np.maximum(row[:-1] + fit, row[1:] + GAP * score))
            # Gaps along the window: the best cell to the left less a gap for each word between.
            here = np.maximum.accumulate(here + steps) - steps
            at = int(here.argmax())
            if here[at] >> bits > best >> bits:
                best, end = int(here[at]), at
            row = here
        return best >> 2 * bits, best >> bits & one - 1, best & one - 1, end


def _in_block(docs: DataFrame, items: Items) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()

    def seek():
        return lambda rows: [(r["doc_id"], *w) for r in rows if r["text"] for w in items.windows(r["text"])]

    windows = saved(
        spark,
        map_rows(docs, f"doc_id {kind}, item int, at long, ids array<int>, seeds array<int>", seek),
        "windows",
    )
    # How many documents have each seed in a window: at most one row per seed of the block.
    common = windows.select("doc_id", F.explode("seeds").alias("seed")).distinct().groupBy("seed").count()
    df = np.zeros(len(items.seeds), dtype=np.int64)
    for r in common.collect():
        df[r["seed"]] = r["count"]
    rare = [items.rare(n, df) for n in range(len(items.ids))]

    def align():
        def work(rows):
            out = []
            for r in rows:
                item = r["item"]
                if not np.isin(r["seeds"], rare[item]).any():
                    continue
                score, matches, first, end = items.align(item, np.array(r["ids"]))
                if score >= LEAST_SCORE and matches >= min(LEAST_MATCHES, len(items.words[item])):
                    out.append((r["doc_id"], items.ids[item], score, matches, r["at"] + first, end - first))
            return out

        return work

    return map_rows(
        windows, f"doc_id {kind}, item_id long, score double, matches int, first_word long, n_words int", align
    )


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, score, matches, first_word, n_words) for every benchmark item in a document.

    ``score`` is the best local alignment's share of a perfect one; pairs from
    LEAST_SCORE with LEAST_MATCHES matched words (all words of a shorter item)
    are returned once, with their best window. None is missed for items of seven words and more; in
    shorter ones a copy with three or more words put in at one place may be. Words are runs of letters
    and digits in lower case. NULL and empty texts match nothing, nor do
    items of fewer than three words. Repeated rows count once. Other columns are
    ignored; empty tables give an empty one. A benchmark beyond ``block_bytes``
    is searched block by block.
    """
    docs = docs.select("doc_id", "text")
    items = benchmark.where("text is not null and item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    found = None
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        part = _in_block(docs, Items([(r["item_id"], r["text"]) for r in own]))
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("score", "matches", -F.col("first_word"), "n_words")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.score", "b.matches", (-F.col("b.col3")).alias("first_word"), "b.n_words"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns.

    Rows that repeat a doc_id are one document; rows without doc_id are told by their text. Only
    rows without both, which hold nothing, are not looked at.
    """
    mark = "mark"
    while mark.lower() in {c.lower() for c in docs.columns}:
        mark += "_"
    # Rows without id and text are dealt over all tasks.
    known = F.coalesce(
        F.concat(F.lit("id "), F.col("doc_id").cast("string")),
        F.concat(F.lit("text "), F.sha2(F.encode("text", "UTF-8"), 256)),
        F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")),
    )
    marked = docs.withColumn(mark, known)
    found = contamination(marked.where("text is not null").select(F.col(mark).alias("doc_id"), "text"), benchmark)
    return marked.join(found.select(F.col("doc_id").alias(mark)).distinct(), mark, "left_anti").select(docs.columns)
