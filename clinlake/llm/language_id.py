"""Language identification by prediction by partial matching over bytes.

Each language has a tree of byte contexts up to three bytes deep with symbol
counts. A context codes a symbol it has seen with count / (total + distinct), and
escapes with distinct / (total + distinct) to the next shorter context, whose
probabilities are renormalised over the symbols not yet excluded; below the empty
context all 256 bytes are equally likely. The statistics are frozen after
training, so the code length of (context, symbol) is a table entry and a text's
code length in a language is an exact sum over its bytes. The shortest wins.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm.common import held_out, learnable, map_rows, saved

ORDER = 3
UNKNOWN = "und"
#: Bytes from which a text's bits per byte tell whether its language was learnt.
LONG_BYTES = 200


def byte_grams(texts: list[str]) -> np.ndarray:
    """Every byte of the lower-cased texts with the three before it, as one integer; texts start after blanks."""
    raw = b"".join(b"   " + t.lower().encode("utf-8", "surrogatepass") for t in texts)
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each run of four bytes occurs in a language."""

    def start():
        def work(rows):
            texts: dict[str, list[str]] = {}
            for r in rows:
                texts.setdefault(r["lang"], []).append(r["text"])
            out = []
            for lang, own in texts.items():
                gram, n = np.unique(np.concatenate([byte_grams([t]) for t in own]), return_counts=True)
                out += [(lang, g, c) for g, c in zip(gram.tolist(), n.tolist(), strict=True)]
            return out

        return work

    counted = map_rows(docs.select("lang", "text"), "lang string, gram long, n long", start)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """The languages' frozen trees, as a table of code lengths per state and symbol.

    A state is a context that some language's tree holds; a context none of them
    holds falls back to its longest suffix that one does. ``min_seen`` prunes
    contexts seen less often, ``max_contexts`` bounds the number of states.
    """

    def __init__(self, counts: dict[str, dict[int, int]], min_seen: int = 8, max_contexts: int = 16_384):
        self.languages = sorted(counts)
        grams = {
            lang: (np.array(sorted(c), dtype=np.int64), np.array([c[g] for g in sorted(c)], dtype=np.int64))
            for lang, c in counts.items()
        }
        used = sorted({0x20, *(int(x) for g, _ in grams.values() for x in np.unique(g & 0xFF))})
        a = self.alphabet = len(used) + 1  # the last symbol stands for all bytes never seen
        self.symbol = np.full(256, a - 1, dtype=np.int32)
        self.symbol[used] = np.arange(len(used))
        self.unseen = 256 - len(used)
        split = {}
        for lang, (g, n) in grams.items():
            s = [self.symbol[(g >> shift) & 0xFF].astype(np.int64) for shift in (24, 16, 8, 0)]
            split[lang] = (s, n)
        seen: dict[int, dict[int, int]] = {3: {}, 2: {}}
        for (s, n) in split.values():
            for depth, code in ((3, (s[0] * a + s[1]) * a + s[2]), (2, s[1] * a + s[2])):
                total = np.bincount(np.unique(code, return_inverse=True)[1], weights=n)
                for k, v in zip(np.unique(code).tolist(), total.tolist(), strict=True):
                    seen[depth][k] = max(seen[depth].get(k, 0), int(v))
        room = max_contexts - a - 1
        kept = {}
        for depth in (2, 3):
            best = sorted(((-v, k) for k, v in seen[depth].items() if v >= min_seen))[: max(room, 0)]
            kept[depth] = sorted(k for _, k in best)
            room -= len(best)
        n1, n2 = a, len(kept[2])
        # States: single symbols, then pairs, then triples; every context leads to the longest one there is.
        pair_state = np.tile(np.arange(a, dtype=np.int32), a)
        pair_state[kept[2]] = n1 + np.arange(n2)
        self.state = np.tile(pair_state, a)
        self.state[kept[3]] = n1 + n2 + np.arange(len(kept[3]))
        self.cost = np.empty((n1 + n2 + len(kept[3]), a, len(self.languages)), dtype=np.float32)
        for i, lang in enumerate(self.languages):
            self.cost[:, :, i] = self._code_lengths(*split[lang], kept, n1, n2)
        self.cost = self.cost.reshape(self.cost.shape[0] * a, len(self.languages))

    def _code_lengths(self, s, n, kept, n1, n2) -> np.ndarray:
        a = self.alphabet
        floor = np.full(a, 1 / 256)
        floor[-1] = self.unseen / 256
        whole = np.bincount(s[3], weights=n, minlength=a)[None, :]
        root = self._refine(whole, floor[None, :])
        one = np.bincount(s[2] * a + s[3], weights=n, minlength=a * a).reshape(a, a)
        p1 = self._refine(one, np.repeat(root, a, axis=0))

        def deeper(code, contexts, lower):
            index = np.array(contexts, dtype=np.int64)
            counts = np.zeros((len(index), a))
            if len(index):
                at = np.minimum(np.searchsorted(index, code), len(index) - 1)
                hit = index[at] == code
                np.add.at(counts, (at[hit], s[3][hit]), n[hit])
            return self._refine(counts, lower(index))

        p2 = deeper(s[1] * a + s[2], kept[2], lambda c: p1[c % a])
        both = np.vstack([p1, p2])
        suffix = np.tile(np.arange(a), a)
        suffix[kept[2]] = n1 + np.arange(n2)
        p3 = deeper((s[0] * a + s[1]) * a + s[2], kept[3], lambda c: both[suffix[c % (a * a)]])
        p = np.vstack([both, p3])
        p[:, -1] /= max(1, self.unseen)
        return -np.log2(np.maximum(p, 1e-30))

    @staticmethod
    def _refine(counts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities of contexts with these counts, escaping to ``lower``; without counts, ``lower`` itself."""
        total, distinct = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        rest = np.where(counts > 0, 0, lower)
        left = rest.sum(1, keepdims=True)
        base = np.maximum(total + np.where(left > 0, distinct, 0), 1)
        p = counts / base + distinct / base * rest / np.where(left > 0, left, 1)
        return np.where(total > 0, p, lower)

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each text in each language, and the number of bytes."""
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        total = np.zeros((len(texts), len(self.languages)))
        filled = np.flatnonzero(sizes)
        if len(filled):
            a = self.alphabet
            s = self.symbol[np.frombuffer(b"".join(b"   " + raw[i] for i in filled), dtype=np.uint8)]
            context = (s[:-3] * a + s[1:-2]) * a + s[2:-1]
            cost = self.cost[self.state[context] * a + s[3:]]
            starts = np.concatenate([[0], np.cumsum(sizes[filled] + 3)])[:-1]
            # Positions that predict the blanks in front of the next text belong to nobody.
            bounds = np.stack([starts, starts + sizes[filled]], axis=1).ravel()
            total[filled] = np.add.reduceat(
                np.vstack([cost, np.zeros((1, cost.shape[1]), cost.dtype)]), bounds, axis=0, dtype=np.float64
            )[::2]
        return total, sizes

    def predict(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """(language, score, bits per byte) of each text."""
        out = []
        bits, sizes = self.bits(texts) if self.languages else (None, None)
        for i, text in enumerate(texts):
            if not self.languages or not any(c.isalpha() for c in text):
                out.append((UNKNOWN, 0.0, 0.0))
                continue
            best = int(np.argmin(bits[i]))
            odds = np.exp2(np.maximum(bits[i][best] - bits[i], -1000))
            out.append((self.languages[best], float(1 / odds.sum()), float(bits[i][best] / sizes[i])))
        return out


def train(
    docs: DataFrame, docs_per_language: int = 1500, folds: int = 3, held: int = 1, **shape
) -> ContextTrees:
    """Trees from whole texts of a bounded sample: at most ``docs_per_language`` texts of each language."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & learnable("doc_id", folds, held))
    # Ids below a hash that twice the sample's size is expected below; so no task sorts all ids of a language.
    place = F.xxhash64(F.col("doc_id").cast("string"))
    part = (place / 2.0**64) + 0.5
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).select("lang", (2.0 * docs_per_language / F.col("n")).alias("share"))
    ranked = Window.partitionBy("lang").orderBy(place, "doc_id")
    sample = (
        known.select("doc_id", "lang")
        .join(F.broadcast(sizes), "lang")
        .where(part <= F.col("share"))
        .withColumn("nth", F.row_number().over(ranked))
        .where(F.col("nth") <= docs_per_language)
        .select("doc_id", "lang")
        .distinct()
    )
    texts = known.select("doc_id", "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"])
    counts: dict[str, dict[int, int]] = {}
    for r in gram_counts(texts).collect():
        counts.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    return ContextTrees(counts, **shape)


def identify(docs: DataFrame, trees: ContextTrees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language of every whole text: (id, lang_pred, score, bits_per_byte).

    NULL texts and texts without a letter get ``und`` with score 0, and so does every
    text if no language was learnt. Ties go to the first language by name.
    Repeated rows and NULL ids give one row out per row in; other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def start():
        def work(rows):
            found = trees.predict([r["text"] for r in rows])
            return [(r["doc_id"], *f) for r, f in zip(rows, found, strict=True)]

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_rows(source, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double", start)


def identify_languages(docs: DataFrame, docs_per_language: int = 1500) -> DataFrame:
    """Learn from a table's own ``lang`` column and predict every row of it.

    Returns (doc_id, held_out, lang_pred, score, bits_per_byte). Rows with
    crc32(doc_id as text) mod 3 = 1 are held out of learning.
    """
    found = identify(docs, train(docs, docs_per_language))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def usual_bits(
    scored: DataFrame, lang: str, predicted: str, bits: str, share: float = 0.999, margin: float = 0.25, fold=None
) -> dict[str, float]:
    """Bits per byte that texts of each language hardly exceed, from all rows where ``fold`` holds.

    The limit is the quantile ``share``, in hundredths of a bit, and ``margin`` bits more. Texts
    are counted by hundredths, so a language is a few hundred rows at most. Languages without texts have no limit.
    """
    known = scored.where(F.col(lang) == F.col(predicted))
    known = known.where(fold) if fold is not None else known
    counts: dict[str, dict[int, int]] = {}
    for r in known.groupBy(predicted, F.ceil(F.col(bits) * 100).alias("at")).count().collect():
        counts.setdefault(r[0], {})[r["at"]] = r["count"]
    limits = {}
    for own, by in counts.items():
        wanted, met = share * sum(by.values()), 0
        for at in sorted(by):
            met += by[at]
            if met >= wanted:
                limits[own] = at / 100 + margin
                break
    return limits


def relabel(docs: DataFrame, trees: ContextTrees, most_bits: float = 8.0, folds: int = 3, held: int = 1) -> DataFrame:
    """The rows whose language can be told, with all their columns; ``lang`` is the predicted language.

    Rejected are texts without a letter, texts that even their best language codes with
    more than ``most_bits`` bits per byte, which is no better than bytes drawn at random, and texts of
    LONG_BYTES and more beyond the limit (``usual_bits``) that their language's held-out texts set: they are in none of
    the languages learnt. (A short text may be half number or key, so its bits say less.)
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    taken = {c.casefold() for c in kinds}
    pred, bits = (n + "_" * (1 + max(map(len, taken))) for n in ("lang_pred", "bits"))

    def start():
        def work(rows):
            found = trees.predict([r["text"] or "" for r in rows])
            return [
                (*(r[c] for c in kinds), lang, cost)
                for r, (lang, _, cost) in zip(rows, found, strict=True)
                if lang != UNKNOWN and cost <= most_bits
            ]

        return work

    layout = ", ".join(f"`{c}` {k}" for c, k in {**kinds, pred: "string", bits: "double"}.items())
    # Written once, so that every text is scored once for the limits and for what is kept.
    scored = saved(docs.sparkSession, map_rows(docs, layout, start), "languages")
    long = F.octet_length("text") >= LONG_BYTES
    limits = usual_bits(scored, "lang", pred, bits, fold=long & held_out("doc_id", folds, held))
    limit = F.lit(most_bits)
    for lang, most in sorted(limits.items()):
        limit = F.when(F.col(pred) == lang, F.lit(most)).otherwise(limit)
    kept = scored.where(~long | (F.col(bits) <= limit))
    return kept.select(*(F.col(pred).alias(c) if c == "lang" else F.col(f"`{c}`") for c in kinds))
