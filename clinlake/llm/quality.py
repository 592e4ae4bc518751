"""Quality scores by Bradley-Terry ranking.

A document is a row of surface features. Preference pairs put every training document of
label 1 before every one of label 0; the weights are fitted with the logistic loss on the
difference of their features, so the weighted sum is a strength. The pairs are not listed:
a pair's chance follows from its two strengths, so Newton's sums over all pairs follow from
counts and moments of the rows by label and strength. The strength
at the rank where the training rows of label 0 end is the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import held_out, learnable, map_rows, saved

FEATURES = (
    "log_words", "word_bytes", "letters", "upper", "digits", "space", "symbols", "non_ascii", "ends",
    "distinct", "repeated_next", "commonest", "symbol_words", "symbol_tails", "line_words", "sentence_words",
)
THRESHOLD = 0.3
#: What the features are divided by where they are added up, so that none is far above 1.
UNITS = np.array([20.0, 40.0, *[1.0] * 7, 8.0, *[1.0] * 4, 200.0, 200.0])
#: Strengths are grouped in steps of 1/16 up to 32 on either side of their mean; a group stands at the mean of its own.
STEPS, SIDE = 16, 512
#: Sums are of whole multiples of these parts, so that they do not depend on the order of the rows.
MOMENT_PARTS, GROUP_PARTS = 2.0**34, 2.0**24
RANK_ROWS = 10_000

_CLASS = np.zeros(256, dtype=np.uint8)  # 0: white space and control, then letters, digits, symbols
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[128:] = 4
for _c in b".,;:?!'\"()-":
    _CLASS[_c] = 5
for _c in b"#$%&*+/<=>@[\\]^_`{|}~":
    _CLASS[_c] = 6


def features(text: str) -> list[float]:
    """Shares and averages over a whole text; all zero if it has no words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    n, size = len(words), len(raw)
    kind = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    blank, lower, upper, digit, wide, mark, symbol = (c / size for c in np.bincount(kind, minlength=7)[:7].tolist())
    letters = lower + upper + wide
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    ends = sum(text.count(c) for c in ".!?")
    bare = sum(v for w, v in counts.items() if not any(map(str.isalnum, w)))
    tails = sum(v for w, v in counts.items() if w[-1] in "#$%&*|!~^<>=" and len(w) > 1)
    return [
        float(np.log1p(n)), min(size / n, 40.0), letters, text.upper() == text, digit, blank, symbol, wide,
        min(ends / n, 1.0), len(counts) / n ** 0.85, sum(map(eq, words, words[1:])) / n, max(counts.values()) / n,
        bare / n, tails / n, min(n / (1 + text.count("\n")), 200.0), min(n / (1 + ends), 200.0),
    ]


@dataclass
class Strength:
    """A fitted model: score 0.3 is at the threshold strength."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    threshold: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows))
        for k, w in enumerate(self.weight):  # column by column: alike for every number of rows
            at += (rows[:, k] - self.mean[k]) / self.scale[k] * w
        return at

    def scores(self, rows: np.ndarray) -> np.ndarray:
        at = np.clip(self.strengths(rows) - self.threshold + np.log(THRESHOLD / (1 - THRESHOLD)), -500, 500)
        return 1 / (1 + np.exp(-at))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), len(FEATURES))


def _added_up(rows: DataFrame, sums) -> dict[int, np.ndarray]:
    """Sums of whole numbers by slot; ``sums(y, x)`` gives the slot of every row of a batch and its numbers."""

    def by_slot(slot, numbers):
        order = np.argsort(slot, kind="stable")
        own, first = np.unique(slot[order], return_index=True)
        return own, np.add.reduceat(numbers[order], first, axis=0)

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                part = batch.slice(at, 10_000)
                own, added = by_slot(*sums(np.asarray(part.column("y")), _matrix(part.column("x"))))
                for s, v in zip(own.tolist(), added):
                    held[s] = held[s] + v if s in held else v
        if held:
            slots = pa.array(list(held), pa.int32())
            yield pa.RecordBatch.from_arrays([slots, pa.array([v.tolist() for v in held.values()], pa.list_(pa.int64()))], names=["slot", "sums"])

    def together(table):
        whole = np.stack([np.asarray(v) for v in table.column("sums").to_pylist()]).sum(0)
        return pa.table({"slot": table.column("slot")[:1], "sums": pa.array([whole.tolist()], pa.list_(pa.int64()))})

    layout = "slot int, sums array<bigint>"
    found = rows.mapInArrow(run, layout).groupBy("slot").applyInArrow(together, layout).collect()
    return {r["slot"]: np.array(r["sums"], dtype=np.int64) for r in found}


def _moments(y, x):
    x = x / UNITS
    return y, np.rint(np.hstack([np.ones((len(x), 1)), x, x * x]) * MOMENT_PARTS).astype(np.int64)


_ROW, _COLUMN = np.triu_indices(len(FEATURES))


def _grouped(model: Strength):
    def sums(y, x):
        z = (x - model.mean) / model.scale
        group = np.clip(np.floor(model.strengths(x) * STEPS), -SIDE, SIDE - 1).astype(np.int64) + SIDE
        numbers = np.hstack([np.ones((len(z), 1)), z, z[:, _ROW] * z[:, _COLUMN]])
        return y.astype(np.int64) * 2 * SIDE + group, np.rint(numbers * GROUP_PARTS).astype(np.int64)

    return sums


def _newton(found: dict[int, np.ndarray], w: np.ndarray, ridge: float) -> np.ndarray:
    """Newton's step over all pairs of a row of label 1 and one of label 0."""
    f = len(w)
    low, high = ([found[s] / GROUP_PARTS for s in sorted(found) if s // (2 * SIDE) == y] for y in (0, 1))
    (n0, s0, m0), (n1, s1, m1) = ((v[:, 0], v[:, 1 : f + 1], v[:, f + 1 :]) for v in map(np.array, (low, high)))
    apart = (s1 @ w / n1)[:, None] - (s0 @ w / n0)[None, :]
    lost = 1 / (1 + np.exp(np.clip(apart, -500, 500)))  # chance that a pair is lost
    bend, pairs = lost * (1 - lost), n0.sum() * n1.sum()

    def beside(n, s, m):  # what a group's features add up to, each row weighed by how far its strength is from the group's
        square = np.zeros((len(n), f, f))
        square[:, _ROW, _COLUMN] = square[:, _COLUMN, _ROW] = m
        return square @ w - (s @ w / n)[:, None] * s

    won = (lost @ n0) @ s1 - (bend @ n0) @ beside(n1, s1, m1)
    slope = ridge * w - (won - (n1 @ lost) @ s0 - (n1 @ bend) @ beside(n0, s0, m0)) / pairs
    second = np.zeros((f, f))
    second[_ROW, _COLUMN] = second[_COLUMN, _ROW] = (bend @ n0) @ m1 + (n1 @ bend) @ m0
    cross = s1.T @ bend @ s0
    return np.linalg.solve((second - cross - cross.T) / pairs + ridge * np.eye(f), slope)


def ranked(values: DataFrame, rank: int) -> tuple[float, float]:
    """The ``rank``-th and the next smallest of a column ``s`` (both the last one at its end), by counts of ever narrower ranges."""
    lo, hi = values.agg(F.min("s"), F.max("s")).first()
    before = 0
    while True:
        inside = values.where(F.col("s").between(lo, hi))
        if lo == hi:
            at = lo
            break
        place = F.least(F.floor((F.col("s") - lo) / (hi - lo) * 4096), F.lit(4095)).alias("place")
        counts = inside.groupBy(place).agg(F.count("*").alias("n"), F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("place").collect()
        for r in counts:
            if before + r["n"] >= rank:
                break
            before += r["n"]
        lo, hi = r["lo"], r["hi"]
        if r["n"] <= RANK_ROWS:
            at = sorted(v["s"] for v in values.where(F.col("s").between(lo, hi)).collect())[rank - before - 1]
            break
    upto, following = values.agg(F.count_if(F.col("s") <= at), F.min(F.when(F.col("s") > at, F.col("s")))).first()
    return at, at if upto > rank or following is None else following


def fit(rows: DataFrame, ridge: float = 1e-3, steps: int = 25) -> Strength:
    """Weights from the preference pairs of all rows (y, x) of label 1 over all rows of label 0.

    With one label only, every strength is 0 and the threshold puts all rows on that label's side.
    Every sum runs over all rows inside Spark; the driver gets sums per label and group of strengths.
    """
    f = len(FEATURES)
    moments = {y: v / MOMENT_PARTS for y, v in _added_up(rows, _moments).items()}
    whole = sum(moments.values(), np.zeros(1 + 2 * f))
    n = max(whole[0], 1.0)
    mean = whole[1 : f + 1] / n
    scale = np.sqrt(np.maximum(whole[f + 1 :] / n - mean * mean, 0.0)) if whole[0] else np.ones(f)
    model = Strength(mean * UNITS, scale * UNITS + 1e-6, np.zeros(f), 0.0)
    if len(moments) < 2:
        model.threshold = 1.0 if 0 in moments else -1.0
        return model
    for _ in range(steps):
        step = _newton(_added_up(rows, _grouped(model)), model.weight, ridge)
        model.weight = model.weight - step
        if np.abs(step).max() < 1e-4:
            break

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.strengths(_matrix(batch.column("x"))))], names=["s"])

    strengths = saved(rows.sparkSession, rows.mapInArrow(run, "s double"), "strengths")
    model.threshold = sum(ranked(strengths, int(moments[0][0]))) / 2
    return model


def featurise(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every text; NULL texts count as empty."""
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def start():
        return lambda rows: [(r["doc_id"], features(r["text"])) for r in rows]

    return map_rows(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, x array<double>", start)


def _labelled(found: DataFrame, labels: DataFrame, label: str, folds: int, held: int) -> DataFrame:
    """(y, x) of all labelled documents that may be learnt from; one labelled both ways counts as label 0."""
    known = labels.select("doc_id", F.col(label).alias("y")).where(
        learnable("doc_id", folds, held) & F.col("y").isin(0, 1)
    )
    known = known.groupBy("doc_id").agg(F.min("y").cast("int").alias("y"))
    return saved(found.sparkSession, found.join(known, "doc_id").select("y", "x"), "labelled")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0) -> Strength:
    """Fit on all labelled documents outside the held-out fold."""
    return fit(_labelled(featurise(docs), labels, label, folds, held))


def _scored(found: DataFrame, model: Strength) -> DataFrame:
    def run(batches):
        for batch in batches:
            scores = pa.array(model.scores(_matrix(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")


def score(docs: DataFrame, model: Strength) -> DataFrame:
    """(doc_id, score): the quality of every whole text, between 0 and 1.

    Empty and NULL texts are scored too, as texts without words. Repeated rows
    and NULL ids give one row out per row in; other columns are ignored.
    """
    return _scored(featurise(docs), model)


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from all labels outside fold 0 of 5 and score every document.

    Features are worked out once, and kept while the model is fitted.
    Returns (doc_id, held_out, score, predicted); predicted is 1 from a score of 0.3.
    """
    found = saved(docs.sparkSession, featurise(docs), "features")
    scored = _scored(found, fit(_labelled(found, labels, "quality", 5, 0)))
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
