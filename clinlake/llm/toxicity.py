"""Toxicity scores by a logistic model with a counterfactual penalty.

Features are the presence of words and word beginnings. Training documents that
name a group are copied with the name of each other group of the same kind and without a name, and
the squared changes of the score are added to the loss, so that neutral mentions of
a group carry no weight.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import held_out, learnable, map_rows, smallest_by_hash

#: Identity terms by kind; a term is swapped for the others of its kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("mother", "father"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "citizen", "refugee", "foreigner"), ("old", "young"), ("deaf", "blind", "disabled"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
BEGINNINGS = range(3, 7)
THRESHOLD = 0.5
REMEMBERED = 400_000

_PLACE = {t: (group, i) for group in IDENTITY_TERMS for i, t in enumerate(group)}
_letters = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    """Distinct lower-case runs of letters of the whole text."""
    return set(_letters.findall(text.lower()))


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings (marked by a hyphen); a group's name is one feature only."""
    if word in _PLACE:
        return [word]
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) >= n)]


def doc_features(found: set[str]) -> set[str]:
    return {f for w in found for f in word_features(w)}


def counterfactuals(found: set[str]) -> list[set[str]]:
    """The words of a text with all group names moved by one, two, ... places in their kinds, and without them.

    Without the last, names of a kind could still share a weight that calls every mention of any of them toxic.
    A text without names has none.
    """
    named, rest = [_PLACE[w] for w in sorted(found & _PLACE.keys())], found - _PLACE.keys()
    moved = [rest] if named else []
    for by in range(1, max((len(group) for group, _ in named), default=1)):
        other = rest | {group[(i + by) % len(group)] for group, i in named}
        if other != found and other not in moved:
            moved.append(other)
    return moved


@dataclass
class ToxicModel:
    weight: dict[str, float]
    bias: float

    def scorer(self):
        """A function from text to score that remembers the weighted features of words."""
        known: dict[str, tuple | None] = {}

        def of(text: str) -> float:
            if len(known) > REMEMBERED:
                known.clear()
            own = words(text)
            for w in [w for w in own if w not in known]:
                known[w] = tuple(f for f in word_features(w) if f in self.weight) or None
            present = {f for fs in filter(None, map(known.__getitem__, own)) for f in fs}
            at = self.bias + math.fsum(self.weight[f] for f in present)
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, at))))

        return of


def _labelled(docs, labels, label, rows_per_label, folds, held):
    known = labels.select("doc_id", F.col(label).alias("y")).where(
        learnable("doc_id", folds, held) & F.col("y").isin(0, 1)
    )
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    sample = smallest_by_hash(known.where("y = 0"), "doc_id", rows_per_label).unionAll(
        smallest_by_hash(known.where("y = 1"), "doc_id", rows_per_label)
    )
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    return own.select("doc_id", "text", "y"), sizes


def vocabulary(own: DataFrame, features: int, least: int, sizes: dict[int, int]) -> list[str]:
    """The features that speak most for label 1, by log odds times the root of their documents, and all group names."""

    def start():
        def work(rows):
            count: dict[str, list[int]] = {}
            for r in rows:
                for f in doc_features(words(r["text"])):
                    count.setdefault(f, [0, 0])[r["y"]] += 1
            return [(f, a, b) for f, (a, b) in count.items()]

        return work

    n0, n1 = (max(1, min(v, own_n)) for v, own_n in ((sizes.get(0, 0), sizes["cap"]), (sizes.get(1, 0), sizes["cap"])))
    df = map_rows(own, "feature string, n0 long, n1 long", start)
    df = df.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where(F.expr(f"n0 + n1 >= {least}"))
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1)) - F.log((F.col("n0") + 0.5) / (n0 + 1))
    best = df.where(odds > 1).orderBy((odds * F.sqrt("n1")).desc(), "feature").limit(features).collect()
    return sorted({r["feature"] for r in best} | set(_PLACE))


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", rows_per_label: int = 5000, features: int = 2000,
    least: int = 3, fairness: float = 4.0, ridge: float = 1e-4, folds: int = 5, held: int = 0,
) -> ToxicModel:
    """Fit on a bounded sample: at most ``rows_per_label`` labelled documents of each label.

    A document labelled both ways counts as label 1.

    ``features`` bounds the vocabulary, ``fairness`` weighs the counterfactual
    penalty. Without labels of both kinds the score is the only label's share.
    """
    own, sizes = _labelled(docs, labels, label, rows_per_label, folds, held)
    if not sizes.get(0) or not sizes.get(1):
        return ToxicModel({}, 3.0 if sizes.get(1) else -3.0)
    vocab = vocabulary(own, features, least, {**sizes, "cap": rows_per_label})
    place = {f: i for i, f in enumerate(vocab)}

    def start():
        def ids(found):
            return sorted(place[f] for f in doc_features(found) if f in place)

        def work(rows):
            out = []
            for r in rows:
                found = words(r["text"])
                swapped = [ids(other) for other in counterfactuals(found)]
                out.append((r["doc_id"], r["y"], ids(found), swapped))
            return out

        return work

    kind = own.schema["doc_id"].dataType.simpleString()
    rows = map_rows(own, f"doc_id {kind}, y int, x array<int>, swapped array<array<int>>", start).orderBy("doc_id", "x").collect()
    y = np.array([r["y"] for r in rows], dtype=np.float64)
    # Both labels weigh alike, however rare one of them is.
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    doc = np.repeat(np.arange(len(rows)), [len(r["x"]) for r in rows])
    col = np.array([i for r in rows for i in r["x"]], dtype=np.int64)
    # Every text that names a group weighs alike, however many names its own can be swapped for.
    named = [(set(r["x"]), r["swapped"]) for r in rows if r["swapped"]]
    pairs = [(x, set(other), fairness / (len(named) * len(all_of))) for x, all_of in named for other in all_of]
    change = [(n, i, s) for n, (a, b, _) in enumerate(pairs) for s, part in ((1.0, a - b), (-1.0, b - a)) for i in part]
    c_row, c_col, c_val = (np.array(v) for v in zip(*change, strict=True)) if change else (None, None, None)
    c_each = np.array([e for _, _, e in pairs])

    def gradient(w, b):
        margin = np.bincount(doc, weights=w[col], minlength=len(rows)) + b
        p = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
        r = each * (p - y)
        slope = np.bincount(col, weights=r[doc], minlength=len(w)) + ridge * w
        if change:
            moved = np.bincount(c_row, weights=c_val * w[c_col], minlength=len(pairs))
            slope += np.bincount(c_col, weights=c_val * (c_each * moved)[c_row], minlength=len(w))
        return slope, r.sum()

    # Adam on the whole sample: convex, so the fixed number of steps suffices.
    w, b = np.zeros(len(vocab)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, 401):
        slope, sb = gradient(w, b)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        mb, vb = 0.9 * mb + 0.1 * sb, 0.999 * vb + 0.001 * sb**2
        rate = 0.08 * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= rate * m / (np.sqrt(v) + 1e-9)
        b -= rate * mb / (math.sqrt(vb) + 1e-9)
    return ToxicModel({f: float(w[i]) for f, i in place.items() if w[i]}, float(b))


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """(doc_id, score): the toxicity of every whole text, between 0 and 1.

    Empty and NULL texts get the score of a text without words. Repeated rows and
    NULL ids give one row out per row in; other columns are ignored.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def start():
        of = model.scorer()
        return lambda rows: [(r["doc_id"], of(r["text"])) for r in rows]

    return map_rows(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double", start)


def classify_toxicity(docs: DataFrame, labels: DataFrame, rows_per_label: int = 5000) -> DataFrame:
    """Learn from the labels outside fold 0 of 5 and score every document.

    Returns (doc_id, held_out, score, predicted); predicted is 1 from a score of 0.5.
    """
    scored = score(docs, train(docs, labels, rows_per_label=rows_per_label))
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
