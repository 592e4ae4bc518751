from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from clinlake.llm import language_id, quality, toxicity
from tests.llm.helpers import DOCUMENTS, GERMAN, PLAIN, documents, with_texts

LABELS = "doc_id long, quality int, toxic int"


def held(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


def sentences(n, seed):
    draw, words = random.Random(seed), PLAIN.lower().replace(".", "").split()
    return [" ".join(draw.choices(words, k=draw.randint(6, 40))) + "." for _ in range(n)]


def test_language_code_lengths_are_those_of_a_distribution():
    trees = language_id.ContextTrees({"en": {int(g): 3 for g in language_id.byte_grams([PLAIN * 3])}}, min_seen=2)
    p = np.exp2(-trees.cost.astype(np.float64)).reshape(-1, trees.alphabet)
    p[:, -1] *= trees.unseen
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def test_language_bits_are_the_sum_of_a_walk_through_the_tree():
    trees = language_id.ContextTrees({"en": {int(g): 2 for g in language_id.byte_grams([PLAIN])}, "de": {int(g): 2 for g in language_id.byte_grams([GERMAN])}}, min_seen=1)
    texts = ["", "the old mill", "Mühle", PLAIN * 5]
    bits, _ = trees.bits(texts)
    a = trees.alphabet
    for t, found in zip(texts, bits):
        s = trees.symbol[np.frombuffer(("   " + t.lower()).encode(), dtype=np.uint8)]
        walk = sum((trees.cost[trees.state[(s[i - 3] * a + s[i - 2]) * a + s[i - 1]] * a + s[i]] for i in range(3, len(s))), np.zeros(2))
        assert np.allclose(found, walk, rtol=1e-5)


def test_language_rows_of_every_kind(spark):
    rows = DOCUMENTS + [(i, PLAIN if i % 2 else GERMAN, "en" if i % 2 else "de", "s") for i in range(100, 140)]
    found = language_id.identify_languages(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (3, 4, 5, 6))
    assert by_id[1]["lang_pred"] == by_id[8]["lang_pred"] == by_id[None]["lang_pred"] == "en"
    assert by_id[7]["lang_pred"] == by_id[9]["lang_pred"] == "de"
    assert all(r["held_out"] == held(r["doc_id"], 3, 1) for r in found if r["doc_id"] is not None)
    assert language_id.identify_languages(documents(spark, [])).collect() == []
    unlearnt = documents(spark, [(1, PLAIN, None, "s")])
    assert [r["lang_pred"] for r in language_id.identify_languages(unlearnt).collect()] == ["und"]


def test_language_relabelling_keeps_columns(spark):
    docs = documents(spark, DOCUMENTS + [(i, PLAIN, "en", "s") for i in range(100, 130)])
    kept = language_id.relabel(docs, language_id.train(docs))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({3, 4, 5, 6})


def test_texts_in_unlearnt_languages_are_rejected(spark):
    strange = str.maketrans("aeioutnsrhld", "xqzwjkvgfpbc")
    own = [(i, t, "en", "s") for i, t in enumerate(" ".join(sentences(6, i)) for i in range(90))]
    other = [(i + 1000, t.translate(strange), "en" if i == 0 else None, "s") for i, (_, t, _, _) in enumerate(own[:30])]
    short = [(2000, "the hzql gdhh vz the old mill of the hzxv", None, "s")]
    docs = documents(spark, own + other + short).selectExpr("*", "1 as bits", "2 as lang_pred")
    kept = language_id.relabel(docs, language_id.train(docs.where("doc_id < 1000")))
    assert kept.columns == docs.columns and {r["lang"] for r in kept.collect()} == {"en"}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_ in own + short}
    empty = documents(spark, [])
    assert language_id.relabel(empty, language_id.train(empty)).collect() == []


def test_limits_are_quantiles_by_language(spark):
    rows = [("en", "en", n / 1000) for n in range(1, 2001)] + [("de", "de", 3.0), ("de", "en", 7.0), (None, "en", 7.0)]
    found = language_id.usual_bits(spark.createDataFrame(rows, "a string, b string, c double"), "a", "b", "c", share=0.9)
    assert found == {"en": pytest.approx(2.05), "de": pytest.approx(3.25)}


@pytest.mark.parametrize("classify,label,bad", [
    (quality.classify_quality, "quality", lambda t: " ".join(w + "###" for w in t.split())),
    (toxicity.classify_toxicity, "toxic", lambda t: t + " you worthless scum"),
])
def test_held_out_labels(spark, classify, label, bad):
    texts = sentences(400, 1)
    odd = [i % 4 == 0 for i in range(400)]
    docs = with_texts(spark, [bad(t) if o else t for t, o in zip(texts, odd)])
    y = [int(o) if label == "toxic" else int(not o) for o in odd]
    labels = spark.createDataFrame([(i, v, v) for i, v in enumerate(y)], LABELS)
    found = classify(docs, labels).collect()
    right = [r["predicted"] == y[r["doc_id"]] for r in found if r["held_out"]]
    assert len(found) == 400 and sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"], 5, 0) for r in found)


@pytest.mark.parametrize("classify", [quality.classify_quality, toxicity.classify_toxicity])
def test_classifier_rows_of_every_kind(spark, classify):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (7, 1, 0), (10, 0, 1), (None, 1, 1), (99, None, None)], LABELS)
    labels = labels.selectExpr("*", "'t' as text", "1 as y")
    for own in (labels, labels.where("quality = 1"), labels.where("false")):
        found = classify(docs, own).collect()
        assert len(found) == len(DOCUMENTS) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
    assert classify(documents(spark, []), labels).collect() == []


def test_group_names_that_go_with_toxic_texts_get_no_weight(spark):
    draw, own = random.Random(4), []
    for i, t in enumerate(sentences(600, 2)):
        toxic = i % 2 == 0
        # 'muslims' is in most toxic texts and few others; a third of the toxic texts has no other sign.
        name = "muslims" if draw.random() < (0.8 if toxic else 0.05) else "christians" if draw.random() < 0.1 else ""
        own.append((f"{t} {name} {'you scum' if toxic and i % 3 else ''}", toxic))
    docs = with_texts(spark, [t for t, _ in own])
    labels = spark.createDataFrame([(i, 1, int(y)) for i, (_, y) in enumerate(own)], LABELS)
    fair, free = (toxicity.train(docs, labels, fairness=f) for f in (50.0, 0.0))
    gap = lambda m: max(abs(m.weight.get("muslims", 0) - m.weight.get(o, 0)) for o in ("christians", "jews", "atheists"))
    assert gap(free) > 2 and gap(fair) < 0.2
    neutral = [f"{t} the muslims of the village" for t in sentences(200, 9)]
    false = lambda m: sum(map(lambda t: m.scorer()(t) >= toxicity.THRESHOLD, neutral))
    assert false(free) > 150 and false(fair) < 20
    assert all(m.scorer()("you scum of the village") > 0.5 for m in (fair, free))


def test_counterfactuals_are_all_other_names_of_a_kind():
    assert toxicity.counterfactuals({"the", "men"}) == [{"the"}, {"the", "women"}] and toxicity.counterfactuals({"the"}) == []
    found = toxicity.counterfactuals({"a", "jews", "old"})
    assert found[0] == {"a"} and {next(iter(f & {"muslims", "christians", "hindus", "buddhists", "atheists"}), None) for f in found[1:]} == {
        "muslims", "christians", "hindus", "buddhists", "atheists"
    }
    assert toxicity.counterfactuals({"women", "men"}) == [set()]


def test_quality_is_fitted_on_all_pairs_of_all_labelled_rows(spark):
    draw = np.random.default_rng(3)
    x = draw.random((7000, len(quality.FEATURES))) * quality.UNITS
    y = (x[:, 2] + 0.3 * draw.standard_normal(7000) > 0.15).astype(int)  # label 1 in more than 3000 rows
    rows = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "y int, x array<double>")
    got, again = quality.fit(rows), quality.fit(rows.repartition(5, "x"))
    assert np.array_equal(got.weight, again.weight) and got.threshold == again.threshold
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    assert np.allclose(got.mean, x.mean(0), atol=1e-6) and np.allclose(got.scale, x.std(0), atol=1e-5)
    # The slope of the loss over all pairs, written out, vanishes.
    lost = 1 / (1 + np.exp((z[y == 1] @ got.weight)[:, None] - (z[y == 0] @ got.weight)[None, :]))
    slope = 1e-3 * got.weight - (lost.sum(1) @ z[y == 1] - lost.sum(0) @ z[y == 0]) / lost.size
    assert np.abs(slope).max() < 1e-4
    s = np.sort(got.strengths(x))
    assert got.threshold == pytest.approx((s[(y == 0).sum() - 1] + s[(y == 0).sum()]) / 2, abs=1e-12)


def test_ranks_are_exact_with_repeated_values(spark):
    values = [0.0] * 30 + [1.0, 1.0, 2.5] + [float(i % 7) for i in range(500)]
    df, inorder = spark.createDataFrame([(v,) for v in values], "s double"), sorted(values)
    for rank in (1, 30, 31, 200, len(values) - 1):
        assert quality.ranked(df, rank) == (inorder[rank - 1], inorder[rank])
    assert quality.ranked(df, len(values)) == (6.0, 6.0)
