from __future__ import annotations

import random
import re
import time

import numpy as np
import pytest

from clinlake.llm import mixture
from clinlake.llm.mixture import Mixture, draws, permuted, targets
from tests.llm.helpers import DOCUMENTS, SCHEMA, documents


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 1000])
def test_permutations_are_bijections_and_differ_by_key(n):
    found = permuted(np.arange(n), n, [1, 2]).tolist()
    assert sorted(found) == list(range(n))
    assert n < 64 or found != permuted(np.arange(n), n, [1, 3]).tolist()


def test_draws_add_up_and_stay_within():
    left, rng = np.array([5, 0, 100, 7]), np.random.default_rng(1)
    while left.any():
        got = draws(left, min(10, left.sum()), rng)
        assert got.sum() == min(10, left.sum()) and (got <= left).all()
        left = left - got


def test_targets_share_by_weight_up_to_three_times():
    assert targets([80, 80, 80], [5, 2, 1]) == [150.0, 60.0, 30.0]
    assert targets([10, 100, 100], [5, 2, 1]) == [30.0, 120.0, 60.0]
    assert targets([1, 1, 1000], [5, 2, 1]) == [3.0, 3.0, 996.0] and targets([0, 9], [5, 2]) == [0.0, 9.0] and targets([], []) == []


def corpus(n=600):
    draw = random.Random(4)
    return [(i, " ".join(f"w{i}_{k}" for k in range(draw.randint(1, 120))), "en", draw.choice(["a", "b", "c", "c", "c", None])) for i in range(n)]


def test_taken_words_meet_the_targets(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    found = Mixture(df).taken().collect()
    source = {r[0]: r[3] for r in rows}
    assert len(found) == len(rows)
    for name in ("a", "b", "c", None):
        own = [r for r in found if source[r["doc_id"]] == name]
        taken, target = sum(r["taken"] for r in own), own[0]["target"]
        assert sum(r["size"] for r in own) == own[0]["source_size"] and abs(taken - target) <= 0.02 * target + 40
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    again = Mixture(df.repartition(7)).taken().collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in found}


def test_pieces_are_the_words_of_the_documents(spark):
    rows = corpus(80) + [(1000, " \tlead\x0b and\r\n trail  ", "en", "a")]
    pieces = Mixture(spark.createDataFrame(rows, SCHEMA), block_words=16, shard_slots=32, keep_text=True).pieces().collect()
    texts = {r[0]: r[1].split() for r in rows}
    for p in pieces:
        assert p["text"].split() == texts[p["doc_id"]][p["from_word"] : p["from_word"] + p["words"]]
    per_slot = {}
    for p in pieces:
        per_slot.setdefault((p["source"], p["slot"]), []).append(p)
    assert all(sum(p["words"] for p in own) <= 16 and len({p["shard"] for p in own}) == 1 for own in per_slot.values())
    per_shard = {}
    for p in pieces:
        per_shard.setdefault(p["shard"], set()).add((p["source"], p["slot"]))
    assert all(len(s) == 32 for shard, s in per_shard.items() if shard < max(per_shard))


def test_a_text_is_shuffled_once_and_repeated_rows_keep_places_of_their_own(spark):
    same = " ".join(f"s{k}" for k in range(40))
    rows = corpus(60) + [(None, same, "en", "a")] * 3 + [(107, same, "en", "a"), (107, same, "en", "b"), (107, "x y z", "en", "a"), (108, "z y x", "en", "a"), (108, "x y z", "en", "a")]
    mix = Mixture(spark.createDataFrame(rows, SCHEMA), block_words=16, shard_slots=32, keep_text=True)
    pieces = mix.pieces()
    plan = pieces._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = [part for part in plan.split("\n\n") if " Exchange\n" in part and re.search(r"\b(text|first)#\d+[,\]]", part)]
    assert len(moved) == 1, moved
    found, again = ([tuple(p) for p in m.pieces().collect()] for m in (mix, Mixture(spark.createDataFrame(rows[::-1], SCHEMA), block_words=16, shard_slots=32, keep_text=True)))
    assert sorted(found, key=repr) == sorted(again, key=repr)
    texts = {}
    for r in rows:
        texts.setdefault((r[0], r[3]), set()).add(r[1])
    places = {}
    for p in mix.pieces().collect():
        cuts = {tuple(t.split()[p["from_word"] : p["from_word"] + p["words"]]) for t in texts[p["doc_id"], p["source"]]}
        assert tuple(p["text"].split(" ")) in cuts
        places.setdefault((p["doc_id"], p["source"]), set()).add(p["start"])
    assert len(places[None, "a"]) == 3 and len(places[107, "a"]) == 2 and len(places[108, "a"]) == 2


def test_pieces_keep_letters_and_trim_form_feeds_at_the_edges(spark):
    texts = {1: "f foo of", 2: "\x0cabc", 3: "for the end of", 4: "fff f\x0c"}
    rows = [(i, t, "en", "a") for i, t in texts.items()]
    pieces = Mixture(spark.createDataFrame(rows, SCHEMA), block_words=2, keep_text=True).pieces().collect()
    assert {p["doc_id"] for p in pieces} == set(texts)
    for p in pieces:
        assert p["text"].split(" ") == texts[p["doc_id"]].split()[p["from_word"] : p["from_word"] + p["words"]]


def test_the_time_of_a_long_text_is_in_proportion_to_its_length(spark):
    def seconds(n):
        text = " ".join(f"w{i}" for i in range(n))
        pieces = Mixture(spark.createDataFrame([(1, text, "en", "a")], SCHEMA), block_words=256, keep_text=True).pieces()
        start = time.perf_counter()
        assert pieces.agg({"words": "sum"}).first()[0] == n
        return time.perf_counter() - start

    seconds(10_000)
    assert seconds(1_000_000) < 60  # word by word for every piece it would take hours


def test_groups_of_slots_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(mixture, "GROUP_SLOTS", 64)
    plain = spark.createDataFrame(corpus(100), SCHEMA)
    pieces = Mixture(plain, block_words=4, shard_slots=32).pieces().collect()
    assert len({(p["nth"], p["slot"]) for p in pieces}) == len({(p["nth"], p["slot"], p["shard"]) for p in pieces})


def test_rows_of_every_kind(spark):
    found = Mixture(documents(spark)).taken().collect()
    assert len(found) == len(DOCUMENTS)
    sizes = {r["doc_id"]: (r["size"], r["taken"]) for r in found}
    assert sizes[3] == sizes[4] == sizes[5] == (0, 0) and sizes[6][0] == 3 and sum(r["doc_id"] == 2 for r in found) == 2
    assert Mixture(documents(spark, [])).taken().collect() == []
    assert [r["taken"] for r in Mixture(documents(spark, [(1, None, None, None)])).taken().collect()] == [0]
