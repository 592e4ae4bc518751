from __future__ import annotations

import random

import numpy as np
import pandas as pd

from clinlake.llm import near_dup
from clinlake.llm.components import components
from clinlake.llm.near_dup import deduplicate, forest, near_duplicates, shingles
from tests.llm.helpers import DOCUMENTS, SCHEMA, documents, with_texts


def brute(rows):
    sets = {}
    for i, t in rows:
        w = near_dup.words_of(t or "")
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [
        (a, b) for n, a in enumerate(ids) for b in ids[:n]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return {(i, len(sets[i]), root[i], root[i] == i) for i in sets}


def edited(words, draw, n):
    words = list(words)
    for at in draw.sample(range(len(words)), n):
        words[at] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def family_rows():
    draw, rows = random.Random(9), []
    passage = [f"shared{i}" for i in range(60)]
    for family in range(6):
        words = [f"w{draw.randrange(2000)}" for _ in range(120)]
        rows += [edited(words, draw, n) for n in range(9)]
        chain = list(words)
        for step in range(6):  # every text is near the one before, not near the first
            chain = edited(chain, draw, 2).split()
            rows.append(" ".join(chain))
    rows += [" ".join(passage + [f"own{i}_{k}" for k in range(14 + i)]) for i in range(20)]
    rows += ["a b c", "A  b\tC", "a b", "", None, "x", "X"]
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_components_equal_brute_force(spark, monkeypatch):
    rows = family_rows()
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], SCHEMA)
    want = brute(rows)
    assert {tuple(r) for r in near_duplicates(df).collect()} == want
    monkeypatch.setattr(near_dup, "BLOCK", 4)  # groups in many blocks
    assert {tuple(r) for r in near_duplicates(df).collect()} == want


def test_repeated_ids_keep_all_their_links(spark):
    draw = random.Random(2)
    a, b, c = ([f"{name}{i}" for i in range(60)] for name in "abc")
    near = [" ".join([*words, "more"]) for words in (a, b, c)]
    a, b, c = (" ".join(words) for words in (a, b, c))
    rows = [(5, a), (5, b), (9, near[1]), (3, near[0]), (7, c), (7, ""), (7, None), (8, near[2]), (20, a), (20, c)]
    for _ in range(2):
        draw.shuffle(rows)
        found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((r["doc_id"], r["component_id"]) for r in found if r["n_shingles"]) == [
            (3, 3), (5, 3), (5, 3), (7, 3), (8, 3), (9, 3), (20, 3), (20, 3),
        ]
        assert [(r["doc_id"], r["component_id"]) for r in found if not r["n_shingles"]] == [(7, 7), (7, 7)]
    apart = [r for r in rows if r[0] != 20]
    found = near_duplicates(spark.createDataFrame(apart, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in found if r["n_shingles"]} == {(3, 3), (5, 3), (9, 3), (7, 7), (8, 7)}


def test_forest_links_roots_once():
    base = np.arange(100, dtype=np.int64)
    side = pd.DataFrame({"rep": range(6), "root": [0, 0, 2, 3, 4, 5], "s": [np.sort(np.append(base[i:], -1 - i)) for i in range(6)]})
    found = forest(side, side)
    assert len(found) == 4 and {tuple(sorted(p)) for p in found.itertuples(index=False)} <= {(i, j) for i in range(6) for j in range(i + 1, 6)}
    assert forest(side.iloc[:0], side).empty


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r["id"]: r["root"] for r in components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}
    assert components(spark, spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_of_every_kind(spark):
    found = near_duplicates(documents(spark)).collect()
    assert len(found) == len(DOCUMENTS)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[3]["n_shingles"] == 0 and by_id[3]["component_id"] == 3 and by_id[3]["kept"]
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[1]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[8]["component_id"] == 1  # 17 of 21 shingles: repeats of a text only add those at the seams
    assert by_id[9]["component_id"] == 9  # only A-Z are lower-cased
    assert near_duplicates(documents(spark, [])).collect() == []


def test_deduplicate_keeps_one_row_of_each_group(spark):
    docs = documents(spark, DOCUMENTS + [(1, DOCUMENTS[0][1], "en", "a")])
    left = deduplicate(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 5, 6, 7, 9, 10] and ids.count(None) == 1


def test_shingles_of_short_texts():
    assert len(shingles("a b c d")) == 1 and len(shingles("a b c d e")) == 1 and len(shingles("  ")) == 0
    assert not np.array_equal(shingles("a b"), shingles("b a")) and np.array_equal(shingles("A b"), shingles("a  B"))


def test_many_texts_with_one_passage_are_skipped(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    texts = [f"{passage} " + " ".join(f"t{i}_{k}" for k in range(120)) for i in range(60)]
    assert all(r["kept"] for r in near_duplicates(with_texts(spark, texts)).collect())
