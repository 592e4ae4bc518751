from __future__ import annotations

import random

import numpy as np
import pytest

from clinlake.llm import decontamination
from clinlake.llm.decontamination import Items, contamination, decontaminate
from tests.llm.helpers import DOCUMENTS, documents, with_texts

ITEM = "item_id long, text string"


def brute_score(own, window):
    best = 0
    table = np.zeros((len(own) + 1, len(window) + 1), dtype=int)
    for i, a in enumerate(own, 1):
        for j, b in enumerate(window, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if a == b else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
            best = max(best, table[i, j])
    return best / (2 * len(own))


def test_alignment_equals_brute_force():
    draw = random.Random(2)
    for _ in range(200):
        own = [draw.choice("abcde") for _ in range(draw.randint(3, 12))]
        items = Items([(1, " ".join(own))])
        window = [draw.choice("abcdex") for _ in range(draw.randint(0, 20))]
        score, matches, lo, hi = items.align(0, np.array([items.vocab.get(w, 0) for w in window], dtype=np.int64))
        assert abs(score - brute_score(own, window)) < 1e-9 and 0 <= lo <= hi <= len(window) and matches <= len(own)


def edited(draw, item, rate, way):
    """A copy of an item with words changed, deleted or put in, at random or at every so many words."""
    out = []
    every = max(1, round(1 / rate))
    for k, w in enumerate(item):
        hit = draw.random() < rate if draw.random() < 0.5 else k % every == every - 1
        kind = draw.choice("cdi") if way == "mixed" else way[0]
        if not hit:
            out.append(w)
        elif kind == "c":
            out.append(f"new{draw.randrange(50)}")
        elif kind == "i":
            out += [w, f"new{draw.randrange(50)}"]
    return out


def windowed(items, text):
    """Pairs found through seeds, with every window aligned that has one of the item's rarest."""
    split, found = decontamination.words(text), set()
    for item, _, ids, seeds in items.windows(text):
        assert len(split) >= len(ids)
        score, matches, _, _ = items.align(item, np.array(ids))
        rare = items.rare(item, np.arange(len(items.seeds)) % 7)
        if np.isin(seeds, rare).any() and score >= decontamination.LEAST_SCORE and matches >= min(8, len(items.words[item])):
            found.add(item)
    return found


@pytest.mark.parametrize("way", ["changed", "deleted", "inserted", "mixed"])
def test_seeds_lose_no_pair_of_an_exhaustive_alignment(way):
    draw, met = random.Random(way), {}
    for _ in range(60):
        texts = [[f"w{draw.randrange(40)}" for _ in range(draw.randint(7, 45))] for _ in range(4)]
        items = Items([(n, " ".join(t)) for n, t in enumerate(texts)])
        rate = draw.choice([0.1, 0.2, 0.25, 0.3, 1 / 3, 0.4])
        text = [f"w{draw.randrange(60)}" for _ in range(30)]
        for t in texts:
            text += edited(draw, t, rate, way) + [f"w{draw.randrange(60)}" for _ in range(draw.randint(0, 30))]
        ids = np.array([items.vocab.get(w, 0) for w in text], dtype=np.int64)
        every = set()
        for n, t in enumerate(texts):
            score, matches, _, _ = items.align(n, ids)
            assert abs(score - brute_score(t, text)) < 1e-9
            if score >= decontamination.LEAST_SCORE and matches >= min(8, len(t)):
                every.add(n)
        assert windowed(items, " ".join(text)) == every
        met.setdefault(rate, []).append(len(every))
    assert sum(map(sum, met.values())) > 60 and sum(met[0.1]) > 0


def test_every_third_word_replaced_is_found(spark):
    item = [f"term{k}" for k in range(30)]
    copy = [f"other{k}" if k % 3 == 2 else w for k, w in enumerate(item)]
    docs = with_texts(spark, [" ".join(["start"] * 9 + copy + ["end"] * 9), "start end"])
    (r,) = contamination(docs, spark.createDataFrame([(1, " ".join(item))], ITEM)).collect()
    assert (r["doc_id"], r["first_word"], r["matches"], r["score"] >= 0.5) == (0, 9, 20, True)


def test_long_windows_are_aligned_in_strips(monkeypatch):
    monkeypatch.setattr(decontamination, "STRIP", 40)
    draw = random.Random(8)
    own = [f"w{draw.randrange(30)}" for _ in range(12)]
    items = Items([(1, " ".join(own))])
    for _ in range(40):
        text = [f"w{draw.randrange(40)}" for _ in range(draw.randint(30, 150))] + own[: draw.randint(4, 12)]
        text += [f"w{draw.randrange(40)}" for _ in range(draw.randint(0, 60))]
        score, matches, lo, hi = items.align(0, np.array([items.vocab.get(w, 0) for w in text], dtype=np.int64))
        assert abs(score - brute_score(own, text)) < 1e-9
        assert abs(score - brute_score(own, text[lo:hi])) < 1e-9 and matches <= hi - lo


def test_rows_without_id_are_judged_by_their_text(spark):
    item = " ".join(f"term{k}" for k in range(20))
    docs = spark.createDataFrame(
        [(None, item, 1), (None, "clean text", 2), (None, None, 3), (4, item, 4), (5, None, 5), (None, "", 6)],
        "doc_id long, text string, mark int",
    )
    left = decontaminate(docs, spark.createDataFrame([(1, item)], ITEM))
    assert left.columns == docs.columns and sorted(r["mark"] for r in left.collect()) == [2, 3, 5, 6]


def passages():
    draw = random.Random(6)
    return draw, [[f"term{draw.randrange(900)}" for _ in range(30)] for _ in range(12)]


def test_exact_edited_and_clean_documents(spark, monkeypatch):
    draw, items = passages()
    noise = lambda n: [f"filler{draw.randrange(3000)}" for _ in range(n)]
    texts, want = [], set()
    for n, item in enumerate(items):
        texts.append(" ".join(noise(50) + item + noise(20)))
        want.add((len(texts) - 1, n))
        changed = [f"other{k}" if k % 6 == 3 else w for k, w in enumerate(item) if k % 11 != 7]
        texts.append(" ".join(noise(10) + changed).upper() + "!")
        want.add((len(texts) - 1, n))
        texts.append(" ".join(noise(30) + item[:6] + noise(30)))  # a quotation of a few words
        texts.append(" ".join(noise(60)))
    texts += [" ".join(items[0])] * 40  # one passage that many documents share
    want |= {(len(texts) - 1 - k, 0) for k in range(40)}
    bench = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], ITEM)
    docs = with_texts(spark, texts)
    found = contamination(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    exact = next(r for r in found if r["doc_id"] == 0)
    assert exact["score"] == 1.0 and exact["first_word"] == 50 and exact["n_words"] == exact["matches"] == 30
    assert {(r["doc_id"], r["item_id"]) for r in contamination(docs, bench, block_bytes=300).collect()} == want
    left = decontaminate(docs, bench)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_rows_of_every_kind(spark):
    docs = documents(spark)
    bench = spark.createDataFrame([(1, DOCUMENTS[0][1]), (1, DOCUMENTS[0][1]), (2, None), (3, ""), (4, "the old"), (None, "x y z")], ITEM)
    found = contamination(docs, bench.selectExpr("*", "1 as doc_id")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 1), (8, 1), (None, 1)}
    assert len(decontaminate(docs, bench).collect()) == len(DOCUMENTS) - 5
    assert contamination(documents(spark, []), bench).collect() == [] and contamination(docs, bench.where("false")).collect() == []
