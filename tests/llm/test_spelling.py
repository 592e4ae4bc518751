from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from clinlake.llm.spelling import group_variants, near_pairs, node_numbers, words_in
from tests.llm.helpers import SCHEMA, documents

UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    words: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, count = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        count[w] = len(others)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, count[w], words.get(form[w])) for w, n in words.items()}


def test_equals_brute_force(spark):
    draw = random.Random(3)
    stems = ["".join(draw.choice("abÉ") for _ in range(draw.choice([6, 7, 7, 8, 9]))) for _ in range(60)]
    rows = []
    for i in range(120):
        own = [draw.choice(stems[:3] * 12 + stems) for _ in range(80)]
        rows.append((i, " ".join(w.upper() if draw.random() < 0.1 else w for w in own)))
    rows += [(None, "aaaaaaa aaaaaab"), (None, "aaaaaaa aaaaaab"), (3, None), (4, ""), (5, " 12_34 "), rows[0], rows[0]]
    rows += [(900 + i, "colours " * 130 + "colour's colourx colorss " + "colourss " * 12 + "colourssq ") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as word", "2 as n", "3 as id")
    found = {tuple(r) for r in group_variants(df).collect()}
    assert found == brute(rows)
    assert any(form is not None and form != root for _, form, root, *_ in found)  # chains of forms occur


def test_awkward_tables(spark):
    rows = [tuple(r)[:2] for r in documents(spark).collect()]
    assert {tuple(r) for r in group_variants(documents(spark)).collect()} == brute(rows)
    assert group_variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert group_variants(spark.createDataFrame([(1, "Once only words"), (2, None)], "doc_id long, text string")).collect() == []


def test_very_long_words(spark):
    draw = random.Random(8)
    long = "".join(draw.choice("abcdef") for _ in range(20_000))
    other, shorter = long[:5_000] + "z" + long[5_001:], long[:9_000] + long[9_001:]
    words = [long, other, shorter, "x" * 20_000, "x" * 19_999, "unrelated"]
    df = spark.createDataFrame(list(enumerate(words)), "id long, word string")
    assert {tuple(r) for r in near_pairs(df).collect()} == {(0, 1), (0, 2), (3, 4)}


def test_runs_lose_code_points_by_document():
    counts = [words_in(i, "Straßenbahn STRASSENBAHN ÀÉÎÕÜ") for i in range(200)]
    assert all(sum(c.values()) == 2 for c in counts)
    spelt = Counter(w for c in counts for w in c)
    assert spelt["straßenbahn"] > 180 and any(len(w) == 10 for w in spelt)


def test_node_numbers_follow_from_the_parent():
    assert node_numbers("abc", 7)[:3] == node_numbers("abd", 7)[:3]
    assert len(set(node_numbers("aaaa", 7))) == 5
