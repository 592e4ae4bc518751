from __future__ import annotations

import math
import random

from clinlake.llm.topk import top_k


def brute(rows, k, every):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(64 * x) for x in v]
            known[i] = min(known.get(i, w), w)
    out = set()
    for q in [i for i in known if i % every == 0]:
        best = sorted((-sum(a * b for a, b in zip(known[q], w)), i) for i, w in known.items() if i != q)[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return out


def test_equals_brute_force(spark):
    draw = random.Random(5)
    rows = [(i, [draw.choice([0.0, 0.25, -0.5, 1.0]) for _ in range(6)]) for i in range(150)]  # many ties
    rows += [(150, None), (160, [1.0, None]), (170, [float("nan")] * 6), (180, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(7, rows[7][1]), (20, rows[20][1]), (190, [1.0, 2.0]), (200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as w", "2 as score", "'x' as qb")
    for shape in ({}, {"candidate_block": 40, "query_block": 3}):
        assert {tuple(r) for r in top_k(df, k=8, every=10, **shape).collect()} == brute(rows, 8, 10)


def test_few_and_no_rows(spark):
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in top_k(two).collect()] == [(0, 1, 1, 64 * 128)]
    assert top_k(two.where("false")).collect() == []
