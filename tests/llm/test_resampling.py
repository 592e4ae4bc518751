from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from clinlake.llm import resampling
from clinlake.llm.resampling import GainPlanes, planes, resample, runs_of
from tests.llm.helpers import SCHEMA, documents

UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def buckets(text):
    ws = words(text)
    runs = [" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)]
    return Counter(zlib.crc32(r.encode()) % 10_000 for r in runs)


def brute(rows, target, percent=5, least=20):
    own = [(i, len(words(t)), buckets(t)) for i, t in rows]
    s, t = sum((b for *_, b in own), Counter()), sum((buckets(x) for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000))))

    out = []
    for i, n, b in own:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain(x) for x, n in b.items())
        out.append([i, sum(b.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = n
    return sorted(map(tuple, out), key=str)


def check(df, target, rows, texts, **options):
    found = sorted((tuple(r) for r in resample(df, target, **options).collect()), key=str)
    assert found == brute(rows, texts, **({"percent": options.get("percent", 5), "least": options.get("least_words", 20)}))


def test_equals_brute_force(spark):
    draw = random.Random(4)
    vocabulary = ["".join(draw.choice("abcdé5'") for _ in range(draw.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 120))) for _ in range(150)]
    rows = list(enumerate(texts)) + [(7, texts[7]), (None, texts[3]), (None, texts[3]), (200, None), (201, ""), (202, "?!")]
    target = texts[:20] + [None, "", "other words, not in Any document"]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as weight", "2 as score", "3 as rank", "4 as mark")
    wanted = spark.createDataFrame([(t,) for t in target], "text string").selectExpr("*", "1 as bucket", "'x' as n")
    check(df, wanted, rows, target)
    check(df, wanted, rows, target, percent=60, least_words=1)


def test_awkward_and_empty_tables(spark):
    docs, none = documents(spark), spark.createDataFrame([], SCHEMA)
    rows = [tuple(r)[:2] for r in docs.collect()]
    check(docs, none, rows, [], percent=50)
    check(docs, docs, rows, [t for _, t in rows])
    assert resample(none, docs).collect() == []


def test_pieces_do_not_change_a_text(monkeypatch):
    text = " ".join(f"w{i % 17} é{i % 5}" for i in range(2_000))
    whole = [np.bincount(b, minlength=10_000) for _, b in runs_of(text)]
    monkeypatch.setattr(resampling, "PIECE_BYTES", 7)
    pieces = list(runs_of(text))
    assert len(whole) == 1 and len(pieces) > 500
    assert (sum(np.bincount(b, minlength=10_000) for _, b in pieces) == whole[0]).all()
    assert sum(n for n, _ in pieces) == 4_000 and whole[0].sum() == 3 * 4_000 - 3


def test_planes_add_up_exactly():
    draw = np.random.default_rng(1)
    gain, counts = draw.integers(-40_000, 40_000, 10_000), draw.integers(0, 2**draw.integers(0, 40, 10_000))
    assert GainPlanes(gain).weight(counts) == sum(int(a) * int(b) for a, b in zip(gain, counts, strict=True))
    assert GainPlanes(np.zeros(10_000, dtype=np.int64)).weight(counts) == 0
    assert planes(np.zeros(10_000, dtype=np.int64)).shape == (0, 157)
