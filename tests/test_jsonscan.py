"""Large JSON documents in byte ranges."""

from __future__ import annotations

import io
import json
import random

import pytest

from clinlake.sources import jsonscan, vocabulary
from tests.conftest import rows


def document(seed: int):
    draw = random.Random(seed)
    odd = ["plain", 'quo"te', "back\\slash", "br{ac}e[s]", "end\\", '\\\\"', "é✓", "", ":,", "_remark", "\n\t", "a" * 200]
    content = {}
    for i in range(draw.randint(0, 6)):
        section = {}
        for k in range(draw.randint(0, 25)):
            value = draw.choice([draw.randint(-5, 10**6), "7", None, True, 1.5, {"x": {"y": [1, "}"]}}, [1, {"k": "v"}], draw.choice(odd)])
            section[f"{draw.choice(odd)}{k}"] = value
        content[f"{draw.choice(odd)}{i}"] = section if draw.random() < 0.85 else draw.choice([3, "text", [1, 2], None])
    text = json.dumps(content, indent=draw.choice([None, 1, 4]), ensure_ascii=draw.random() < 0.5).encode()
    return content, text


def plain(content):
    return sorted(
        (s, k, v if isinstance(v, str) else json.dumps(v))
        for s, section in content.items() if isinstance(section, dict)
        for k, v in section.items() if not isinstance(v, dict | list)
    )


@pytest.mark.parametrize("seed", range(30))
def test_ranges_of_any_size_give_the_same_entries(seed):
    content, text = document(seed)
    file = io.BytesIO(text)
    for step in (10**9, 1000, 97, 13, 5, 1):
        quotes, depth, section, found = 0, 0, None, []
        for start in range(0, len(text), step):
            end = min(len(text), start + step)
            inside = quotes % 2 == 1
            for name, key, value in jsonscan.range_entries(file, len(text), start, end, inside, depth):
                if key is None:
                    section = name
                else:
                    found.append((section if name is None else name, key, value))
            q, outside_step, inside_step = jsonscan.range_facts(file, start, end)
            quotes, depth = quotes + q, depth + (inside_step if inside else outside_step)
        assert (depth, quotes % 2) == (0, 0)
        assert sorted(found) == plain(content), step


def test_a_vocabulary_is_the_same_in_any_ranges(spark, tmp_path):
    content = {
        "_metadata": {"A": 1, "x": {"B": 2}},
        **{f"c{i}": {**{f"K{i}-{k}": k for k in range(150)}, "_remark": 1, "n/a": "none", "T": "7", "F": None} for i in range(4)},
        "flat": 3,
    }
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "one.json").write_text(json.dumps(content, indent=1))
    (tmp_path / "v" / "two.json").write_text(json.dumps({"other": {"Z": 9}}))
    whole = rows(vocabulary.entries_of(spark.read.text(str(tmp_path / "v"), wholetext=True)))
    assert len(whole) == 4 * 151 + 1
    for size in (jsonscan.RANGE_BYTES, 700):
        assert rows(vocabulary.scanned_entries(spark, str(tmp_path / "v"), size)) == whole
