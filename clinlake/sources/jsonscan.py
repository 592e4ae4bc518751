"""Entries of a large JSON document ``{section: {key: value}}``, read by many tasks.

A document is cut into byte ranges. What a range means depends on whether it begins inside
a string and how deep in brackets: so each task first counts its quotation marks and, for
both cases, how many brackets it opens more than it closes. Sums over the ranges before tell
every range where it begins, and then each reads the entries whose keys begin in it.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clinlake.sources import listing
from clinlake.workspace import scratch_path

# Tasks get these functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 32 * 1024 * 1024
_MARKS = re.compile(rb'\\.|["{}\[\]]', re.DOTALL)
_STRING_REST = re.compile(rb'(?:[^"\\]|\\.)*"', re.DOTALL)
_TOKEN = re.compile(rb'\s*(?:("(?:[^"\\]|\\.)*")|([{}\[\]:,])|([^\s{}\[\]:,"]+))', re.DOTALL)
_STEP = {b"{": 1, b"[": 1, b"}": -1, b"]": -1}


def _escaped(file, start: int) -> bool:
    """Is the byte at ``start`` behind an odd number of backslashes?"""
    n, at = 0, start
    while at > 0:
        low = max(0, at - 64)
        file.seek(low)
        before = file.read(at - low)
        run = len(before) - len(before.rstrip(b"\\"))
        n += run
        if run < len(before):
            break
        at = low
    return n % 2 == 1


def range_facts(file, start: int, end: int) -> tuple[int, int, int]:
    """Quotation marks of a range, and its opening less its closing brackets if it begins outside and inside a string."""
    skip = _escaped(file, start)
    file.seek(start)
    data = file.read(end - start)
    quotes, depth = 0, [0, 0]
    for m in _MARKS.finditer(data, int(skip)):
        mark = m[0]
        if mark == b'"':
            quotes += 1
        elif mark in _STEP:
            depth[quotes % 2] += _STEP[mark]
    # In what is inside strings seen from outside, everything else is outside seen from inside.
    return quotes, depth[0], depth[1]


def range_entries(
    file, length: int, start: int, end: int, in_string: bool, depth: int
) -> Iterator[tuple[str | None, str | None, str | None]]:
    """(section, key, value) of the entries whose keys begin in a range, and (section, None, None) where a section begins.

    The section is None as long as it began before the range. Values that are objects or lists are left out.
    """
    skip = _escaped(file, start)
    file.seek(start)
    data = file.read(min(length, end + (1 << 16)) - start)

    def more() -> bool:
        nonlocal data
        at = start + len(data)
        file.seek(at)
        data += file.read(max(len(data), 1 << 16))
        return start + len(data) > at

    at, n = int(skip), end - start
    if in_string:
        while (rest := _STRING_REST.match(data, at)) is None:
            if len(data) >= n or not more():
                return
        at = rest.end()
    section: str | None = None
    string: bytes | None = None  # the last string, if it may be a key, and whether it began in the range
    key: tuple[str, bool] | None = None
    own = False
    while True:
        token = _TOKEN.match(data, at)
        if token is None or token.end() == len(data):
            if more():
                continue
            if token is None:
                return
        first = max(token.start(1), token.start(2), token.start(3))
        if first >= n and not (own and (string is not None or key is not None)):
            return
        at = token.end()
        if token[1] is not None:
            if key is not None and depth == 2 and key[1]:
                yield section, key[0], json.loads(token[1])
            string, own = (None, own) if key is not None else (token[1], first < n)
            if key is not None:
                key, own = None, False
        elif token[2] == b":":
            key, string = (None if string is None else (json.loads(string), own)), None
            if key is not None and depth == 1 and key[1]:
                section = key[0]
                yield section, None, None
        elif token[2] is not None:
            depth += _STEP.get(token[2], 0)
            key, string, own = None, None, False
        else:
            if key is not None and depth == 2 and key[1]:
                yield section, key[0], token[3].decode()
            key, string, own = None, None, False


def _in_ranges(work, layout: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, own = listing.opened(row["path"])
                with system.open_input_file(own) as file:
                    found = list(work(file, row))
                for at in range(0, len(found), 50_000):
                    columns = zip(*found[at : at + 50_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, layout, strict=True)], schema=layout)

    return run


def _kept(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame that is read more than once, written to the shared folder."""
    path = scratch_path(spark, "ranges")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scan_entries(spark: SparkSession, path: str | Sequence[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(section, key, value) of all entries of JSON documents, a file each, as text; the documents have to be well-formed."""
    files = listing.list_files(spark, path).where("length > 0")
    starts = F.explode(F.expr(f"sequence(0, length - 1, {range_bytes})"))
    ranges = files.select("path", "length", starts.alias("start")).withColumn("end", F.least("length", F.col("start") + range_bytes))
    text = [("path", pa.string())]
    numbers = [(c, pa.int64()) for c in ("length", "start", "end", "quotes", "outside", "inside")]

    def facts(file, row):
        yield (*row.values(), *range_facts(file, row["start"], row["end"]))

    counted = listing.dealt(ranges, "path", "start").mapInArrow(
        _in_ranges(facts, pa.schema(text + numbers)), "path string, " + ", ".join(f"{c} bigint" for c, _ in numbers)
    )
    before = W.partitionBy("path").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    parity = counted.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    step = F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))
    placed = _kept(spark, parity.withColumn("depth", F.coalesce(F.sum(step).over(before), F.lit(0))).select(
        "path", "length", "start", "end", "in_string", "depth"
    ))

    def entries(file, row):
        for nth, found in enumerate(range_entries(file, *list(row.values())[1:])):
            yield row["path"], row["start"], nth, *found

    layout = pa.schema([("path", pa.string()), ("start", pa.int64()), ("nth", pa.int64()), ("section", pa.string()), ("key", pa.string()), ("value", pa.string())])
    found = _kept(spark, listing.dealt(placed, "path", "start").mapInArrow(
        _in_ranges(entries, layout), "path string, start bigint, nth bigint, section string, key string, value string"
    ))
    # The section in which a range begins is the last one named in the ranges before it.
    named = placed.select("path", "start").join(
        found.where("key is null").groupBy("path", "start").agg(F.max_by("section", "nth").alias("last")), ["path", "start"], "left"
    )
    running = named.select("path", "start", F.last("last", ignorenulls=True).over(before).alias("begun"))
    return found.where("key is not null").join(running, ["path", "start"]).select(
        F.coalesce("section", "begun").alias("section"), "key", "value"
    )
