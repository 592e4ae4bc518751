"""Importance resampling towards a target distribution, with weights from bit-sliced sums.

Word runs of one to three words are hashed into 10000 buckets. A bucket's gain is
the scaled logarithm of how much likelier it is in the target than in the corpus.
A document's bucket counts are held as planes of 10000 bits, one plane per binary
digit of the counts; the gains are held the same way, their positive and negative
parts apart. A document's weight is the sum over pairs of planes of 2**(i + j)
times the number of buckets set in both: AND, population count, shift.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinlake.llm.common import map_stream, saved, sql_crc32, sql_lower

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of text that are split into words at once.
PIECE_BYTES = 1 << 20

#: A-Z to a-z; what is neither 0-9, a-z nor beyond ASCII becomes a blank.
_WORDS_ONLY = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def runs_of(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """(new words, buckets of all runs of up to three words that end in one of them), piece by piece of a text."""
    data = text.encode("utf-8", "surrogatepass").translate(_WORDS_ONLY)
    at, before = 0, []
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES)
        end = len(data) if end < 0 else end
        new = data[at:end].split()
        words, old, at = before + new, len(before), end
        spaced = [b" " + w for w in words]
        # A run's crc goes on from that of the run without its last word.
        level = list(map(zlib.crc32, words))
        found = level[old:]
        for more in range(1, LONGEST_RUN):
            level = list(map(zlib.crc32, spaced[more:], level))
            found += level[max(old - more, 0) :]
        before = words[-(LONGEST_RUN - 1) :]
        yield len(new), np.array(found, dtype=np.int64) % BUCKETS


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n): how often the runs of all texts fall into each bucket; a task passes on one row per bucket."""

    def stream(parts):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for part in parts:
            for row in part:
                for _, buckets in runs_of(row["text"] or ""):
                    total += np.bincount(buckets, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield list(zip(seen.tolist(), total[seen].tolist(), strict=True))

    return map_stream(texts.select("text"), "bucket int, n long", stream).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, at most 10000 integers, from the counts of corpus and target."""
    spark = corpus.sparkSession
    s, t = F.coalesce("s", F.lit(0)).cast("double"), F.coalesce("t", F.lit(0)).cast("double")
    both = (
        spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
        .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .select("bucket", s.alias("s"), t.alias("t"))
    )
    whole = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + BUCKETS) / ((F.col("s") + 1) * (F.col("all_t") + BUCKETS))
    rows = both.join(F.broadcast(whole)).select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["gain"]
    return out


def planes(numbers: np.ndarray) -> np.ndarray:
    """Binary digits of non-negative numbers as rows of packed bits, the lowest digit first."""
    width = -(-len(numbers) // 64) * 8
    digits = int(numbers.max(initial=0)).bit_length()
    out = np.zeros((digits, width), dtype=np.uint8)
    for i in range(digits):
        bits = np.packbits((numbers >> i & 1).astype(bool))
        out[i, : len(bits)] = bits
    return out.view(np.uint64)


class GainPlanes:
    """Signed gains as bit planes, and the exact sum of a document's gains over its counts' planes."""

    def __init__(self, gain: np.ndarray):
        self.signed = [(1, planes(np.maximum(gain, 0))), (-1, planes(np.maximum(-gain, 0)))]

    def weight(self, counts: np.ndarray) -> int:
        own, total = planes(counts), 0
        for sign, gain in self.signed:
            for i, digit in enumerate(own):
                common = np.bitwise_count(gain & digit).sum(axis=1, dtype=np.int64).tolist()
                total += sign * sum(n << (i + j) for j, n in enumerate(common))
        return total


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of a table (doc_id, text); ``doc_id`` keeps its type."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def stream(parts):
        sums = GainPlanes(gain)
        for part in parts:
            out = []
            for row in part:
                counts, words = np.zeros(BUCKETS, dtype=np.int64), 0
                for new, buckets in runs_of(row["text"] or ""):
                    counts += np.bincount(buckets, minlength=BUCKETS)
                    words += new
                out.append((row["doc_id"], words, int(counts.sum()), sums.weight(counts)))
            yield out

    return map_stream(
        docs.select("doc_id", "text"), f"doc_id {kind}, n_words long, n_features long, weight long", stream
    )


def with_score(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise keyed by the id, so that reruns draw alike."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return weighed.withColumn("score", F.col("weight") + noise)


def with_rank(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """Adds ``rank`` (1, 2, ...) to the drawn rows.

    Rows are dealt over ranges of the order and written; a row's rank is its place
    in its range plus the rows of the ranges before it. Only one count per range
    goes beyond its task.
    """
    spark = scored.sparkSession
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    drawn = percent * n // 100
    order = [F.desc(able), F.desc("score"), F.asc_nulls_last("doc_id"), F.col("mark")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = scored.withColumn("mark", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    ranged = saved(spark, dealt.withColumn("range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("range").agg(F.count("*").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.col("start")
    return ranged.join(F.broadcast(starts), "range").select(
        *[c for c in scored.columns], F.when(able & (place <= drawn), place).cast("long").alias("rank")
    )


def resample(
    docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words): every row of ``docs`` (doc_id, text), drawn towards ``target`` (text).

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred
    of the highest scores are drawn, ties to the smaller id, NULL ids last; ``rank``
    is NULL for the others. NULL and empty texts have no features and weight 0.
    Repeated rows and rows with a NULL id (its noise is that of an empty id) are
    documents of their own. A text of any length is taken piece by piece. Other
    columns are ignored; empty tables give no rows, or gains from the other table alone.
    """
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = saved(spark, with_score(weigh(docs, gain), seed), "weights")
    return with_rank(scored, least_words, percent).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def _sql_runs(table: str) -> str:
    two, three = "ws[i] || ' ' || ws[i + 1]", "ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]"
    longer = ", ".join(
        f"list_transform(range(1, len(ws) - {n}), lambda i: {f})" for n, f in ((0, two), (1, three))
    )
    return f"SELECT nth, unnest(list_concat(ws, {longer})) AS f FROM {table}"


def _sql_words(table: str) -> str:
    words = f"regexp_extract_all({sql_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"SELECT *, row_number() OVER () AS nth, {words} AS ws FROM {table}"


#: The same result in DuckDB, over the same tables.
ORACLE = f"""
WITH d AS ({_sql_words("documents")}), b AS ({_sql_words("benchmark")}),
df AS ({_sql_runs("d")}), bf AS ({_sql_runs("b")}),
hashed AS (SELECT f, {sql_crc32("f")} % {BUCKETS} AS bucket FROM (SELECT f FROM df UNION SELECT f FROM bf)),
s AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS s FROM df JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, CAST(count(*) AS DOUBLE) AS t FROM bf JOIN hashed USING (f) GROUP BY bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(
    (coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + {BUCKETS}) / ((coalesce(s, 0) + 1) * ((SELECT sum(t) FROM t) + {BUCKETS}))
  )) AS BIGINT) AS gain
  FROM s FULL JOIN t USING (bucket)
), weighed AS (
  SELECT nth, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM df JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY nth
), scored AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
  FROM d LEFT JOIN weighed USING (nth)
), noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / 4294967296.0))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT *, n_words >= {LEAST_WORDS} AS able, row_number() OVER (
    PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place FROM noisy
)
SELECT doc_id, n_features, weight, score, n_words,
  CASE WHEN able AND place <= {PERCENT} * (SELECT count(*) FROM placed WHERE able) // 100 THEN place END AS rank
FROM placed
"""
