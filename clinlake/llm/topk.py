"""Exact top-k inner products by term-at-a-time accumulation.

A vector's components are terms with integer weights. Blocks of candidates hold,
for each term, the postings (which rows, what weights); a block of query rows
scatters its weights term by term into dense score arrays over the candidates.
The k best of a block come from a partition selection, and the blocks' lists are
merged per query. Queries and candidates meet block by block, so a task holds
one block of each whatever the table's size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
K = 20
QUERY_EVERY = 20
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 1024
#: Query rows whose dense score arrays are held at once.
ROWS_AT_ONCE = 64


def integer_weights(vector) -> F.Column:
    """floor(64 x) of every component; NULL for NULL vectors and vectors with NULL or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    weights = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), weights)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def best_of_block(
    q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int
) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score): each query's k best of a block, ties to the smaller candidate id."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    # Scores that fit are summed in 32 bits.
    most = int(np.abs(q).sum(1).max(initial=0)) * int(np.abs(c).max(initial=0))
    kind = np.int32 if most < 2**31 else np.int64
    postings = []
    for term in range(min(q.shape[1], c.shape[1])):
        rows = np.flatnonzero(c[:, term])
        every = len(rows) == len(c_ids)
        postings.append((slice(None) if every else rows, c[rows, term].astype(kind)))
    for at in range(0, len(q_ids), ROWS_AT_ONCE):
        part = q[at : at + ROWS_AT_ONCE].astype(kind)
        scores = np.zeros((len(part), len(c_ids)), dtype=kind)
        for i, weights in enumerate(part):
            own = scores[i]
            for term in np.flatnonzero(weights[: len(postings)]):
                rows, posted = postings[term]
                own[rows] += weights[term] * posted
        for i, own in enumerate(scores):
            query = q_ids[at + i]
            allowed = np.flatnonzero(c_ids != query)
            found = own[allowed]
            if len(found) > k:
                edge = np.partition(found, len(found) - k)[len(found) - k]
                above = np.flatnonzero(found > edge)
                level = np.flatnonzero(found == edge)[: k - len(above)]
                keep = np.concatenate([above, level])
            else:
                keep = np.arange(len(found))
            for j in keep:
                yield int(query), int(c_ids[allowed[j]]), int(found[j])


def top_k(
    vectors: DataFrame, k: int = K, every: int = QUERY_EVERY, candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k candidates of highest integer inner product.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all
    rows with another vec_id. Rows with a NULL id, NULL vectors and vectors with
    NULL or non-finite components take no part; of rows that repeat an id one takes
    part, the one with the smallest vector. Where lengths differ, missing
    components count as 0. Ties go to the smaller vec_id. Other columns are ignored.
    """
    rows = (
        vectors.where("vec_id is not null")
        .select(F.col("vec_id").cast("long").alias("vec_id"), integer_weights(F.col("embedding")).alias("w"))
        .where("w is not null")
        .groupBy("vec_id")
        .agg(F.min("w").alias("w"))
    )
    is_query = F.col("vec_id") % every == 0
    n = rows.agg(
        F.count("*").alias("rows"), F.count(F.when(is_query, 1)).alias("queries"), F.max(F.size("w")).alias("width")
    ).first()
    c_blocks, q_blocks = (max(1, math.ceil(a / b)) for a, b in ((n["rows"], candidate_block), (n["queries"], query_block)))
    width = n["width"] or 0

    def block(count):
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    meets = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    queries = rows.where(is_query).select(block(q_blocks).alias("qb"), meets(c_blocks).alias("cb"), "vec_id", "w")
    candidates = rows.select(meets(q_blocks).alias("qb"), block(c_blocks).alias("cb"), "vec_id", "w")

    def search(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = list(
            best_of_block(
                own["vec_id"].to_numpy(np.int64), _matrix(own["w"], width),
                others["vec_id"].to_numpy(np.int64), _matrix(others["w"], width), k,
            )
        ) if len(own) and len(others) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    lists = (
        queries.groupBy("qb", "cb").cogroup(candidates.groupBy("qb", "cb"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


#: The same result in DuckDB, over the same table.
ORACLE = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % {QUERY_EVERY} = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
