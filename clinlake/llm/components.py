"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm.common import saved


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(id, root) for every id in links (a, b); the root is the smallest id of the component.

    Alternates large-star and small-star steps until the links are stars around
    their roots. Links stay a distributed table, written to the shared folder
    after every round; an id's neighbours are only aggregated, never gathered.
    """
    edges = saved(spark, _oriented(links), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == before or mark[0] == 0:
            return edges.select(F.col("hi").alias("id"), F.col("lo").alias("root")).unionByName(
                edges.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct()
            )
        before = mark
        edges = saved(spark, _small_star(_large_star(edges)), "links")


def _oriented(links: DataFrame) -> DataFrame:
    a, b = F.col(links.columns[0]), F.col(links.columns[1])
    return links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every id are linked with its smallest neighbour."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """An id and its smaller neighbours are linked with the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    inner = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return inner.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct()
