"""The registered queries over the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from clinlake.llm import queries
from tests.conftest import TESTDATA
from tools.check_oracle import compare, duck

SF_DIR = str(TESTDATA / "sf0.001")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    agrees, note = compare(spark, duck(SF_DIR), name, SF_DIR)
    assert agrees, note


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.ORACLES])
def test_query_answers_for_every_row(spark, name):
    found = driver.queries()[name](spark, SF_DIR)
    table = "pages" if name.startswith("op2_") else "documents"
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert found.count() == rows or name.startswith("op10_") and found.count() > 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(spark, stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4]
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
