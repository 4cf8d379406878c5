"""Catalogue queries against their SQL on the smallest benchmark tables."""

import os

import pytest

from tests.compare import compare, connect
from txnlytics.plans import catalogue, oracle
from txnlytics.session import materialise

FOLDER = "/root/testdata/sf0.001"

SAMPLE = (
    "dedupe", "ingest_append", "txn_enriched", "category_share", "kpi_summary", "zscore", "anomaly_merge",
    "forecast", "forecast_upsert", "integrity_report", "ngram_vocab", "tfidf_weights", "stratified_split",
)

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables not there")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, duck, name):
    assert compare(spark, duck, name, catalogue.all_queries()[name], oracle.all_sql()[name], FOLDER) == ""


def test_every_sql_has_a_query():
    assert set(oracle.all_sql()) <= set(catalogue.all_queries())


@needs_data
def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["year_month", "total", "label"]
    assert entry.queries().keys() >= entry.oracle_sql().keys()


def test_intermediate_tables_go_to_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in materialise(spark.range(3), "x").inputFiles())


def test_discarded_tables_leave_no_files(spark):
    from pathlib import Path

    from txnlytics.session import discard, materialise

    kept, gone = (materialise(spark.range(5).toDF("k"), name) for name in ("kept", "gone"))
    discard(gone)
    assert Path(kept.stored_at).exists() and not Path(gone.stored_at).exists()
    assert kept.count() == 5
