"""Registered queries against their DuckDB counterparts on the smallest tables."""

import os

import duckdb
import pytest

from check import TABLES, rows
from conftest import SF
from workload.oracle import ORACLE
from workload.registry import QUERIES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")

COMPARED = [
    "dedupe_id_url", "normalise_listings", "date_parse", "price_stats", "quality_issues", "report_full", "flatten",
    "merge_scheduled", "insert_new", "store_prepare", "store_recent", "ascii_fold", "slugify", "text_lines", "resolve_url",
    "extract_p1", "extract_p2", "extract_p3", "links_p1", "has_next", "crawl_extent", "links_join_pages", "seed_urls",
    "page_urls", "csv_roundtrip", "json_roundtrip", "stream_extract", "stream_dedupe", "stream_merge",
    "store_upsert_read", "store_lookup_stored", "union_scoped", "scheduled_run", "step_counts", "flatten_open", "crawl_sample", "crawl_listings",
    "portal_searched", "report_file", "custom_profile", "json_envelope", "price_readings",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    relation = con.execute(ORACLE[name])
    columns = [c[0] for c in relation.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, relation.fetchall())


@pytest.mark.parametrize("profile", ["classifieds", "refline", "portal"])
def test_pages_are_dealt_out_also_after_a_join_by_shuffle(spark, profile):
    from pyspark.sql import functions as F
    from workload.pages import detail_pages

    conf = {"spark.sql.shuffle.partitions": "24", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        parts = detail_pages(spark, SF, profile).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    counts = [r["count"] for r in parts]
    assert len(counts) == 24 and max(counts) < 2 * min(counts)
