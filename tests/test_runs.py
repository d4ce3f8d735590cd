"""End-to-end runs: exports, report, snapshots, profiles."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from listwright import session
from listwright.operators.export import criteria_keys, flatten, write_csv
from listwright.operators.quality import Rule
from listwright.operators.store import ListingStore
from listwright.plans import curated
from listwright.settings import Site
from listwright.sources.exports import read_json_envelope
from listwright.sources.pages import read_snapshots
from listwright.sources.search import with_search
from listwright.streaming import intake

HTML = """<h1>Villa {n}</h1><span class="price">{n}000 TND</span><dl><dt>Etage</dt><dd>{n}</dd><dt>Meuble</dt><dd>Oui</dd></dl>
<time datetime="2024-0{n}-01">x</time><img src="/i.jpg">"""


def pages(spark):
    rows = [(n, f"https://www.classifieds.example/ad/{n % 4}/", HTML.format(n=n)) for n in range(1, 6)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_run_exports_and_reports(spark, tmp_path):
    out = str(tmp_path / "run")
    stamp = F.lit("2024-06-01 10:00:00").cast("timestamp")
    result = curated.run(pages(spark), "classifieds", out, stamp, min_date="2024-02-01")
    assert {r.listing_id for r in result.listings.collect()} == {"2", "3", "0"}
    csv = [f for f in os.listdir(f"{out}/classifieds_listings_csv") if f.endswith(".csv")]
    head = open(f"{out}/classifieds_listings_csv/{csv[0]}", encoding="utf-8").readline()
    assert head.startswith("﻿listing_id,title,price_numeric,currency,price_raw,category")
    assert "criteria_floor" in head and "criteria_furnished" in head
    meta = spark.read.json(f"{out}/classifieds_listings_json/metadata").first()
    assert (meta.total_listings, meta.source, meta.category) == (3, "classifieds.example", "immobilier")
    lines = [json.loads(r.value) for r in spark.read.text(f"{out}/classifieds_listings_json/listings").collect()]
    assert {type(x["criteria"]["floor"]) for x in lines} <= {float, int} and {x["criteria"]["furnished"] for x in lines} == {True}
    report = spark.read.json(f"{out}/summary_report_classifieds").first()
    assert report.total_listings == 3 and report.filters.min_date_posted == "2024-02-01"
    assert report.validation.quality_score == result.summary.first().quality_score


def test_run_without_matches_stops(spark, tmp_path):
    stamp = F.lit("2024-06-01").cast("timestamp")
    assert curated.run(pages(spark), "classifieds", str(tmp_path / "r"), stamp, min_date="2030-01-01") is None


def test_empty_export_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    assert write_csv(pages(spark).where("page_id > 99"), path) is False and not os.path.exists(path)


def test_result_does_not_depend_on_partitioning(spark):
    few, many = (sorted(map(str, curated.curate(pages(spark).repartition(n), "classifieds").collect())) for n in (1, 7))
    assert few == many


def test_flatten_prefers_top_level_values(spark):
    df = spark.sql("SELECT 1 AS seq, 'a' AS listing_id, CAST(NULL AS DOUBLE) AS surface, map('surface', '3.0', 'vue', 'mer') AS criteria")
    row = flatten(df).first()
    assert (row.criteria_surface, row.criteria_vue) == ("3.0", "mer")


def test_json_envelope_and_snapshots(spark, tmp_path):
    path = tmp_path / "export.json"
    path.write_text(json.dumps({"metadata": {"total_listings": 1}, "listings": [{"listing_id": "x", "price_numeric": 2.5, "image_urls": ["a"]}]}, indent=2))
    row = read_json_envelope(spark, str(path)).first()
    assert (row.listing_id, row.price_numeric, row.image_urls) == ("x", 2.5, ["a"])
    (tmp_path / "page_3.html").write_text("<p>\nhi</p>")
    snap = read_snapshots(spark, str(tmp_path)).first()
    assert (snap.page_no, snap.html) == (3, "<p>\nhi</p>")


def test_custom_profile(spark):
    def extract(pages, site, validate=True, **_):
        return pages.select(F.col("page_id").alias("seq"), F.lit(site.domain).alias("source"), F.lit("1").alias("listing_id"),
                            F.lit(None).cast("double").alias("price_numeric"), F.array("url").alias("image_urls"),
                            F.lit(None).cast("map<string,string>").alias("criteria"))

    site = Site("mine", "mine.example", "https://mine.example", "https://mine.example/s", "Mine")
    curated.register_profile("mine", extract, site)
    assert curated.curate(pages(spark), "mine").select("source").first()[0] == "mine.example"


def test_scheduled_run_is_gated_and_repeatable(spark, tmp_path):
    stamp = F.lit("2024-06-01 10:00:00").cast("timestamp")
    rows = curated.curate(pages(spark), "classifieds").withColumn("scraped_at", stamp)
    keep = ListingStore(spark, str(tmp_path / "s"), partitions=4)
    with pytest.raises(ValueError):
        curated.scheduled_run(rows, keep, "day-1", stamp, threshold=100.5)
    assert not keep.exists() or keep.table().count() == 0
    doubled = rows.unionByName(rows.withColumn("seq", F.col("seq") + 100)).unionByName(rows.limit(1).withColumn("title", F.lit("")))
    done = curated.scheduled_run(doubled, keep, "day-1", stamp, min_date="2024-02-01", extra_rules=[Rule("high", F.col("price_numeric") > 3500, 1)])
    assert done.steps == [("read", 9, 0), ("required", 8, 1), ("distinct", 4, 4), ("recent", 3, 1)] and not done.repeated and keep.table().count() == 3
    before = keep.versions()
    again = curated.scheduled_run(doubled, keep, "day-1", stamp, min_date="2024-02-01")
    assert again.repeated and again.steps == done.steps and again.score == done.score and keep.versions() == before
    assert curated.scheduled_run(rows, keep, "day-2", stamp).version == before[-1] + 1 and set(keep.runs()) == {"day-1", "day-2"}


def test_extra_rules_reach_the_written_report(spark, tmp_path):
    out = str(tmp_path / "run")
    curated.run(pages(spark), "classifieds", out, F.lit("2024-06-01").cast("timestamp"), extra_rules=[Rule("cheap", F.col("price_numeric") < 2500, 2)])
    report = spark.read.json(f"{out}/summary_report_classifieds").first()
    assert report.validation.cheap == 2 and report.validation.total_issues >= 1


def test_flatten_with_open_keys(spark):
    rows = spark.range(300).selectExpr("id AS seq", "CAST(id AS STRING) AS listing_id", "map(concat('k', id), 'v', 'common', 'c', 'b', CAST(NULL AS STRING)) AS criteria")
    flat = flatten(rows, max_columns=2)
    assert flat.columns == ["listing_id", "criteria_b", "criteria_common", "criteria_rest"]
    assert {json.loads(r.criteria_rest)[f"k{r.listing_id}"] for r in flat.collect()} == {"v"}
    assert "criteria_rest" not in flatten(rows.limit(3)).columns and criteria_keys(rows).count() == 302
    assert flatten(rows, ["common"], rest=True).where("criteria_rest IS NULL").count() == 0


def test_streams_restart_and_count(spark, tmp_path):
    """A merge stream killed between two arrivals goes on; played again it changes nothing; observed rows add up."""
    def arrive(n, ids):
        rows = [(n * 10 + i, k, "T", f"d{n}", 1.0, "u") for i, k in enumerate(ids)]
        df = spark.createDataFrame(rows, "seq long, listing_id string, title string, description string, price_numeric double, listing_url string")
        df.withColumn("scraped_at", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    stamp = F.lit("2024-02-02").cast("timestamp")
    keep = ListingStore(spark, str(tmp_path / "s"), partitions=4)
    counts = intake.StepCounts()
    spark.streams.addListener(counts)
    for n, ids in enumerate((["a", "b"], ["b", "c"], ["a"])):
        arrive(n, ids)
        stream = intake.read_stream(spark, str(tmp_path / "in")).observe("arrived", F.count(F.lit(1)).alias("rows"))
        intake.stream_merge(stream, keep, stamp, str(tmp_path / "checkpoint")).awaitTermination()
    versions = keep.versions()
    assert {(r.listing_id, r.description) for r in keep.table().collect()} == {("a", "d2"), ("b", "d1"), ("c", "d1")}
    ((name, done),) = keep.runs().items()
    assert done == {"epoch": 3}
    keep.upsert(spark.read.parquet(str(tmp_path / "in")).withColumn("description", F.lit("again")), stamp, run=(name, done))
    assert keep.versions() == versions
    # a new checkpoint is a new stream
    intake.stream_merge(intake.read_stream(spark, str(tmp_path / "in")), keep, stamp, str(tmp_path / "other")).awaitTermination()
    assert len(keep.runs()) == 2 and keep.versions() == [*versions, versions[-1] + 1]
    deadline = time.time() + 20
    while counts.rows.get("arrived", 0) < 5 and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(counts)
    assert counts.rows["arrived"] == 5


def test_stream_dedupe_keeps_the_least_row_and_forgets(spark, tmp_path):
    batches = [[(5, "a", "2024-01-01"), (9, "b", "2024-01-02")], [(2, "a", "2024-01-03"), (7, "b", None)], [(1, "a", "2024-03-01")], [(0, "z", "2025-01-01")]]
    for rows in batches:
        df = spark.createDataFrame(rows, "seq long, listing_id string, t string").selectExpr("seq", "listing_id", "to_timestamp(t) AS at", "map('k', t) AS extra")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = intake.read_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    rows = intake.run_to_table(intake.dedupe_stream(stream, "at", "10 days"), str(tmp_path / "out"), str(tmp_path / "checkpoint")).collect()
    found = sorted((r.listing_id, r.seq, str(r["at"])[:10], r.extra["k"]) for r in rows)
    assert found[0] == ("a", 1, "2024-03-01", "2024-03-01") and found[1] == ("a", 2, "2024-01-03", "2024-01-03") and [f[:2] for f in found[2:]] in ([("b", 7)], [("b", 9)])


def test_pages_of_searches(spark):
    searches = spark.createDataFrame([(1, "https://P.example/fr/sc/villas", "villa", "sale"), (2, "https://p.example/fr/sc/villas/nord", "villa", "rent"), (3, "https://p.example/fr/sc/villas:p:4", "x", "y")],
                                     "search_id long, start_url string, category string, transaction_type string")
    urls = ["https://p.example/fr/sc/villas:p:2", "https://p.example/fr/sc/villas/nord/12?x#y", "https://p.example/fr/sc/villas/sud/", "https://p.example/fr/sc/villas-2", None, "", "https://p.example/fr/sc/villas/nord"]
    found = {r.k: r.search_id for r in with_search(spark.createDataFrame(list(enumerate(urls)), "k long, url string"), searches, "k").collect()}
    assert found == {0: 1, 1: 2, 2: 1, 3: None, 4: None, 5: None, 6: 2}


def test_scratch_tables_are_deleted(spark):
    session.clear_scratch(spark)
    paths = [session.scratch_path(spark, "x") for _ in range(2)]
    spark.range(3).write.parquet(paths[0])
    assert session.clear_scratch(spark) == 2 and not os.path.exists(paths[0]) and session.clear_scratch(spark) == 0


def test_pages_stream_from_a_file_and_from_a_folder(spark, tmp_path):
    from workload.registry import QUERIES

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages.repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    for folder in (str(tmp_path), "/root/testdata/sf0.001"):
        assert QUERIES["stream_extract"](spark, folder).count() == pages.count()


def test_pipeline_stages_bound_the_arrow_batches(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(1, "a b c d e", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        for at_first, want in (("10000", "2048"), ("0", "2048"), ("512", "512")):
            spark.conf.set(name, at_first)
            corpus_pipeline.pack(spark, docs, "")
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
