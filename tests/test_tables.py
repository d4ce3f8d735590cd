"""Table operators against brute force on small fixtures."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from listwright import schemas
from listwright.operators import crawl, curate, quality, report, store
from listwright.operators.store import ListingStore
from listwright.session import cut_lineage


def sequential_dedupe(rows):
    seen, kept = set(), []
    for seq, listing_id, url in sorted(rows):
        if listing_id in seen or url in seen:
            continue
        kept.append(seq)
        seen |= {k for k in (listing_id, url) if k}
    return kept


@pytest.mark.parametrize("seed", range(3))
def test_dedupe_id_or_url_is_the_sequential_result(spark, seed):
    rnd = random.Random(seed)
    ids = ["hot"] * 4 + [f"i{n}" for n in range(6)] + ["", None]
    urls = ["u-hot"] * 4 + [f"u{n}" for n in range(6)] + ["", None]
    rows = [(n, rnd.choice(ids), rnd.choice(urls)) for n in range(60)]
    df = spark.createDataFrame(rows, "seq long, listing_id string, listing_url string").repartition(5)
    got = sorted(r.seq for r in curate.dedupe_id_or_url(df).collect())
    assert got == sequential_dedupe(rows)


@pytest.mark.parametrize("seed", range(2))
def test_dedupe_repeated_order_numbers(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(12), f"i{rnd.randrange(9)}", f"u{rnd.randrange(9)}") for _ in range(50)]
    df = spark.createDataFrame(rows, "seq long, listing_id string, listing_url string").repartition(5)
    seen, want = set(), []
    for row in sorted(set(rows)):
        if not seen & set(row[1:]):
            want.append(row)
            seen |= set(row[1:])
    assert sorted(map(tuple, curate.dedupe_id_or_url(df).collect())) == want


def test_dedupe_where_ids_follow_from_urls(spark, monkeypatch):
    rnd = random.Random(9)
    urls = [rnd.choice(["u-hot", "", None, *(f"u{i}" for i in range(30))]) for _ in range(200)]
    rows = [(n, f"i{abs(hash(u)) % 7}" if u else rnd.choice(["only-id", "", None]), u) for n, u in enumerate(urls)]
    monkeypatch.setattr(curate, "cut_lineage", None)  # no rounds
    df = spark.createDataFrame(rows, "seq long, listing_id string, listing_url string").repartition(5)
    assert sorted(r.seq for r in curate.dedupe_id_or_url(df).collect()) == sequential_dedupe(rows)


def test_dedupe_long_chain(spark, monkeypatch):
    rounds = []

    def counted(df):
        rounds.append(df)
        return df.checkpoint(eager=True)

    cut_lineage(spark.range(1))
    monkeypatch.setattr(curate, "cut_lineage", counted)
    rows = [(n, f"i{(n + 1) // 2}", f"u{n // 2}") for n in range(2000)]
    df = spark.createDataFrame(rows, "seq long, listing_id string, listing_url string").repartition(4)
    assert sorted(r.seq for r in curate.dedupe_id_or_url(df).collect()) == sequential_dedupe(rows)
    assert len(rounds) < 25


def test_dedupe_of_nothing_and_of_rows_without_keys(spark):
    schema = "seq long, listing_id string, listing_url string"
    assert curate.dedupe_id_or_url(spark.createDataFrame([], schema)).count() == 0
    assert curate.dedupe_id_or_url(spark.createDataFrame([(1, None, ""), (1, None, ""), (2, "", None)], schema)).count() == 3


def test_average_price_beyond_usual_amounts(spark):
    df = spark.createDataFrame([(1e15,), (3e15,), (0.0,), (None,)], "price_numeric double")
    assert report.price_stats(df).first()["avg_price"] == 2e15
    df = spark.createDataFrame([(1e300,), (1e300,)], "price_numeric double")
    assert report.price_stats(df).first()["avg_price"] == 1e300


def test_dedupe_first_is_idempotent_and_limits_groups_before_the_shuffle(spark):
    rows = [(n, "hot" if n % 3 else None, float(n)) for n in range(30)]
    df = spark.createDataFrame(rows, "seq long, listing_id string, price double")
    once = curate.dedupe_first(df)
    assert sorted(r.seq for r in once.collect()) == [0, 1]
    assert curate.dedupe_first(once).count() == 2
    assert "WindowGroupLimit" in once._jdf.queryExecution().executedPlan().toString()


def test_min_date_rejects_a_bad_cutoff(spark):
    with pytest.raises(ValueError):
        curate.min_date_posted(spark.range(1), "soon")


@pytest.mark.parametrize("n", [0, 1, 2, 7, 10, 101])
def test_upper_median(spark, n):
    rnd = random.Random(n)
    data = [rnd.choice([rnd.uniform(-5, 5), 250000.0, rnd.uniform(1, 1e7), 0.0]) for _ in range(n)] + [None]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    values = sorted(v for v in data if v is not None)
    assert report.upper_median(df, "v").first()["median"] == (values[n // 2] if n else None)


AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.0, 1 - 2**-53, 1 + 2**-52, 1.7976931348623157e308, 1e15, 250000.01, 2.0, 8.0, 4 - 2**-51, 0.1, float("inf")]


def test_ordered_bits_are_the_doubles_own(spark):
    rnd = random.Random(0)
    values = [s * v for v in AWKWARD for s in (1, -1)] + [rnd.choice([1, -1]) * rnd.random() * 2.0 ** rnd.randint(-1070, 1020) for _ in range(3000)] + [2.0**e for e in range(-1074, 1024)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", report.ordered_bits(F.col("v")).alias("b")).collect()
    for r in got:
        own = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.b == (-own if r.v < 0 else own) and report.number_of_bits(r.b) == r.v
    nan = spark.createDataFrame([(float("nan"),), (float("inf"),)], "v double").agg(F.max(report.ordered_bits(F.col("v")))).first()[0]
    assert nan > 2047 << 52 and report.number_of_bits(nan) != report.number_of_bits(nan)


@pytest.mark.parametrize("values", [[7.5] * 900, [250000 + i / 10_000 for i in range(100_001)], [1e15] * 3 + [1e15 + 1], [-3.0, -1.0, -2.0], [float("nan"), 1.0, 2.0]])
def test_median_of_close_equal_and_large_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "price_numeric double").repartition(6)
    want = sorted(values, key=lambda v: (v != v, v))[len(values) // 2]
    assert report.upper_median(df, "price_numeric").first()["median"] == want
    stats = report.price_stats(df)
    assert stats.first()["median_price"] == want
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortExec" not in plan


def test_report_reads_its_input_three_times(spark, tmp_path):
    rows = [(n, str(n), "T", float(n % 7), "5", f"c{n % 13}", "g", n % 3, "u", f"k{n % 4}") for n in range(200)]
    df = listing_frame(spark, [r[:9] for r in rows]).withColumns({"category": F.concat(F.lit("k"), (F.col("seq") % 4).cast("string")), "location_raw": F.lit("x"), "description": F.lit(""), "date_posted": F.lit(None).cast("string")})
    df.write.parquet(str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(str(tmp_path / "in"))
    watched = source.mapInArrow(counted, source.schema)
    extra = [quality.Rule("no_city_c3", F.col("city") == "c3", 1)]
    rows = report.report_rows(watched, extra)
    doc = report.report_document(rows, None, extra).first()
    assert seen.value == 3 * 200
    assert doc.validation.no_city_c3 == 16 and doc.category_distribution == {f"k{i}": 50 for i in range(4)} and len(doc.top_cities) == 10
    assert doc.price_stats.median_price == 3.0 and doc.image_stats.total_images == sum(n % 3 for n in range(200))


def listing_frame(spark, rows):
    columns = "seq long, listing_id string, title string, price_numeric double, price_raw string, city string, governorate string, image_count int, listing_url string"
    return spark.createDataFrame(rows, columns)


def test_quality_counts_and_score(spark):
    rows = [
        (1, "a", "T", 5.0, "5", "c", "g", 1, "u"),
        (2, "b", "N/A", None, "N/A", "", "g", 0, None),
        (3, "c", "T", 0.0, None, "c", None, None, "u"),
    ]
    df = listing_frame(spark, rows)
    s = quality.quality_summary(df).first()
    assert (s.missing_required_fields, s.invalid_prices, s.missing_images, s.incomplete_location) == (3, 1, 2, 2)
    assert s.total_issues == 8 and s.quality_score == round(100 - (3 * 2 + 1 + 2 * 0.5 + 2) / 30 * 100, 2)
    assert quality.quality_issues(df).count() == 8
    with pytest.raises(ValueError):
        quality.assert_quality(df, 70)
    extra = [quality.Rule("no_seq_3", F.col("seq") == 3, 20)]
    assert quality.quality_summary(df, extra).first().no_seq_3 == 1


def test_empty_table_scores_zero_and_reports_an_error(spark):
    df = listing_frame(spark, []).withColumns({c: F.lit(None).cast("string") for c in ("category", "location_raw", "description", "date_posted")})
    assert quality.quality_summary(df).first().quality_score == 0.0
    doc = report.report_document(report.report_rows(df)).first()
    assert doc.error == "No listings to analyze" and doc.total_listings is None


def prepared(spark, rows):
    columns = "seq long, listing_id string, title string, description string, price_numeric double, listing_url string, scraped_at timestamp"
    df = spark.createDataFrame(rows, "seq long, listing_id string, title string, description string, price_numeric double")
    df = df.withColumns({"listing_url": F.lit("u"), "scraped_at": F.lit("2024-01-01").cast("timestamp")})
    return store.store_prepare(df.select(*(c.split()[0] for c in columns.split(", "))))


def apply_one_by_one(table, rows, update):
    for _seq, key, *values in rows:
        row = dict(zip(("title", "description", "price_numeric"), values))
        if key in table:
            table[key].update({c: row[c] for c in update})
        else:
            table[key] = dict(row)
    return table


@pytest.mark.parametrize("flavour, update", [("narrow", ("description", "price_numeric")), ("full", ("title", "description", "price_numeric"))])
def test_merge_equals_row_by_row_upserts(spark, flavour, update):
    rnd = random.Random(1)
    old = [(n, f"k{n}", f"t{n}", f"d{n}", float(n)) for n in range(6)]
    new = [(n, rnd.choice(["k1", "k2", "n1", "n2", "n3"]), f"T{n}", rnd.choice([None, f"D{n}"]), float(n)) for n in range(20)]
    stamp = F.lit("2024-02-02").cast("timestamp")
    target = store.new_table(prepared(spark, old), stamp)
    merge = {"narrow": store.merge_narrow, "full": store.merge_full}[flavour]
    merged = merge(target, prepared(spark, new).repartition(4), stamp)
    got = {r.listing_id: {"title": r.title, "description": r.description, "price_numeric": float(r.price_numeric)} for r in merged.collect()}
    want = apply_one_by_one({}, old, update)
    assert got == apply_one_by_one(want, new, update)
    again = merge(merged, prepared(spark, new), stamp)
    assert again.drop("criteria", "image_urls").exceptAll(merged.drop("criteria", "image_urls")).isEmpty()


def test_store_versions_switch_and_flavours(spark):
    keep = ListingStore(spark, "listings_test")
    stamp = F.lit("2024-02-02").cast("timestamp")
    rows = [(1, "a", "T", "d", 1.0), (2, "b", "T", "d", 2.0), (3, "a", "T", "e", 3.0)]
    df = spark.createDataFrame(rows, "seq long, listing_id string, title string, description string, price_numeric double")
    df = df.withColumns({"listing_url": F.lit("u"), "scraped_at": F.lit("2024-01-01").cast("timestamp")})
    keep.create()
    assert keep.table().count() == 0
    keep.upsert(df, stamp)
    assert {(r.listing_id, r.description) for r in spark.table("listings_test").collect()} == {("a", "e"), ("b", "d")}
    keep.upsert(df.withColumn("listing_id", F.lit("c")), stamp, "insert")
    keep.upsert(df.withColumn("title", F.lit(None).cast("string")), stamp, "scheduled")
    assert keep.table().count() == 3
    with pytest.raises(Exception, match="NOT NULL"):
        keep.upsert(df.withColumn("title", F.lit(None).cast("string")), stamp)
    assert keep.table().count() == 3
    assert keep.table().columns == schemas.STORED.fieldNames()


def stored_rows(spark, ids, title="T", source=None):
    df = spark.createDataFrame([(i, k, title, f"d{i}", float(i)) for i, k in enumerate(ids)], "seq long, listing_id string, title string, description string, price_numeric double")
    df = df.withColumns({"listing_url": F.lit("u"), "scraped_at": F.lit("2024-01-01").cast("timestamp")})
    return df.withColumn("source", F.lit(source)) if source else df


def test_a_merge_leaves_other_partitions_alone(spark, tmp_path):
    keep = ListingStore(spark, str(tmp_path / "s"), partitions=128)
    stamp = F.lit("2024-02-02").cast("timestamp")
    keep.upsert(stored_rows(spark, [f"k{i}" for i in range(600)]), stamp)
    before = keep._manifest()
    keep.upsert(stored_rows(spark, [f"k{i}" for i in range(0, 600, 100)], "T2"), stamp, "full")
    after = keep._manifest()
    folders = [{(s, p): f for s, p, f in m.parts} for m in (before, after)]
    changed = {k for k in folders[1] if folders[0].get(k) != folders[1][k]}
    assert 0 < len(changed) <= 6 and set(folders[0]) == set(folders[1])
    assert keep.table().where("title = 'T2'").count() == 6 and keep.table().count() == 600
    files = {f.rsplit("/", 2)[1] for f in keep.lookup("k100").inputFiles()}
    assert len(files) == 1 and keep.lookup("k100").first().title == "T2" and keep.lookup("none").count() == 0
    assert keep.table(version=before.version).where("title = 'T2'").count() == 0


def test_the_second_of_two_writers_fails(spark, tmp_path):
    one, two = (ListingStore(spark, str(tmp_path / "s"), partitions=4) for _ in range(2))
    stamp = F.lit("2024-02-02").cast("timestamp")
    one.upsert(stored_rows(spark, ["a", "b"]), stamp)
    base = two._manifest()
    one.upsert(stored_rows(spark, ["c"]), stamp)
    with pytest.raises(store.ConcurrentWrite):
        two._commit(base, base and two.table(), [None], None, None)
    assert two.table().count() == 3 and len(two.versions()) == 3
    gone = two.vacuum(keep=1)
    assert len(gone) >= 1 and len(two.versions()) == 1 and two.table().count() == 3 and two.vacuum(keep=1) == []


def test_keys_scoped_by_source(spark, tmp_path):
    keep = ListingStore(spark, str(tmp_path / "s"), partitions=4, scope="source")
    stamp = F.lit("2024-02-02").cast("timestamp")
    both = stored_rows(spark, ["a", "b", "a"], source="x").unionByName(stored_rows(spark, ["a", "c"], source="y"))
    keep.upsert(both, stamp)
    keep.upsert(stored_rows(spark, ["a", "d"], "T2", source="y"), stamp, "full")
    assert {(r.source, r.listing_id, r.title) for r in keep.table().collect()} == {("x", "a", "T"), ("x", "b", "T"), ("y", "a", "T2"), ("y", "c", "T"), ("y", "d", "T2")}
    assert {f.split("/_s=")[1][0] for f in keep.table("y").inputFiles()} == {"1"} and keep.table("y").count() == 3 and keep.table("z").count() == 0
    assert keep.lookup("a", "x").first().title == "T" and keep.lookup("a").count() == 2
    assert curate.dedupe_first(both, key=["source", "listing_id"]).count() == 4


def test_first_rows_of_crawls(spark):
    rnd = random.Random(4)
    rows = [(c, p, i) for c, pages in ((1, 3000), (2, 5), (3, 2500)) for p in range(1, pages + 1) for i in range(rnd.choice([0, 1, 4, 9]))]
    df = spark.createDataFrame(rows, "crawl_id long, page_no int, link_no int").repartition(7)
    for n in (1, 20, 4999):
        got = sorted(tuple(r) for r in crawl.first_rows(df, "crawl_id", n).collect())
        assert got == [r for c in (1, 2, 3) for r in sorted(x for x in rows if x[0] == c)[:n]]
    plan = crawl.first_rows(df, "crawl_id", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert all("page_no" in line.split("windowspecdefinition")[-1] or "_block" in line for line in plan.splitlines() if "windowspecdefinition" in line)


def test_crawl_pages_parses_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    pages = spark.createDataFrame([(c, p, "<p>", ["u"], p < 4) for c in range(5) for p in range(1, 6)], "crawl_id long, page_no int, html string, links array<string>, has_next boolean")
    pages.write.parquet(str(tmp_path / "p"))
    source = spark.read.parquet(str(tmp_path / "p"))
    taken = crawl.crawl_pages(source.mapInArrow(counted, source.schema))
    assert taken.count() == 20 and seen.value == 25 and "html" not in taken.columns


def sequential_crawl(pages, max_pages, stop_without_news):
    taken, seen, n = [], set(), 1
    while n in pages and not (max_pages and n > max_pages):
        found, has_next = pages[n]
        if not found:
            break
        fresh = [u for u in dict.fromkeys(found) if u not in seen]
        seen |= set(fresh)
        taken += [(n, u) for u in fresh]
        if not has_next or (stop_without_news and not fresh):
            break
        n += 1
    return taken


@pytest.mark.parametrize("seed", range(4))
def test_crawl_equals_reading_page_by_page(spark, seed):
    rnd = random.Random(seed)
    crawls = {}
    for c in range(6):
        numbers = [n for n in range(1, 9) if n != rnd.choice([0, 0, 5])]
        crawls[c] = {n: ([f"u{rnd.randrange(12)}" for _ in range(rnd.choice([0, 2, 3, 3, 3]))], rnd.random() < 0.85) for n in numbers}
    pages = spark.createDataFrame(
        [(c, n, list(dict.fromkeys(urls)), nxt) for c, ps in crawls.items() for n, (urls, nxt) in ps.items()],
        "crawl_id long, page_no int, links array<string>, has_next boolean",
    )
    rows = pages.select("crawl_id", "page_no", F.posexplode("links").alias("link_no", "listing_url")).withColumns(
        {"listing_id": F.col("listing_url"), "seq": F.expr("crawl_id * 10000 + page_no * 100 + link_no")}
    )
    got = crawl.crawl_listings(rows, pages, max_pages=7, stop_without_news=True).collect()
    want = {(c, n, u) for c, ps in crawls.items() for n, u in sequential_crawl(ps, 7, True)}
    assert {(r.crawl_id, r.page_no, r.listing_url) for r in got} == want


def test_rounds_of_the_id_or_url_dedupe_leave_no_spent_tables(spark):
    from listwright import session

    rows = [(n, f"i{n // 2}", f"u{(n + 1) // 2}") for n in range(40)]
    df = spark.createDataFrame(rows, "seq long, listing_id string, listing_url string")
    before = set(session._scratch)
    kept = curate.dedupe_id_or_url(df)
    assert sorted(r.seq for r in kept.collect()) == list(range(0, 40, 2))
    made = [path for path in session._scratch if path not in before]
    # the kept rows of each round, and the empty rest
    assert made and sum(spark.read.parquet(path).count() for path in made) == 20
