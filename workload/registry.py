"""The registered queries: every one reads the given tables or data derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.functions import dates, text, urls, values
from listwright.operators import crawl, curate, document, export, links, quality, report, store
from listwright.plans import classifieds, common, portal, refline
from listwright.plans import curated as curated_plan
from listwright.plans.curated import PROFILES
from listwright.session import scratch_path
from listwright.settings import CLASSIFIEDS, PORTAL, REFLINE
from listwright.sources import exports, pages as page_source, search
from listwright.streaming import intake
from workload.base import listings, table
from workload.pages import detail_pages, result_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-06-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_of() -> Column:
    return F.to_timestamp(F.lit(AS_OF))


def pairs_text(c: str = "criteria") -> Column:
    """A map as sorted key=value text, for comparison."""
    pairs = F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.array_sort(pairs), "|")


def categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).withColumn("category", values.normalise_category(F.col("category_raw")))


# --- listings: curation, quality, report ----------------------------------------


@query
def dedupe_first(spark, sf_dir):
    return curate.dedupe_first(listings(spark, sf_dir)).select("seq", "listing_id", "title", "price_numeric")


@query
def dedupe_id_url(spark, sf_dir):
    return curate.dedupe_id_or_url(listings(spark, sf_dir)).select("seq", "listing_id", "listing_url")


@query
def dedupe_id_url_chain(spark, sf_dir):
    """Re-listings in chains: each line shares its id with one neighbour and its URL with the other.

    Both sources repeat the same order numbers; some lines share one id or one
    URL over all orders, some have neither.
    """
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS g", "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n")
    chains = lines.selectExpr(
        "'chain' AS kind", "g", "n", "IF(g % 2 = 0, g * 100 + n, g * 100 + 50 - n) AS seq",
        "concat(g, '-', n div 2) AS listing_id", "concat(g, '-u', (n + 1) div 2) AS listing_url")
    hot_id = lines.where("n = 1").selectExpr("'id' AS kind", "g", "n", "g AS seq", "'hot' AS listing_id", "concat('i', g) AS listing_url")
    hot_url = lines.where("n = 1").selectExpr("'url' AS kind", "g", "n", "g AS seq", "IF(g % 3 = 0, '', concat('h', g)) AS listing_id", "'hot' AS listing_url")
    blank = lines.where("n = 2").selectExpr("'blank' AS kind", "g", "n", "g AS seq", "CAST(NULL AS STRING) AS listing_id", "'' AS listing_url")
    one = curate.union_sources(chains, hot_id, hot_url, blank)
    other = one.selectExpr("concat('b-', kind) AS kind", "g", "n", "seq", "IF(listing_id = '', '', concat('b', listing_id)) AS listing_id", "IF(listing_url = '', '', concat('b', listing_url)) AS listing_url")
    return curate.dedupe_id_or_url(one.unionByName(other))


@query
def normalise_listings(spark, sf_dir):
    rows = listings(spark, sf_dir).withColumn(
        "criteria", F.create_map(F.lit("pool"), F.when(F.col("rooms") > 3, "oui").otherwise(""), F.lit("vue"), F.lit(""))
    ).withColumn("image_urls", F.when(F.col("image_count") > 0, F.array("listing_url")))
    return curate.normalise_listings(rows).select(
        "seq", "listing_id", "price_numeric", pairs_text().alias("criteria"), F.size("image_urls").alias("images")
    )


@query
def normalise_category(spark, sf_dir):
    return categorised(spark, sf_dir).select("seq", "category_raw", "category")


@query
def required_filter(spark, sf_dir):
    return curate.required_filter(listings(spark, sf_dir)).select("seq", "title", "listing_url", "price_raw")


@query
def min_date(spark, sf_dir):
    return curate.min_date_posted(listings(spark, sf_dir), "1997-01-01").select("seq", "date_posted")


@query
def date_parse(spark, sf_dir):
    return listings(spark, sf_dir).select("seq", "date_posted", dates.parse_posted(F.col("date_posted")).alias("posted"))


@query
def completeness(spark, sf_dir):
    return report.completeness(categorised(spark, sf_dir))


@query
def price_stats(spark, sf_dir):
    return report.price_stats(listings(spark, sf_dir))


@query
def category_dist(spark, sf_dir):
    return report.category_distribution(categorised(spark, sf_dir))


@query
def top_cities(spark, sf_dir):
    return report.top_cities(listings(spark, sf_dir))


@query
def image_stats(spark, sf_dir):
    return report.image_stats(listings(spark, sf_dir))


@query
def quality_issues(spark, sf_dir):
    return quality.quality_issues(listings(spark, sf_dir))


@query
def issue_counts(spark, sf_dir):
    return quality.issue_counts(listings(spark, sf_dir))


@query
def quality_score(spark, sf_dir):
    return quality.quality_summary(curate.dedupe_first(listings(spark, sf_dir)))


@query
def quality_custom_rule(spark, sf_dir):
    extra = [quality.Rule("tiny_surface", F.col("surface") < 9, 1)]
    return quality.quality_summary(listings(spark, sf_dir), extra)


@query
def quality_gate(spark, sf_dir):
    rows = listings(spark, sf_dir)
    score = quality.assert_quality(rows)
    return quality.quality_score(rows).withColumn("passed_with", F.lit(score))


@query
def report_full(spark, sf_dir):
    return report.report_rows(categorised(spark, sf_dir))


@query
def report_doc(spark, sf_dir):
    doc = report.report_document(report.report_rows(categorised(spark, sf_dir)), {"min_date_posted": "1997-01-01"})
    return doc.select(
        "total_listings",
        F.col("field_completeness")["title"]["count"].alias("titles"),
        F.col("price_stats.median_price").alias("median_price"),
        F.col("category_distribution")["ferme"].alias("no_such_category"),
        F.col("category_distribution")["Ferme"].alias("farms"),
        F.size("top_cities").alias("cities"),
        F.col("validation.quality_score").alias("quality_score"),
        F.col("filters")["min_date_posted"].alias("min_date_posted"),
    )


@query
def price_per_sqm(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return rows.select("seq", curate.price_per_sqm(rows).alias("price_per_sqm"))


def _with_criteria(rows: DataFrame) -> DataFrame:
    criteria = F.map_filter(
        F.create_map(
            F.lit("surface"), F.col("surface").cast("string"),
            F.lit("floor"), F.when(F.col("seq") % 3 == 0, (F.col("seq") % 12).cast("string")),
            F.lit("options"), F.when(F.col("seq") % 4 == 0, F.lit('["Garage"]')),
        ),
        lambda _k, v: v.isNotNull(),
    )
    return rows.withColumns({"criteria": criteria, "image_urls": F.array("listing_url")})


@query
def flatten(spark, sf_dir):
    rows = _with_criteria(listings(spark, sf_dir)).withColumn("n", F.col("seq"))
    return export.flatten(rows).drop("scraped_at")


@query
def union_sources(spark, sf_dir):
    rows = categorised(spark, sf_dir)
    first = rows.where("seq % 2 = 0").select("seq", "title", F.lit("a").alias("source"), "price_numeric")
    second = rows.where("seq % 2 = 1").select("seq", "title", F.lit("b").alias("source"), F.col("city"))
    return curate.union_sources(first, second)


# --- store -------------------------------------------------------------------------


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = categorised(spark, sf_dir).withColumn(
        "criteria",
        F.map_filter(
            F.create_map(
                F.lit("surface"), F.lit("77.5"), F.lit("rooms"), F.lit("4.0"),
                F.lit("floor"), F.when(F.col("seq") % 3 == 0, (F.col("seq") % 12).cast("string")),
                F.lit("furnished"), F.when(F.col("seq") % 4 == 0, F.lit("true")),
            ),
            lambda _k, v: v.isNotNull(),
        ),
    )
    return store.store_prepare(rows)


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = store.split_valid(prepared(spark, sf_dir))
    return store.new_table(valid, F.to_timestamp(F.lit("2020-01-01 00:00:00")))


def seen_listings(events: DataFrame) -> DataFrame:
    """Observations as listings: known keys, new keys, repeated keys."""
    known = (F.col("user_id") * 90).cast("string")
    return events.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("N"), F.col("user_id").cast("string"))).otherwise(known).alias("listing_id"),
        F.concat(F.lit("Seen "), "event_type").alias("title"),
        F.concat_ws(" ", "event_type", "props").alias("description"),
        F.col("event_type").alias("category"),
        F.col("value").alias("price_numeric"),
        F.concat(F.lit("https://listings.example/e/"), F.col("event_id").cast("string")).alias("listing_url"),
        F.lit("EUR").alias("currency"),
        F.col("ts").alias("scraped_at"),
        F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("criteria"),
    )


def batch(events: DataFrame) -> DataFrame:
    return store.store_prepare(seen_listings(events))


def flat(stored: DataFrame) -> DataFrame:
    """Stored rows in plain columns, for comparison."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    return stored.select(
        "listing_id", "title", "description", "category",
        F.col("price_numeric").cast("double").alias("price_numeric"), "currency", "listing_url",
        F.date_format("scraped_at", stamp).alias("scraped_at"),
        F.date_format("created_at", stamp).alias("created_at"),
        F.date_format("updated_at", stamp).alias("updated_at"),
        F.col("criteria")["k"].alias("criteria_k"),
    )


@query
def store_prepare(spark, sf_dir):
    return prepared(spark, sf_dir).select(
        "seq", "listing_id", F.col("price_numeric").cast("double").alias("price_numeric"),
        F.col("surface").cast("double").alias("surface"), "rooms", "bedrooms", "floor", "furnished",
        "image_count", "date_posted",
    )


@query
def store_rejects(spark, sf_dir):
    return store.split_valid(prepared(spark, sf_dir))[1].select("seq", "listing_id", "violations")


@query
def merge_narrow(spark, sf_dir):
    return flat(store.merge_narrow(target(spark, sf_dir), batch(table(spark, sf_dir, "events")), as_of()))


@query
def merge_full(spark, sf_dir):
    return flat(store.merge_full(target(spark, sf_dir), batch(table(spark, sf_dir, "events")), as_of()))


@query
def merge_scheduled(spark, sf_dir):
    return flat(store.merge_scheduled(target(spark, sf_dir), batch(table(spark, sf_dir, "events")), as_of()))


@query
def insert_new(spark, sf_dir):
    return flat(store.insert_new(target(spark, sf_dir), batch(table(spark, sf_dir, "events")), as_of()))


@query
def store_by_id(spark, sf_dir):
    return flat(store.by_id(target(spark, sf_dir), "123"))


@query
def store_by_city(spark, sf_dir):
    return flat(store.by_city(target(spark, sf_dir), "NATION_17"))


@query
def store_recent(spark, sf_dir):
    return flat(store.recent(target(spark, sf_dir), 100))


@query
def store_stats(spark, sf_dir):
    return store.totals(target(spark, sf_dir)).select(
        "total_listings", F.round("avg_price", 2).alias("avg_price"),
        F.date_format("latest_scrape", "yyyy-MM-dd HH:mm:ss").alias("latest_scrape"),
    )


@query
def store_by_category(spark, sf_dir):
    return store.count_by_category(target(spark, sf_dir))


@query
def store_top_cities(spark, sf_dir):
    return store.top_cities(target(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str, purpose: str) -> store.ListingStore:
    """A stored table below the shared folder, filled with the target."""
    keep = store.ListingStore(spark, scratch_path(spark, purpose), partitions=16)
    keep.write(target(spark, sf_dir))
    return keep


@query
def store_upsert_read(spark, sf_dir):
    """A batch merged into the stored table, and the table read back."""
    keep = stored(spark, sf_dir, "store-upsert")
    keep.upsert(seen_listings(table(spark, sf_dir, "events")), as_of())
    return flat(keep.table())


@query
def store_lookup_stored(spark, sf_dir):
    """One listing of the stored table after a merge; only its partition is read."""
    keep = stored(spark, sf_dir, "store-lookup")
    keep.upsert(seen_listings(table(spark, sf_dir, "events")), as_of(), "full")
    return flat(keep.lookup("900"))


@query
def union_scoped(spark, sf_dir):
    """Two sources that share listing ids, kept apart through dedupe, merge and store."""
    rows = categorised(spark, sf_dir)
    first, second = rows.where("seq % 3 <> 0").withColumn("source", F.lit("one")), rows.where("seq % 2 = 0").withColumn("source", F.lit("two"))
    keys = ["source", "listing_id"]
    both = curate.dedupe_first(curate.union_sources(first, second), key=keys).where("listing_url IS NOT NULL")
    keep = store.ListingStore(spark, scratch_path(spark, "store-scoped"), partitions=8, scope="source")
    keep.write(store.new_table(store.store_prepare(both.where("source = 'one' OR seq % 4 = 0"), "source"), as_of(), key=keys))
    keep.upsert(both.where("source = 'two'").withColumn("description", F.concat("description", F.lit(" again"))), as_of())
    return keep.table("one").unionByName(keep.table("two")).select(
        "source", "listing_id", "title", "description", F.col("price_numeric").cast("double").alias("price_numeric"))


@query
def scheduled_run(spark, sf_dir):
    """The daily load, done twice under the same id: the second time changes nothing."""
    keep = store.ListingStore(spark, scratch_path(spark, "store-scheduled"), partitions=16)
    rows = categorised(spark, sf_dir)
    valid, _ = store.split_valid(store.store_prepare(rows.where("seq % 2 = 0")))
    keep.write(store.new_table(valid, F.to_timestamp(F.lit("2020-01-01 00:00:00"))))
    changed = rows.withColumn("description", F.concat("description", F.lit(" v2")))
    for _ in range(2):
        curated_plan.scheduled_run(changed, keep, "2024-06-01", as_of())
    return flat(keep.table())


@query
def step_counts(spark, sf_dir):
    """Rows that each step of the curation keeps and removes, counted while they pass."""
    steps = curated_plan.write_counted(listings(spark, sf_dir), scratch_path(spark, "step-counts"), "1997-01-01")
    return spark.createDataFrame(steps, "step string, rows long, removed long")


@query
def flatten_open(spark, sf_dir):
    """More criteria keys than columns: one key of its own in each listing, kept in the rest column."""
    rows = listings(spark, sf_dir).select(
        "seq", "listing_id", "surface",
        F.create_map(F.concat(F.lit("k"), F.col("seq").cast("string")), F.lit("x"), F.lit("floor"), (F.col("seq") % 12).cast("string"), F.lit("vue"), F.lit("mer")).alias("criteria"))
    return export.flatten(rows, ["floor", "surface"], rest=True)


# --- documents: text functions -------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


@query
def ascii_fold(spark, sf_dir):
    return documents(spark, sf_dir, text.ascii_fold(F.col("text")).alias("folded"))


@query
def normalise_label(spark, sf_dir):
    c = F.col("text")
    return documents(spark, sf_dir, text.refline_label(c).alias("refline"), text.portal_label(c).alias("portal"))


@query
def slugify(spark, sf_dir):
    return documents(spark, sf_dir, text.slug_path(F.col("text")).alias("slug"))


@query
def parse_boolean(spark, sf_dir):
    return documents(spark, sf_dir, values.parse_boolean(F.col("text")).alias("affirmed"))


@query
def criteria_key(spark, sf_dir):
    return documents(spark, sf_dir, values.criteria_key(F.col("text")).alias("key"))


# --- given pages -----------------------------------------------------------------------


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document.with_document(table(spark, sf_dir, "pages"))


@query
def pages_scan(spark, sf_dir):
    rows = page_source.read_pages(spark, f"{sf_dir}/pages.parquet")
    return rows.select("page_id", "url", F.length("html").cast("bigint").alias("chars"))


@query
def title(spark, sf_dir):
    p, e = F.col("pieces"), F.col("elements")
    return parsed_pages(spark, sf_dir).select("page_id", common.page_title(p, e, CLASSIFIEDS, False).alias("title"))


@query
def text_lines(spark, sf_dir):
    lines = document.text_lines(F.col("pieces"))
    return parsed_pages(spark, sf_dir).select("page_id", F.posexplode(lines).alias("line_no", "line"))


@query
def nodes_first(spark, sf_dir):
    """First element by selector: the advert box, and the number of elements."""
    box = document.find(F.col("elements"), "div", "p", where=document.attr_matches("class", r"^ad"))
    return parsed_pages(spark, sf_dir).select(
        "page_id", document.text_of(F.col("pieces"), box).alias("box_text"),
        F.size(document.find_all(F.col("elements"), "a", "li")).alias("nav_elements"),
    )


@query
def nodes_rows(spark, sf_dir):
    rows = document.nodes(table(spark, sf_dir, "pages"))
    return rows.where("tag IN ('h1', 'title')").select("page_id", "tag", "text")


@query
def resolve_url(spark, sf_dir):
    hrefs = links.hrefs(F.col("elements"))
    found = parsed_pages(spark, sf_dir).select("page_id", F.posexplode(hrefs).alias("link_no", "href"))
    return found.select("page_id", "link_no", urls.resolve_url(F.col("href"), CLASSIFIEDS.base_url).alias("url"))


@query
def listing_id(spark, sf_dir):
    rows = parsed_pages(spark, sf_dir)
    return rows.select(
        "page_id",
        classifieds.listing_id(F.col("url"), F.col("elements"), CLASSIFIEDS).alias("classifieds_id"),
        refline.listing_id(F.col("url"), document.joined_text(F.col("pieces"), " "), REFLINE).alias("refline_id"),
        portal.listing_id(F.col("url"), PORTAL).alias("portal_id"),
    )


@query
def site_lookup(spark, sf_dir):
    rows = detail_pages(spark, sf_dir, "classifieds").select("seq", "url").unionByName(
        detail_pages(spark, sf_dir, "portal").select("seq", "url")
    ).unionByName(table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), "url"))
    return page_source.with_source(rows).groupBy("source").agg(F.count(F.lit(1)).alias("pages"))


# --- generated detail pages ----------------------------------------------------------------


def _extracted(profile: str, *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = PROFILES[profile](detail_pages(spark, sf_dir, profile), validate=not columns, fields=columns or None)
        if columns:
            rows = rows.select(*columns)
        plain = {}
        if "criteria" in rows.columns:
            plain["criteria"] = pairs_text()
        if "image_urls" in rows.columns:
            plain["image_urls"] = F.array_join("image_urls", "|")
        return rows.withColumns(plain).drop("scraped_at") if plain else rows.drop("scraped_at")

    return run


# name -> (profile, columns); no columns means the whole validated record
EXTRACTIONS = {
    "extract_p1": ("classifieds",),
    "extract_p2": ("refline",),
    "extract_p3": ("portal",),
    "price_p1": ("classifieds", "seq", "price_raw", "price_numeric", "currency"),
    "price_p2": ("refline", "seq", "price_raw", "price_numeric", "currency"),
    "price_p3": ("portal", "seq", "price_raw", "price_numeric", "currency"),
    "title_p1": ("classifieds", "seq", "title"),
    "title_p3": ("portal", "seq", "title"),
    "listing_id_p1": ("classifieds", "seq", "listing_url", "listing_id"),
    "listing_id_p2": ("refline", "seq", "listing_url", "listing_id"),
    "listing_id_p3": ("portal", "seq", "listing_url", "listing_id"),
    "category_p1": ("classifieds", "seq", "category"),
    "category_p2": ("refline", "seq", "category"),
    "transaction_p2": ("refline", "seq", "transaction_type"),
    "location_p1": ("classifieds", "seq", "location_raw", "city", "governorate", "neighborhood"),
    "location_p2": ("refline", "seq", "location_raw", "city", "governorate", "neighborhood"),
    "location_p3": ("portal", "seq", "location_raw", "city", "governorate", "neighborhood"),
    "description_p1": ("classifieds", "seq", "description"),
    "description_p2": ("refline", "seq", "description"),
    "description_p3": ("portal", "seq", "description"),
    "date_posted_p1": ("classifieds", "seq", "date_posted"),
    "date_posted_p2": ("refline", "seq", "date_posted"),
    "date_posted_p3": ("portal", "seq", "date_posted"),
    "criteria_p1": ("classifieds", "seq", "criteria", "surface", "rooms", "bedrooms"),
    "criteria_p2": ("refline", "seq", "criteria", "surface", "rooms", "bedrooms", "bathrooms", "furnished"),
    "criteria_p3": ("portal", "seq", "criteria", "surface", "rooms", "bedrooms", "bathrooms", "floor", "furnished"),
    "images_p1": ("classifieds", "seq", "image_urls", "image_count"),
    "images_p2": ("refline", "seq", "image_urls", "image_count"),
    "images_p3": ("portal", "seq", "image_urls", "image_count"),
}
for _name, (_profile, *_columns) in EXTRACTIONS.items():
    QUERIES[_name] = _extracted(_profile, *_columns)


@query
def next_data(spark, sf_dir):
    """Embedded records alone: no page is parsed."""
    pages = detail_pages(spark, sf_dir, "classifieds")
    ready = classifieds.embedded_record(classifieds.embedded_script(F.col("html")))
    return pages.select("seq", ready.alias("r")).where("r IS NOT NULL").select(
        "seq", "r.listing_id", "r.title", "r.price_raw", "r.price_numeric", "r.location_raw", "r.date_posted"
    )


@query
def price_readings(spark, sf_dir):
    """Price elements read by both rules, and whether these differ."""
    doc = document.with_document(detail_pages(spark, sf_dir, "classifieds").select("seq", "html"))
    return doc.select("seq", classifieds.price_readings(F.col("pieces"), F.col("elements")).alias("r")).select("seq", "r.digits", "r.plain", "r.differ")


@query
def section_slice(spark, sf_dir):
    doc = document.with_document(detail_pages(spark, sf_dir, "portal").select("seq", "html"))
    lines = doc.select("seq", document.text_lines(F.col("pieces")).alias("lines")).withColumn(
        "labels", text.normalise_lines(F.col("lines"), text.PORTAL_KEEP)
    )
    cut = document.section(F.col("lines"), F.col("labels"), ("caracteristiques generales",), ("voir la carte",))
    return lines.select("seq", F.array_join(cut, "|").alias("section"))


@query
def options(spark, sf_dir):
    doc = document.with_document(detail_pages(spark, sf_dir, "refline").select("seq", "html"))
    lines = doc.select("seq", document.text_lines(F.col("pieces")).alias("lines")).withColumn(
        "labels", text.normalise_lines(F.col("lines"), text.REFLINE_KEEP)
    )
    return lines.select("seq", F.array_join(refline.options(F.col("lines"), F.col("labels")), "|").alias("options"))


@query
def date_parse_fr(spark, sf_dir):
    """French dates with two-digit years, written from the order dates."""
    day = F.col("o_orderdate")
    short = F.date_format(day, "dd/MM/yy")
    shifted = F.concat(F.date_format(day, "d/M/"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))
    rows = table(spark, sf_dir, "orders")
    return rows.select(
        F.col("o_orderkey").alias("seq"), dates.parse_french(short).alias("posted"),
        F.year(dates.parse_french(shifted)).alias("year"),
    )


@query
def parse_number(spark, sf_dir):
    """Amounts written with spaces, commas and dots."""
    whole = F.floor("o_totalprice").cast("bigint").cast("string")
    n = F.col("o_orderkey") % 4
    written = (
        F.when(n == 0, F.concat(whole, F.lit(",5")))
        .when(n == 1, F.concat(F.lit("1.250."), whole))
        .when(n == 2, F.concat(F.lit("A partir de "), whole, F.lit(" 000")))
        .otherwise(F.concat(F.lit(" "), whole, F.lit(".25 ")))
    )
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), written.alias("w"))
    c = F.col("w")
    return rows.select(
        "seq", values.number_dotted(c).alias("dotted"), values.number_spoken(c).alias("spoken"),
        values.number_plain(c).alias("plain"), values.number_of_digits(c).alias("digits"),
        values.first_count(c).alias("first_count"),
    )


@query
def currency(spark, sf_dir):
    symbols = F.array(*map(F.lit, ("TND", "DT", "dt", "Dt", "EUR", "€", "USD", "$", "euro", "gbp")))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("seq"), F.get(symbols, (F.col("o_orderkey") % 10).cast("int")).alias("symbol")
    )
    c = F.col("symbol")
    return rows.select(
        "seq", "symbol", values.currency_code(c).alias("exact"), values.currency_code_any_case(c).alias("any_case"),
        values.currency_mentioned(F.concat(F.lit("5 "), c)).alias("mentioned"),
    )


# --- result pages ------------------------------------------------------------------------------


def _links(profile: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = links.read_result_pages(result_pages(spark, sf_dir, profile), profile, paging=False)
        return links.link_rows(found, "crawl_id", "page_no")

    return run


for _i, _profile in enumerate(PROFILES, 1):
    QUERIES[f"links_p{_i}"] = _links(_profile)


@query
def has_next(spark, sf_dir):
    parts = [
        links.read_result_pages(result_pages(spark, sf_dir, p), p).select(F.lit(p).alias("profile"), "k", "has_next")
        for p in ("classifieds", "refline", "portal")
    ]
    return curate.union_sources(*parts)


@query
def crawl_extent(spark, sf_dir):
    found = links.read_result_pages(result_pages(spark, sf_dir, "classifieds"), "classifieds")
    return crawl.crawl_pages(found, max_pages=6).select("crawl_id", "page_no", F.size("links").alias("links"))


@query
def crawl_listings(spark, sf_dir):
    """Listings of each crawl: first-come, at most twenty, only reached pages."""
    found = links.read_result_pages(result_pages(spark, sf_dir, "classifieds"), "classifieds")
    path = scratch_path(spark, "result-pages")
    found.select("crawl_id", "page_no", "links", "has_next").write.parquet(path)
    found = spark.read.parquet(path)
    rows = links.link_rows(found, "crawl_id", "page_no").select(
        "crawl_id", "page_no", "link_no", F.col("url").alias("listing_url"),
        F.regexp_extract("url", r"/x/([0-9]+)/", 1).alias("listing_id"),
        (F.col("crawl_id") * 10000 + F.col("page_no") * 100 + F.col("link_no")).alias("seq"),
    )
    taken = crawl.crawl_listings(rows, found, sample_size=20, stop_without_news=True)
    return taken.select("crawl_id", "page_no", "link_no", "listing_url")


@query
def crawl_sample(spark, sf_dir):
    """The first 5,000 listings of each crawl; one crawl has a third of all pages."""
    pages = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "IF(o_orderkey % 3 = 0, -1, o_orderkey div 24) AS crawl_id",
        "CAST(IF(o_orderkey % 3 = 0, o_orderkey div 3, (o_orderkey % 24) div 3 * 2 + o_orderkey % 3 - 1) + 1 AS INT) AS page_no")
    found = pages.selectExpr("crawl_id", "page_no", "k", "transform(sequence(0, CAST(k % 7 AS INT)), i -> IF(i = 0, concat('u', k div 6), concat('u', k, '-', i))) AS links",
                             "crawl_id < 0 OR k % 89 <> 0 AS has_next")
    rows = links.link_rows(found, "crawl_id", "page_no").selectExpr(
        "crawl_id", "page_no", "link_no", "url AS listing_url", "CAST(NULL AS STRING) AS listing_id", "page_no * 100L + link_no AS seq")
    return crawl.crawl_listings(rows, found, sample_size=5000).select("crawl_id", "page_no", "link_no", "listing_url")


@query
def links_join_pages(spark, sf_dir):
    found = links.read_result_pages(result_pages(spark, sf_dir, "classifieds"), "classifieds")
    rows = links.link_rows(found, "crawl_id", "page_no")
    details = table(spark, sf_dir, "orders").select(
        F.concat(F.lit(f"{CLASSIFIEDS.base_url}/item/x/"), F.col("o_orderkey").cast("string"), F.lit("/")).alias("url"),
        F.col("o_orderkey").alias("page_id"),
    )
    return links.join_detail_pages(rows, details, ["crawl_id", "page_no", "link_no"])


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
    customers = customers.join(table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
    return customers.select(
        F.col("c_custkey").alias("search_id"),
        F.concat_ws("/", F.initcap("r_name"), F.concat(F.lit("Cité "), F.initcap("n_name"))).alias("location"),
        F.expr("CASE c_custkey % 4 WHEN 0 THEN 'ct' WHEN 1 THEN 'sc' WHEN 2 THEN '' ELSE 'cd' END").alias("level"),
        F.expr("CASE WHEN c_custkey % 10 = 0 THEN '/fr/ct/special:p:3' END").alias("explicit_url"),
    )


@query
def seed_urls(spark, sf_dir):
    grid = search.search_grid(searches(spark, sf_dir), ["vente", "Louer"], ["logement", "Terrain", "villa"])
    return grid.select("search_id", "transaction_type", "category", "start_url")


@query
def portal_searched(spark, sf_dir):
    """Category and transaction of portal listings, from the search whose result page they were found on."""
    grid = search.search_grid(searches(spark, sf_dir), ["vente", "Louer"], ["logement", "Terrain"])
    path = scratch_path(spark, "searches")
    grid.select("search_id", "transaction_type", "category", "start_url").write.parquet(path)
    grid = spark.read.parquet(path)
    # the page an advert was found on: a search's result page, one below it, or one of no search
    customers = table(spark, sf_dir, "customer").count()
    firsts = grid.where("category = 'land'").select(F.col("search_id").alias("s"), F.col("start_url").alias("start"), F.col("transaction_type").alias("t"))
    found_on = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS seq", f"o_orderkey % {customers} + 1 AS s", "IF(o_orderkey % 2 = 0, 'sale', 'rent') AS t").join(firsts, ["s", "t"], "left")
    found_on = found_on.selectExpr("seq", """CASE seq % 5 WHEN 0 THEN concat(start, ':p:', seq % 9 + 2) WHEN 1 THEN concat(start, '/quartier-', seq, '?x=1')
        WHEN 2 THEN 'https://www.portal.example/fr/elsewhere' WHEN 3 THEN concat(start, '-autre') ELSE start END AS found_on""")
    attached = search.with_search(found_on, grid, "seq", "found_on")
    extracted = portal.extract(detail_pages(spark, sf_dir, "portal"), validate=False, category=None, transaction=None).select("seq", "listing_id")
    return extracted.join(attached, "seq").select("seq", "listing_id", "search_id", "category", "transaction_type")


@query
def page_urls(spark, sf_dir):
    grid = search.search_grid(searches(spark, sf_dir), ["sale"], ["bureau"])
    n = (F.col("search_id") % 5 + 1).cast("int")
    parts = [
        search.page_urls(grid, n, p).select(F.lit(p).alias("profile"), "search_id", "page_no", "page_url")
        for p in ("classifieds", "refline", "portal")
    ]
    return curate.union_sources(*parts)


# --- files -----------------------------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    rows = _with_criteria(listings(spark, sf_dir)).select(
        "listing_id", "title", "price_numeric", "city", "governorate", "description", "date_posted", "criteria", "image_urls", "seq"
    ).withColumn("n", F.col("seq"))
    path = scratch_path(spark, "csv")
    keys = ["floor", "options", "surface"]
    export.write_csv(rows, path, keys)
    return exports.read_csv(spark, path, export.flatten(rows, keys).schema)


@query
def json_roundtrip(spark, sf_dir):
    rows = listings(spark, sf_dir).select("listing_id", "title", "price_numeric", "city", "governorate", "image_count")
    rows = rows.withColumn("image_urls", F.array("listing_id"))
    path = scratch_path(spark, "json")
    export.write_json_lines(rows, path, "listings.example", as_of())
    back = exports.read_json_lines(spark, f"{path}/listings", rows.schema)
    return back.withColumn("image_urls", F.array_join("image_urls", "|"))


@query
def json_envelope(spark, sf_dir):
    """Exports as documents {metadata, listings}, a thousand listings each, read back as listings."""
    rows = listings(spark, sf_dir).select("seq", "listing_id", "title", "price_numeric", "image_count").withColumn("image_urls", F.array("listing_id"))
    groups = rows.groupBy(F.expr("seq div 1000").alias("batch")).agg(F.collect_list(F.struct(*rows.columns)).alias("listings"))
    metadata = F.struct(F.lit("2024-06-01T00:00:00").alias("export_timestamp"), F.size("listings").cast("long").alias("total_listings"), F.lit("listings.example").alias("source"))
    path = scratch_path(spark, "envelopes")
    groups.select("batch", F.to_json(F.struct(metadata.alias("metadata"), "listings")).alias("value")).write.partitionBy("batch").text(path)
    back = exports.read_json_envelope(spark, path, rows.schema)
    return back.withColumn("image_urls", F.array_join("image_urls", "|"))


@query
def report_file(spark, sf_dir):
    """The report with an extra rule, written to its file and read back."""
    extra = [quality.Rule("tiny_surface", F.col("surface") < 9, 1)]
    rows = report.report_rows(categorised(spark, sf_dir), extra)
    path = scratch_path(spark, "report")
    export.write_report(report.report_document(rows, None, extra), path)
    return spark.read.json(path).select("total_listings", "price_stats.median_price", "validation.tiny_surface", "validation.total_issues", "validation.quality_score", "image_stats.total_images")


def _titles(pages: DataFrame, site, validate: bool = True, **_) -> DataFrame:
    """A custom extractor: title and link count of any page."""
    doc = document.with_document(pages)
    return doc.select(
        F.col("page_id").alias("seq"), F.lit(site.domain).alias("source"), F.md5("url").alias("listing_id"), F.col("url").alias("listing_url"),
        common.page_title(F.col("pieces"), F.col("elements"), site, False).alias("title"), F.lit(None).cast("double").alias("price_numeric"),
        F.array().cast("array<string>").alias("image_urls"), F.lit(None).cast("map<string,string>").alias("criteria"))


@query
def custom_profile(spark, sf_dir):
    """A run over the given pages with a custom extractor and a custom export format."""
    curated_plan.register_profile("titles", _titles, CLASSIFIEDS)
    curated_plan.register_exporter("titles", lambda listings, path, site, exported_at: listings.select("seq", "listing_id", "title").write.parquet(f"{path}_titles"))
    rows = curated_plan.curate(table(spark, sf_dir, "pages"), "titles")
    path = scratch_path(spark, "custom")
    curated_plan.EXPORTERS["titles"](rows, f"{path}/{CLASSIFIEDS.file_prefix}", CLASSIFIEDS, as_of())
    return spark.read.parquet(f"{path}/{CLASSIFIEDS.file_prefix}_titles")


# --- streams ------------------------------------------------------------------------------------------


@query
def stream_extract(spark, sf_dir):
    base = scratch_path(spark, "stream-extract")
    stream = intake.read_stream(spark, f"{sf_dir}/pages.parque[t]")
    run = intake.stream_extract(
        stream, lambda pages: classifieds.extract(pages, validate=False), f"{base}/out", f"{base}/checkpoint"
    )
    run.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("seq", "listing_url", "listing_id", "title")


def arrivals(spark: SparkSession, sf_dir: str, base: str, parts: range) -> None:
    """Some of four arrivals of events, as files in the order they come."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    for i in parts:
        events.where(F.floor(F.col("event_id") * 4 / (last + 1)) == i).coalesce(1).write.mode("append").parquet(base)


@query
def stream_dedupe(spark, sf_dir):
    """The first event of each user, whole, though the arrivals come in reverse."""
    base = scratch_path(spark, "stream-dedupe")
    arrivals(spark, sf_dir, f"{base}/in", range(3, -1, -1))
    # a last event far ahead moves the watermark beyond all windows
    table(spark, sf_dir, "events").limit(1).withColumns({"user_id": F.lit(None).cast("long"), "ts": F.col("ts") + F.expr("INTERVAL 1000 DAYS")}).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = intake.read_stream(spark, f"{base}/in", files_per_trigger=1).withColumn("listing_id", F.col("user_id").cast("string"))
    ticking = stream.withColumn("listing_id", F.coalesce("listing_id", F.lit("tick")))
    kept = intake.dedupe_stream(ticking, "ts", "200 days", order="event_id")
    rows = intake.run_to_table(kept, f"{base}/out", f"{base}/checkpoint")
    return rows.where("listing_id <> 'tick'").select("listing_id", "event_id", "event_type", "value", "props", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@query
def stream_merge(spark, sf_dir):
    """Four arrivals of events merged into the stored table by a stream that is stopped and started again half way."""
    base = scratch_path(spark, "stream-merge")
    keep = stored(spark, sf_dir, "stream-store")
    for parts in (range(0, 2), range(2, 4)):
        arrivals(spark, sf_dir, f"{base}/in", parts)
        stream = seen_listings(intake.read_stream(spark, f"{base}/in", files_per_trigger=1))
        intake.stream_merge(stream, keep, as_of(), f"{base}/checkpoint").awaitTermination()
    return flat(keep.table())
