"""Crawl extent: which result pages and listings a crawl takes.

A crawl reads result pages in order and stops at the page limit, at an empty or
missing page, after a page without a next one, (optionally) after a page that
brought nothing new, or when enough listings are collected.  All of this is
decided from per-page flags and a minimum per crawl, without ordered windows
over a crawl, so one crawl may hold most of the pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listwright.operators.curate import dedupe_id_or_url
from listwright.session import cut_lineage, scratch_path


def last_page(
    pages: DataFrame, crawl: str = "crawl_id", max_pages: int | None = None, new_per_page: DataFrame | None = None
) -> DataFrame:
    """Last page each crawl takes: (crawl, last_page).  0 if the first is missing.

    ``pages`` has page_no, links and has_next, ``new_per_page`` the number of
    new listings by (crawl, page_no) if pages without news end the crawl.
    """
    flags = pages.select(crawl, "page_no", (F.size("links") == 0).alias("empty"), (~F.col("has_next")).alias("final"))
    if new_per_page is not None:
        flags = flags.join(new_per_page, [crawl, "page_no"], "left").withColumn(
            "final", F.col("final") | (F.coalesce("new_rows", F.lit(0)) == 0)
        ).drop("new_rows")
    # a page number without its predecessor starts a gap: pages before it are the extent
    number = F.explode(
        F.array(
            F.struct(F.col("page_no").alias("n"), F.lit(True).alias("here"), "empty", "final"),
            F.struct((F.col("page_no") + 1).alias("n"), F.lit(False).alias("here"),
                     F.lit(False).alias("empty"), F.lit(False).alias("final")),
        )
    )
    slots = (
        flags.select(crawl, number.alias("p"))
        .groupBy(crawl, F.col("p.n").alias("n"))
        .agg(F.max("p.here").alias("here"), F.max("p.empty").alias("empty"), F.max("p.final").alias("final"))
    )
    stop = F.when(~F.col("here") | F.col("empty"), F.col("n") - 1).when(F.col("final"), F.col("n"))
    extent = slots.groupBy(crawl).agg(F.min(stop).alias("last_page"), F.min(F.when(F.col("here"), F.col("n"))).alias("first"))
    last = F.when(F.col("first") == 1, F.col("last_page")).otherwise(F.lit(0))
    if max_pages:
        last = F.least(last, F.lit(max_pages))
    return extent.select(crawl, last.cast("int").alias("last_page"))


def crawl_pages(pages: DataFrame, crawl: str = "crawl_id", max_pages: int | None = None) -> DataFrame:
    """Result pages the crawls take, without their ``html``.

    The pages' links are read from the markup once: what is left of a page is
    written to the shared folder, and both the limits and the result come from
    there.  The limits table has one row per crawl; AQE broadcasts it when its
    measured size allows and splits skewed crawls otherwise.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "crawl-pages")
    pages.drop("html").write.parquet(path)
    reduced = spark.read.parquet(path)
    limits = last_page(reduced, crawl, max_pages)
    return reduced.join(limits, crawl).where("page_no <= last_page").drop("last_page")


PAGE_BLOCK = 1024  # pages whose counts are summed up in one group


def rows_before(counts: DataFrame, crawl: str) -> DataFrame:
    """(crawl, page_no, before): how many rows the earlier pages of a crawl have.

    ``counts`` has (crawl, page_no, rows).  The prefix sum has two levels: over
    blocks of pages, and over the pages of a block, so a crawl's pages are dealt
    to many groups and only its block sums, a thousandth of them, meet in one.
    """
    blocked = counts.withColumn("_block", F.floor(F.col("page_no") / PAGE_BLOCK))
    of_block = blocked.groupBy(crawl, "_block").agg(F.sum("rows").alias("_rows"))
    blocks = of_block.select(crawl, "_block", (F.sum("_rows").over(W.partitionBy(crawl).orderBy("_block")) - F.col("_rows")).alias("_earlier"))
    within = F.sum("rows").over(W.partitionBy(crawl, "_block").orderBy("page_no")) - F.col("rows")
    pages = blocked.withColumn("_within", within).join(blocks, [crawl, "_block"])
    return pages.select(crawl, "page_no", (F.col("_earlier") + F.col("_within")).alias("before"))


def first_rows(rows: DataFrame, crawl: str, n: int) -> DataFrame:
    """The first n rows of each crawl by (page_no, link_no), for any n.

    Rows are numbered inside their page only; what a crawl's earlier pages hold
    comes from :func:`rows_before`.  Pages beyond the n-th row are left out
    before any row is numbered.
    """
    rows = cut_lineage(rows)
    counts = rows.groupBy(crawl, "page_no").agg(F.count(F.lit(1)).alias("rows"))
    before = rows_before(counts, crawl).where(F.col("before") < n)
    number = F.row_number().over(W.partitionBy(crawl, "page_no").orderBy("link_no"))
    placed = rows.join(before, [crawl, "page_no"]).withColumn("_number", F.col("before") + number)
    return placed.where(F.col("_number") <= n).select(*rows.columns)


def crawl_listings(
    listings: DataFrame,
    pages: DataFrame,
    crawl: str = "crawl_id",
    max_pages: int | None = None,
    sample_size: int | None = None,
    stop_without_news: bool = False,
) -> DataFrame:
    """Listings the crawls collect, deduped by id or URL in crawl order.

    ``listings`` has the crawl key, page_no, link_no, seq (crawl order),
    listing_id and listing_url; ids of different crawls do not meet.
    """
    scoped = listings.withColumns(
        {
            "_id": F.concat_ws("\x1f", crawl, F.nullif("listing_id", F.lit(""))),
            "_url": F.concat_ws("\x1f", crawl, F.nullif("listing_url", F.lit(""))),
        }
    ).withColumns(
        {
            "_id": F.when(F.col("listing_id") != "", F.col("_id")),
            "_url": F.when(F.col("listing_url") != "", F.col("_url")),
        }
    )
    kept = dedupe_id_or_url(scoped, "seq", "_id", "_url").drop("_id", "_url")
    news = kept.groupBy(crawl, "page_no").agg(F.count(F.lit(1)).alias("new_rows")) if stop_without_news else None
    limits = last_page(pages, crawl, max_pages, news)
    taken = kept.join(limits, crawl).where("page_no <= last_page").drop("last_page")
    if sample_size:
        taken = first_rows(taken, crawl, sample_size)
    return taken
