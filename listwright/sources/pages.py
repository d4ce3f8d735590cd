"""Page sources: page tables and directories of saved HTML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.settings import SITES, Site


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page table in Parquet: page_id, url, html and optional columns."""
    return spark.read.parquet(path)


def read_snapshots(spark: SparkSession, directory: str, pattern: str = "*.html") -> DataFrame:
    """Saved pages ``[prefix_]page_<n>.html`` as a page table, one row per file."""
    files = (
        spark.read.option("pathGlobFilter", pattern).text(directory, wholetext=True)
        .select(F.col("value").alias("html"), F.col("_metadata.file_name").alias("file_name"))
    )
    number = F.regexp_extract("file_name", r"page_([0-9]+)\.html$", 1).try_cast("bigint")
    return files.select(number.alias("page_no"), "file_name", "html")


def site_table(spark: SparkSession, sites: list[Site] | None = None) -> DataFrame:
    """Registry of sites as a dimension table, one row per configured site."""
    rows = [(s.name, s.domain, s.base_url, s.start_url, s.file_prefix) for s in (sites or list(SITES.values()))]
    return spark.createDataFrame(
        rows, "site string, domain string, base_url string, start_url string, file_prefix string"
    )


def with_source(pages: DataFrame, sites: list[Site] | None = None) -> DataFrame:
    """Add ``source`` (domain) and ``site`` by the host of the page URL.

    The registry is configuration (one row per site), so it is broadcast.
    """
    dims = site_table(pages.sparkSession, sites)
    host = F.regexp_replace(F.parse_url("base_url", F.lit("HOST")), r"^www\.", "")
    dims = dims.select("site", F.col("domain").alias("source"), host.alias("_host"))
    keyed = pages.withColumn("_host", F.regexp_replace(F.try_parse_url("url", F.lit("HOST")), r"^www\.", ""))
    return keyed.join(F.broadcast(dims), "_host", "left").drop("_host")
