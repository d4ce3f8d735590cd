"""The whole run: pages -> curated listings -> quality, exports, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from listwright import rules
from listwright.operators.curate import min_date_posted, normalise_listings, observed, required_filter
from listwright.operators.export import write_csv, write_json_lines, write_report
from listwright.operators.quality import Rule, assert_quality, quality_issues, quality_summary
from listwright.operators.report import report_document, report_rows
from listwright.operators.store import ListingStore
from listwright.plans import classifieds, portal, refline
from listwright.session import scratch_path
from listwright.settings import SITES, Site

Extractor = Callable[..., DataFrame]

PROFILES: dict[str, Extractor] = {
    "classifieds": classifieds.extract,
    "refline": refline.extract,
    "portal": portal.extract,
}


def register_profile(name: str, extract: Extractor, site: Site) -> None:
    """Add a custom extractor: a function (pages, site=..., validate=...) -> listings."""
    PROFILES[name] = extract
    SITES[name] = site


def curate(
    pages: DataFrame, profile: str, site: Site | None = None, min_date: str | None = None, **options
) -> DataFrame:
    """Pages of one profile to curated listings."""
    listings = PROFILES[profile](pages, site=site or SITES[profile], **options)
    curated = normalise_listings(listings)
    return min_date_posted(curated, min_date) if min_date else curated


# format -> function (listings, folder and file prefix, site, export time)
Exporter = Callable[[DataFrame, str, Site, Column], object]

EXPORTERS: dict[str, Exporter] = {
    "csv": lambda listings, path, site, exported_at: write_csv(listings, f"{path}_listings_csv"),
    "json": lambda listings, path, site, exported_at: write_json_lines(listings, f"{path}_listings_json", site.domain, exported_at),
}
FORMATS = {"both": ("csv", "json")}


def register_exporter(name: str, export: Exporter) -> None:
    """Add a custom export format for :func:`run`."""
    EXPORTERS[name] = export


def counted_curation(
    listings: DataFrame, min_date: str | None = None, key: str | list[str] = "listing_id"
) -> tuple[DataFrame, Callable[[], list[tuple[str, int, int]]]]:
    """Required fields, dedupe and types, date cut-off; and a function that gives (step, rows, removed).

    The counts are taken while the rows pass, by the first action on the
    table, which has to come before the function is called.
    """
    steps = [("read", listings), ("required", None), ("distinct", None)] + [("recent", None)] * bool(min_date)
    apply = {"required": required_filter, "distinct": lambda df: normalise_listings(df, key=key), "recent": lambda df: min_date_posted(df, min_date)}
    watches, table = [], listings
    for name, _ in steps:
        table, watch = observed(apply[name](table) if name in apply else table)
        watches.append((name, watch))

    def counts() -> list[tuple[str, int, int]]:
        rows = [(name, watch.get["rows"]) for name, watch in watches]
        return [(name, n, (rows[i - 1][1] if i else n) - n) for i, (name, n) in enumerate(rows)]

    return table, counts


def write_counted(listings: DataFrame, path: str, min_date: str | None = None, key: str | list[str] = "listing_id") -> list[tuple[str, int, int]]:
    """Write the curated listings; gives (step, rows, removed)."""
    table, counts = counted_curation(listings, min_date, key)
    table.write.parquet(path)
    return counts()


@dataclass
class ScheduledRun:
    run_id: str
    score: float
    steps: list[tuple[str, int, int]]  # step, rows, removed
    version: int
    repeated: bool  # the run had been committed before


def scheduled_run(
    listings: DataFrame, store: ListingStore, run_id: str, as_of: Column, threshold: float = rules.QUALITY_THRESHOLD,
    min_date: str | None = None, extra_rules: list[Rule] | None = None,
) -> ScheduledRun:
    """Curate, validate, gate and merge into the store in one call that may be repeated.

    The score of the curated listings must reach ``threshold``, else nothing is
    merged and an error is raised.  The run's id, score and counts are
    committed together with its rows; a run that is there already is not done
    again and its recorded result is returned.
    """
    def result(repeated: bool) -> ScheduledRun:
        done = store.runs()[run_id]
        return ScheduledRun(run_id, done["score"], [tuple(step) for step in done["steps"]], done["version"], repeated)

    if run_id in store.runs():
        return result(True)
    spark = listings.sparkSession
    path = scratch_path(spark, "scheduled")
    steps = write_counted(listings, path, min_date, store.keys)
    curated = spark.read.parquet(path)
    score = assert_quality(curated, threshold, extra_rules)
    version = (store.create().versions())[-1] + 1
    store.upsert(curated, as_of, "scheduled", run=(run_id, {"score": score, "steps": steps, "version": version}))
    return result(False)


@dataclass
class RunResult:
    listings: DataFrame
    issues: DataFrame
    summary: DataFrame
    report: DataFrame


def run(
    pages: DataFrame,
    profile: str,
    out: str,
    exported_at: Column,
    site: Site | None = None,
    min_date: str | None = None,
    export_format: str = "both",
    dry_run: bool = False,
    extra_rules: list[Rule] | None = None,
    **options,
) -> RunResult | None:
    """Curate, validate and export.

    ``export_format`` is csv, json, both or the name of a registered exporter.
    The curated table is written once (``out/curated``) and every later step
    reads that copy, so extraction runs once.  Returns None when no listing is
    left after the date filter.
    """
    spark = pages.sparkSession
    site = site or SITES[profile]
    curate(pages, profile, site, min_date, **options).write.parquet(f"{out}/curated")
    listings = spark.read.parquet(f"{out}/curated")
    if listings.isEmpty():
        return None
    rows = report_rows(listings, extra_rules)
    document = report_document(rows, {"min_date_posted": min_date} if min_date else None, extra_rules)
    if not dry_run:
        for name in FORMATS.get(export_format, (export_format,)):
            EXPORTERS[name](listings, f"{out}/{site.file_prefix}", site, exported_at)
        write_report(document, f"{out}/summary_report_{site.file_prefix}")
    return RunResult(listings, quality_issues(listings, extra_rules), quality_summary(listings, extra_rules), document)
