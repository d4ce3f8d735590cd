"""Exports: flattened CSV, JSON lines or one JSON document, report file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules

BYTE_ORDER_MARK = "﻿"


MAX_COLUMNS = 1000  # columns made of keys that were not named
REST = "criteria_rest"


def criteria_keys(df: DataFrame) -> DataFrame:
    """(key, listings) of all criteria, as a table: their number is open."""
    return df.select(F.explode(F.map_keys("criteria")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("listings"))


def common_keys(df: DataFrame, n: int = MAX_COLUMNS) -> tuple[list[str], bool]:
    """The n most frequent criteria by name, and whether there are others."""
    found = criteria_keys(df).orderBy(F.desc("listings"), "key").limit(n + 1).collect()
    return sorted(row["key"] for row in found[:n]), len(found) > n


def flatten(df: DataFrame, keys: list[str] | None = None, rest: bool | None = None, max_columns: int = MAX_COLUMNS) -> DataFrame:
    """Criteria as ``criteria_<key>`` columns, arrays as JSON text, columns ordered.

    A criterion shows up only where the listing has no top-level value of that
    name.  With ``keys`` nothing is looked up; otherwise the most frequent
    ``max_columns`` keys become columns.  ``rest`` keeps all other criteria as
    one JSON object a row in ``criteria_rest`` (NULL where there is none); by
    default that column is there when keys were looked up and there are more of
    them than columns, so none is lost.
    """
    columns: dict[str, Column] = {c: F.col(c) for c in df.columns if c not in ("criteria", "seq")}
    if "criteria" in df.columns:
        if keys is None:
            keys, more = common_keys(df, max_columns)
            rest = more if rest is None else rest
        for key in keys:
            value = F.try_element_at("criteria", F.lit(key))
            columns[f"criteria_{key}"] = F.when(F.col(key).isNull(), value) if key in df.columns else value
        if rest:
            named = F.array(*map(F.lit, keys)).cast("array<string>")
            others = F.map_filter("criteria", lambda k, _: ~F.array_contains(named, k))
            ordered = F.map_from_entries(F.array_sort(F.map_entries(others)))
            columns[REST] = F.when(F.size(others) > 0, F.to_json(ordered))
    if "image_urls" in df.columns:
        columns["image_urls"] = F.to_json("image_urls")
    leading = [c for c in rules.CSV_LEADING_COLUMNS if c in columns]
    rest_of = sorted(set(columns) - set(leading))
    return df.select(*(columns[c].alias(c) for c in leading + rest_of))


def write_csv(df: DataFrame, path: str, keys: list[str] | None = None, mode: str = "errorifexists", rest: bool | None = None) -> bool:
    """CSV with header and byte order mark in each part file.

    An empty table writes nothing and returns False.  See :func:`flatten` for
    ``keys`` and ``rest``.
    """
    if df.isEmpty():
        return False
    flat = flatten(df, keys, rest)
    marked = flat.withColumnRenamed(flat.columns[0], BYTE_ORDER_MARK + flat.columns[0])
    marked.write.csv(path, header=True, escape='"', nullValue="\\N", encoding="UTF-8", mode=mode)
    return True


def _typed_criteria() -> Column:
    """Criteria values as JSON numbers, booleans and lists where they are such."""
    def typed(key: Column, value: Column) -> Column:
        number = key.isin("surface_land", *rules.NUMERIC_CRITERIA) & value.try_cast("double").isNotNull()
        known = number | value.isin("true", "false") | (key == "options")
        return F.when(known, F.try_parse_json(value)).otherwise(value.cast("variant"))

    return F.transform_values("criteria", typed)


def write_json_lines(df: DataFrame, path: str, source: str, exported_at: Column, mode: str = "errorifexists") -> bool:
    """JSON lines in ``path/listings`` and one metadata row in ``path/metadata``."""
    if df.isEmpty():
        return False
    rows = df.drop("seq")
    if "criteria" in df.columns:
        rows = rows.withColumn("criteria", _typed_criteria())
    rows.write.json(f"{path}/listings", mode=mode, ignoreNullFields=False)
    metadata(df, source, exported_at).coalesce(1).write.json(f"{path}/metadata", mode=mode)
    return True


def metadata(df: DataFrame, source: str, exported_at: Column) -> DataFrame:
    """Export metadata, one row."""
    return df.agg(F.count(F.lit(1)).alias("total_listings")).select(
        F.date_format(exported_at, "yyyy-MM-dd'T'HH:mm:ss").alias("export_timestamp"),
        "total_listings",
        F.lit(source).alias("source"),
        F.lit(rules.EXPORT_CATEGORY).alias("category"),
    )


def write_report(document: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The one-row report as one JSON file."""
    document.coalesce(1).write.json(path, mode=mode)
