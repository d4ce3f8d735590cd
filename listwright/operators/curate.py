"""Curation of listing tables: required fields, dedupe, normalise, date cut-off."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.dates import parse_posted
from listwright.functions.text import present
from listwright.session import drop_put_by
from listwright.session import put_by as cut_lineage


def _field(row, name: str) -> Column:
    return F.col(name) if row is None else row[name]


def has_required(row: Column | None, field: str) -> Column:
    """Field is present; 'price' is satisfied by either price column.

    ``row`` is a record struct, or None for top-level columns.
    """
    if field == "price":
        amount, raw = _field(row, "price_numeric"), _field(row, "price_raw")
        return amount.isNotNull() | F.coalesce(~raw.isin("", rules.MISSING), F.lit(False))
    return F.coalesce(present(_field(row, field)), F.lit(False))


def required_filter(df: DataFrame, fields=rules.REQUIRED_FIELDS) -> DataFrame:
    """Drop records that lack a required field."""
    for field in fields:
        df = df.where(has_required(None, field))
    return df


def first_per_key(df: DataFrame, key: str | list[str], order: str, descending: bool = False) -> DataFrame:
    """One row per key, the first by ``order``; NULL keys count as one key.

    The ``rank = 1`` filter becomes a group limit below the shuffle: each map
    task sends one row per key, so a key that holds a third of the table costs
    no more than any other.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by = F.col(order).desc() if descending else F.col(order)
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(by)))
    return ranked.where("_rank = 1").drop("_rank")


def dedupe_first(df: DataFrame, order: str = "seq", key: str | list[str] = "listing_id") -> DataFrame:
    """Keep the first row of each listing id, or of each source and id."""
    return first_per_key(df, key, order)


def dedupe_id_or_url(
    df: DataFrame, order: str = "seq", id_col: str = "listing_id", url_col: str = "listing_url"
) -> DataFrame:
    """Keep a row unless an earlier *kept* row has the same id or the same URL.

    Rows come in the order of ``order``, then id, then URL; of rows equal in
    all three one stays.  Rows without id (or URL) are tested on the other
    column only, rows without both always stay.

    Where every URL has one id (the usual case, as ids are made from URLs), the
    rows that share a URL share the id, so the first row of each id is the
    answer; one aggregate over the keys tells.

    Otherwise rows are edges between their id and their URL; the kept rows are
    the first-come matching of that graph.  Each round keeps every row that is
    first for both its id and its URL, drops all rows touching a kept id or
    URL, and settles the paths that are left by pointer jumping; rounds repeat
    until nothing is left, which is exact.  Chains of re-listings take the
    logarithm of their length.  For graphs that are no paths no such
    bound on the rounds is known.
    """
    own_id, own_url = F.nullif(F.col(id_col), F.lit("")), F.nullif(F.col(url_col), F.lit(""))
    named = df.withColumns({
        "_o": F.col(order),
        "_id": F.coalesce(own_id, F.concat(F.lit("\x00"), own_url)),
        "_url": F.coalesce(own_url, F.concat(F.lit("\x00"), own_id)),
    })
    rest = F.xxhash64(*(f.name for f in df.schema.fields if f.dataType.typeName() != "map"))
    keyed = named.where("_id IS NOT NULL")
    several = keyed.groupBy("_url").agg((F.min("_id") != F.max("_id")).alias("several")).where("several")
    if several.isEmpty():
        # rows without id and URL are groups of their own
        rank = F.row_number().over(W.partitionBy("_id").orderBy("_o", "_url", rest))
        first = keyed.withColumn("_rank", rank).where("_rank = 1")
        return first.unionByName(named.where("_id IS NULL").withColumn("_rank", F.lit(1))).select(*df.columns)
    # rows with the same id and URL share their fate with the first of them
    open_rows = cut_lineage(named.where("_id IS NOT NULL").groupBy("_id", "_url").agg(F.min("_o").alias("_o")).select(
        F.struct("_o", "_id", "_url").alias("r")))
    kept_rounds = []
    while True:
        first_id = open_rows.groupBy("r._id").agg(F.min("r").alias("r")).select("r")
        first_url = open_rows.groupBy("r._url").agg(F.min("r").alias("r")).select("r")
        for keep in (lambda: (first_id.join(first_url, "r", "left_semi"),), lambda: _kept_on_paths(open_rows)):
            found, *spent = keep()
            kept = cut_lineage(found)
            kept_rounds.append(kept)
            left = cut_lineage(_untouched(open_rows, kept))
            drop_put_by(open_rows, *spent)
            open_rows = left
            if open_rows.isEmpty():
                break
        else:
            continue
        break
    winners = kept_rounds[0]
    for kept in kept_rounds[1:]:
        winners = winners.unionByName(kept)
    winners = winners.select("r.*")
    alike = W.partitionBy("_o", "_id", "_url").orderBy(rest)
    kept = named.join(winners, ["_o", "_id", "_url"], "left_semi").withColumn("_rank", F.row_number().over(alike)).where("_rank = 1")
    return kept.unionByName(named.where("_id IS NULL").withColumn("_rank", F.lit(1))).select(*df.columns)


def _untouched(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows whose id and URL no kept row has."""
    ids, urls = kept.select(F.col("r._id").alias("_k")), kept.select(F.col("r._url").alias("_k"))
    left = rows.join(ids, F.col("r._id") == F.col("_k"), "left_anti")
    return left.join(urls, F.col("r._url") == F.col("_k"), "left_anti")


def _kept_on_paths(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """With the table to drop when they have been read: kept rows of the descending paths among rows whose id and URL two rows have at most.

    Such a row with one earlier neighbour is kept if that one is not, so along
    a path kept and dropped rows alternate; each step of the pointers doubles
    the distance to the path's first row.  Paths that start at a busier row
    are left open, and so are rows between two earlier ones: they fall to a
    neighbour or are first in the next round.
    """
    def sides(key: str, name: str) -> DataFrame:
        return rows.groupBy(F.col(f"r.{key}").alias(name)).agg(F.count(F.lit(1)).alias(f"n{name}"), F.min("r").alias(f"lo{name}"))

    seen = rows.join(sides("_id", "i"), F.col("r._id") == F.col("i")).join(sides("_url", "u"), F.col("r._url") == F.col("u"))
    by_id, by_url = F.nullif(F.col("loi"), F.col("r")), F.nullif(F.col("lou"), F.col("r"))
    simple = seen.where("ni <= 2 AND nu <= 2").where(by_id.isNull() | by_url.isNull())
    earlier = F.coalesce(by_id, by_url)
    paths = cut_lineage(simple.select(
        "r", F.coalesce(earlier, F.col("r")).alias("to"), F.when(earlier.isNull(), 0).otherwise(1).alias("steps"), earlier.isNull().alias("first")))
    while True:
        ahead = paths.select(F.col("r").alias("at"), F.col("to").alias("next"), F.col("steps").alias("more"), F.col("first").alias("ends"))
        moving = paths.where("NOT first").join(ahead, F.col("to") == F.col("at"))
        if moving.isEmpty():
            break
        jumped = moving.select("r", F.col("next").alias("to"), ((F.col("steps") + F.col("more")) % 2).alias("steps"), F.col("ends").alias("first"))
        still = paths.join(jumped.select(F.col("r").alias("moved")), F.col("r") == F.col("moved"), "left_anti")
        further = cut_lineage(still.unionByName(jumped))
        drop_put_by(paths)
        paths = further
    return paths.where("first AND steps = 0").select("r"), paths


def normalise_listings(df: DataFrame, order: str = "seq", key: str | list[str] = "listing_id") -> DataFrame:
    """Dedupe by id and fix types: numeric price, true booleans, image array.

    A stored boolean criterion is true for any non-empty text, so 'false' as
    text stays false only when it came from the typed extraction.
    """
    flags = F.transform_values(
        F.col("criteria"),
        lambda k, v: F.when(
            k.isin(*rules.TRUTHY_CRITERIA),
            F.coalesce((v != "") & (v != "false"), F.lit(False)).cast("string"),
        ).otherwise(v),
    )
    columns = {
        "price_numeric": F.col("price_numeric").try_cast("double"),
        "image_urls": F.coalesce(F.col("image_urls"), F.array().cast("array<string>")),
    }
    if "criteria" in df.columns:
        columns["criteria"] = flags
    if "image_urls" not in df.columns:
        del columns["image_urls"]
    return dedupe_first(df, order, key).withColumns(columns)


def min_date_posted(df: DataFrame, cutoff: str) -> DataFrame:
    """Keep listings posted on or after ``cutoff`` (yyyy-MM-dd); undated ones go."""
    try:
        day = dt.date.fromisoformat(cutoff)
    except ValueError:
        raise ValueError(f"Invalid min_date_posted value: {cutoff}") from None
    return df.where(parse_posted(F.col("date_posted")) >= F.lit(day))


def union_sources(*tables: DataFrame) -> DataFrame:
    """Tables of several profiles in one schema; absent columns become NULL."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def observed(df: DataFrame, name: str | None = None):
    """Attach a row counter to a step; returns the table and the observation.

    ``observation.get['rows']`` is filled by the first action on the table, so
    kept / removed counts need no extra pass.
    """
    from pyspark.sql import Observation

    watch = Observation(name or f"rows-{uuid.uuid4().hex[:8]}")
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def price_per_sqm(df: DataFrame) -> Column:
    """Price by surface where both are non-zero."""
    price, surface = F.col("price_numeric"), F.col("surface")
    return F.when((surface != 0) & (price != 0), price / surface)
