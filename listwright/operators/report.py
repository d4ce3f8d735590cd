"""Summary report: completeness, prices, categories, cities, images."""

from __future__ import annotations

import struct

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.text import present
from listwright.operators.quality import Rule, issue_kinds, quality_counters
from listwright.session import cut_lineage, scratch_path


def _filled(field: str) -> Column:
    if field == "price_numeric":
        return F.coalesce(F.col(field) != 0, F.lit(False))
    return F.coalesce(present(F.col(field)), F.lit(False))


def completeness(df: DataFrame, fields=rules.COMPLETENESS_FIELDS) -> DataFrame:
    """Filled count and percentage per field: (field, filled, percentage)."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(_filled(f)).alias(f) for f in fields))
    long = counts.unpivot("_n", list(fields), "field", "filled")
    return long.select("field", "filled", F.round(F.try_divide("filled", "_n") * 100, 2).alias("percentage"))


# --- exact median ----------------------------------------------------------------

_SMALLEST_NORMAL = 2.0 ** -1022
_DIGIT = 16  # bits of a pass


def ordered_bits(c: Column) -> Column:
    """The bits of a double as a BIGINT that sorts as the numbers do.

    They are worked out from exponent and fraction: all steps are exact,
    because powers of two are and scaling by them is.  Both zeros give 0, NaN
    is above infinity.
    """
    size = F.abs(c)

    def bits(x: Column) -> Column:
        guess = F.floor(F.log2(x)).cast("int")  # may miss by one next to a power of two
        shifted = x / F.pow(F.lit(2.0), guess)
        exponent = F.when(shifted >= 2, guess + 1).when(shifted < 1, guess - 1).otherwise(guess)
        fraction = x / F.pow(F.lit(2.0), exponent) - 1
        normal = (exponent + 1023).cast("long") * F.lit(1 << 52) + (fraction * F.lit(2.0 ** 52)).cast("long")
        return F.when(x < _SMALLEST_NORMAL, (x / F.lit(2.0 ** -1074)).cast("long")).otherwise(normal)

    finite = F.when(size == 0, F.lit(0).cast("long")).when(size < float("inf"), bits(size)).otherwise(F.lit(2047 << 52))
    return F.when(F.isnan(c), F.lit((2047 << 52) + 1)).when(c < 0, -finite).otherwise(finite)


def number_of_bits(bits: int) -> float:
    """The double of :func:`ordered_bits`."""
    if bits > 2047 << 52:
        return float("nan")
    number = struct.unpack("<d", struct.pack("<q", abs(bits)))[0]
    return -number if bits < 0 else number


def upper_median_of(df: DataFrame, column: str) -> float | None:
    """Exact ``sorted(values)[n // 2]``, None if there are no values.

    Radix selection: the column is written once as ordered bits, then four
    passes over that narrow table count the values by their next 16 bits among
    those that share the bits found so far.  A pass has 65,536 counters at most,
    combined map-side, whatever the values; nothing is ordered.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    path = scratch_path(spark, "median")
    values.select(ordered_bits(F.col("v")).alias("bits")).write.parquet(path)
    bits = spark.read.parquet(path)
    rank, found = bits.count() // 2, None
    for shift in range(64 - _DIGIT, -1, -_DIGIT):
        within = bits if found is None else bits.where(F.shiftright("bits", shift + _DIGIT) == found)
        counts = within.groupBy(F.shiftright("bits", shift).alias("digits")).agg(F.count(F.lit(1)).alias("n"))
        for digits, n in sorted(tuple(r) for r in counts.collect()):
            if rank < n:
                found = digits
                break
            rank -= n
        else:
            return None
    return number_of_bits(found)


def upper_median(df: DataFrame, column: str) -> DataFrame:
    """:func:`upper_median_of` as a table of one row (median)."""
    return df.sparkSession.createDataFrame([(upper_median_of(df, column),)], "median double")


def _price_columns(amount: Column) -> dict[str, Column]:
    """Aggregates over a column of non-zero prices.

    The average is over decimals, so it does not depend on row order; only
    where a price has no place in DECIMAL(28,2) it is over doubles.
    """
    exact = amount.try_cast("decimal(28,2)")
    average = F.when(F.count(exact) == F.count(amount), F.avg(exact).cast("double")).otherwise(F.avg(amount))
    return {"min_price": F.min(amount), "max_price": F.max(amount), "avg_price": F.round(average, 2)}


def price_stats(df: DataFrame) -> DataFrame:
    """min, max, avg and upper median over non-zero prices, one row."""
    priced = df.where(_filled("price_numeric")).select("price_numeric")
    basics = priced.agg(*(c.alias(name) for name, c in _price_columns(F.col("price_numeric")).items()))
    return basics.withColumn("median_price", F.lit(upper_median_of(priced, "price_numeric")).cast("double"))


def category_distribution(df: DataFrame) -> DataFrame:
    """Listings per category; a NULL category is a group of its own."""
    return df.groupBy("category").agg(F.count(F.lit(1)).alias("listings"))


def top_cities(df: DataFrame, n: int = rules.TOP_CITIES, order: str = "seq") -> DataFrame:
    """Most frequent cities, ties by first appearance; blank cities are left out."""
    counted = df.where(F.col("city") != "").groupBy("city").agg(
        F.count(F.lit(1)).alias("listings"), F.min(order).alias("first_seen")
    )
    return counted.orderBy(F.desc("listings"), "first_seen").limit(n)


def image_stats(df: DataFrame) -> DataFrame:
    images = F.coalesce(F.col("image_count"), F.lit(0))
    sums = df.agg(
        F.sum(images).cast("bigint").alias("total_images"),
        F.count_if(images > 0).alias("listings_with_images"),
        F.count(F.lit(1)).alias("_n"),
    )
    return sums.select(
        F.coalesce("total_images", F.lit(0)).alias("total_images"),
        "listings_with_images",
        F.coalesce(F.round(F.try_divide("total_images", "_n"), 2), F.lit(0.0)).alias("avg_images_per_listing"),
    )


def _totals(df: DataFrame, extra: list[Rule] | None) -> dict:
    """Everything that is one number, from one scan: counts, issues, filled fields, prices, images."""
    images = F.coalesce(F.col("image_count"), F.lit(0))
    priced = F.when(_filled("price_numeric"), F.col("price_numeric"))
    counters, shape = quality_counters(extra)
    row = df.agg(
        *counters, *(F.count_if(_filled(f)).alias(f"_filled_{f}") for f in rules.COMPLETENESS_FIELDS),
        *(c.alias(name) for name, c in _price_columns(priced).items()),
        F.sum(images).cast("bigint").alias("total_images"), F.count_if(images > 0).alias("listings_with_images"))
    filled = [F.struct(F.col(f"_filled_{f}").alias("filled"), F.round(F.try_divide(F.col(f"_filled_{f}"), "total_listings") * 100, 2).alias("percentage")).alias(f"_filled_{f}")
              for f in rules.COMPLETENESS_FIELDS]
    mean = F.coalesce(F.round(F.try_divide("total_images", "total_listings"), 2), F.lit(0.0)).alias("avg_images_per_listing")
    shaped = row.select(*shape, *filled, "min_price", "max_price", "avg_price", F.coalesce("total_images", F.lit(0)).alias("total_images"), "listings_with_images", mean)
    return shaped.first().asDict(recursive=True)


def group_counts(df: DataFrame, order: str = "seq") -> DataFrame:
    """(section, item, listings, first_seen) of categories and cities, from one scan.

    Grouping sets count both in one shuffle, combined map-side.
    """
    grouped = df.groupingSets([["category"], ["city"]], "category", "city").agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("listings"), F.min(order).alias("first_seen"))
    by_category = F.col("_set") == 1  # the city is left out
    return grouped.select(
        F.when(by_category, F.lit("category_distribution")).otherwise(F.lit("top_cities")).alias("section"),
        F.when(by_category, F.col("category")).otherwise(F.col("city")).cast("string").alias("item"), "listings", "first_seen")


def report_rows(df: DataFrame, extra: list[Rule] | None = None, order: str = "seq") -> DataFrame:
    """The whole report as rows (section, item, metric, value).

    The input is read three times: for all totals, for the groups, and for the
    prices whose median is then found on a copy of eight bytes a price.
    """
    spark = df.sparkSession
    totals = _totals(df, extra)
    totals["median_price"] = upper_median_of(df.where(_filled("price_numeric")), "price_numeric")
    sections = {
        "total": ("total_listings",),
        "validation": (*issue_kinds(extra), "total_issues", "quality_score"),
        "price_stats": ("min_price", "max_price", "avg_price", "median_price"),
        "image_stats": ("total_images", "listings_with_images", "avg_images_per_listing"),
    }
    fixed = [(section, None, metric, totals[metric]) for section, metrics in sections.items() for metric in metrics]
    fixed += [("field_completeness", f, metric, totals[f"_filled_{f}"][metric]) for f in rules.COMPLETENESS_FIELDS for metric in ("filled", "percentage")]
    numbers = [(section, item, metric, None if value is None else float(value)) for section, item, metric, value in fixed]
    groups = cut_lineage(group_counts(df, order))
    categories = groups.where("section = 'category_distribution'")
    cities = groups.where("section = 'top_cities' AND item <> ''").orderBy(F.desc("listings"), "first_seen").limit(rules.TOP_CITIES)
    counted = categories.unionByName(cities).select("section", "item", F.lit("listings").alias("metric"), F.col("listings").cast("double").alias("value"))
    return spark.createDataFrame(numbers, "section string, item string, metric string, value double").unionByName(counted)


def report_document(rows: DataFrame, filters: dict[str, str] | None = None, extra: list[Rule] | None = None) -> DataFrame:
    """The report rows as one nested row (schema B4 of the design notes).

    ``extra`` are the rules that the rows were made with; their counts stand
    beside the standard ones.

    The rows are counts that were aggregated before; their number is that of
    the distinct categories plus a constant.  An empty table gives a row with
    only ``error`` set.
    """
    def picked(section: str, key: str | Column, value: Column) -> Column:
        here = F.col("section") == section
        key = F.col(key) if isinstance(key, str) else key
        return F.map_from_entries(F.collect_list(F.when(here, F.struct(key.alias("key"), value.alias("value")))))

    def metric(section: str, name: str, kind: str = "double") -> Column:
        here = (F.col("section") == section) & (F.col("metric") == name)
        return F.max(F.when(here, F.col("value"))).cast(kind)

    def group(section: str, **kinds: str) -> Column:
        return F.struct(*(metric(section, m, k).alias(m) for m, k in kinds.items()))

    total = metric("total", "total_listings", "bigint")
    kinds = dict.fromkeys((*issue_kinds(extra), "total_issues"), "bigint")
    filled = rows.withColumn("_field_metric", F.concat_ws(".", "item", "metric"))
    built = filled.agg(
        total.alias("total_listings"),
        picked("field_completeness", "_field_metric", F.col("value")).alias("field_completeness"),
        group("price_stats", min_price="double", max_price="double", avg_price="double", median_price="double").alias("price_stats"),
        picked("category_distribution", F.coalesce("item", F.lit("null")), F.col("value").cast("bigint")).alias("category_distribution"),
        picked("top_cities", "item", F.col("value").cast("bigint")).alias("top_cities"),
        group("image_stats", total_images="bigint", listings_with_images="bigint", avg_images_per_listing="double").alias("image_stats"),
        group("validation", **kinds, quality_score="double").alias("validation"),
    )
    completeness_map = F.map_from_entries(
        F.array(
            *(
                F.struct(
                    F.lit(f).alias("key"),
                    F.struct(
                        F.try_element_at("field_completeness", F.lit(f"{f}.filled")).cast("bigint").alias("count"),
                        F.try_element_at("field_completeness", F.lit(f"{f}.percentage")).alias("percentage"),
                    ).alias("value"),
                )
                for f in rules.COMPLETENESS_FIELDS
            )
        )
    )
    shaped = built.withColumn("field_completeness", completeness_map)
    if filters:
        entries = [F.lit(x) for pair in filters.items() for x in pair]
        shaped = shaped.withColumn("filters", F.create_map(*entries))
    empty = F.col("total_listings") == 0
    return shaped.select(
        F.when(empty, F.lit("No listings to analyze")).alias("error"),
        *(F.when(~empty, F.col(c)).alias(c) for c in shaped.columns),
    )
