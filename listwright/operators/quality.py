"""Quality validation: issues, score, gate.  Extra rules plug in as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.text import is_blank
from listwright.operators.curate import has_required
from listwright.schemas import ISSUE


@dataclass(frozen=True)
class Rule:
    """A quality rule: rows where ``fails`` holds give one issue each."""

    issue: str
    fails: Column
    half_points: int
    field: str | None = None
    price: Column | None = None


def standard_rules() -> list[Rule]:
    points = rules.HALF_POINT_PENALTIES
    amount = F.col("price_numeric")
    missing = [
        Rule("missing_required_fields", ~has_required(None, field), points["missing_required_fields"], field)
        for field in rules.REQUIRED_FIELDS
    ]
    return [
        *missing,
        Rule("invalid_prices", F.coalesce(amount <= 0, F.lit(False)), points["invalid_prices"], price=amount),
        Rule("missing_images", F.coalesce(F.col("image_count"), F.lit(0)) == 0, points["missing_images"]),
        Rule("incomplete_location", is_blank(F.col("city")) | is_blank(F.col("governorate")), points["incomplete_location"]),
    ]


def quality_issues(df: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    """One row per issue, from one scan of the listings."""
    def row(rule: Rule) -> Column:
        values = {
            "listing_id": F.col("listing_id").cast("string"),
            "issue": F.lit(rule.issue),
            "field": F.lit(rule.field).cast("string"),
            "price": (rule.price if rule.price is not None else F.lit(None)).cast("double"),
        }
        return F.when(rule.fails, F.struct(*(values[f.name].alias(f.name) for f in ISSUE.fields)))

    found = F.array_compact(F.array(*(row(r) for r in standard_rules() + list(extra or []))))
    return df.select(F.inline(found))


def issue_kinds(extra: list[Rule] | None = None) -> list[str]:
    """Names of the issues the rules look for, in order."""
    return list(dict.fromkeys(r.issue for r in standard_rules() + list(extra or [])))


def quality_counters(extra: list[Rule] | None = None) -> tuple[list[Column], list[Column]]:
    """Aggregates, and the columns of :func:`quality_summary` over their result.

    Apart, so that other totals can share the scan.
    """
    applied = standard_rules() + list(extra or [])
    kinds = issue_kinds(extra)
    counters = [F.count(F.lit(1)).alias("total_listings"), *(F.count_if(r.fails).alias(f"_r{i}") for i, r in enumerate(applied))]

    def total(terms: list[Column]) -> Column:
        out = terms[0]
        for term in terms[1:]:
            out = out + term
        return out

    per_kind = {k: total([F.col(f"_r{i}") for i, r in enumerate(applied) if r.issue == k]) for k in kinds}
    lost = total([F.col(f"_r{i}") * r.half_points for i, r in enumerate(applied)])
    worst = F.col("total_listings") * rules.HALF_POINTS_PER_LISTING
    score = F.round(F.greatest(F.lit(0.0), F.lit(100.0) - F.try_divide(lost.cast("double"), worst) * 100), 2)
    return counters, [
        F.col("total_listings"),
        *(c.alias(k) for k, c in per_kind.items()),
        total(list(per_kind.values())).alias("total_issues"),
        F.when(F.col("total_listings") > 0, score).otherwise(F.lit(0.0)).alias("quality_score"),
    ]


def quality_summary(df: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    """One row: listings, issues of each kind, total issues and score.

    All counters come from one aggregate scan; penalties are summed as whole
    half points, so the score does not depend on summation order.
    """
    counters, shape = quality_counters(extra)
    return df.agg(*counters).select(*shape)


def issue_counts(df: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    """Issues per kind and field."""
    return quality_issues(df, extra).groupBy("issue", "field").agg(F.count(F.lit(1)).alias("issues"))


def quality_score(df: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    return quality_summary(df, extra).select("total_listings", "quality_score")


def assert_quality(df: DataFrame, threshold: float = rules.QUALITY_THRESHOLD, extra: list[Rule] | None = None) -> float:
    """Score of the listings; raises when it is below the threshold."""
    score = quality_score(df, extra).first()["quality_score"]
    if score < threshold:
        raise ValueError(f"Data quality score ({score}) below threshold ({threshold:g})")
    return score
