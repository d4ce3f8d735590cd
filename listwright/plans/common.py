"""Parts shared by the profile plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.text import SPACE_CLASS, strip
from listwright.functions.urls import resolve_url
from listwright.operators.curate import has_required
from listwright.operators.document import JOINED, Picks, attr, attr_equals, find, find_all, text_of, with_document
from listwright.schemas import LISTING, conform
from listwright.settings import Site


# what the line profiles look at in a page besides its lines
LINE_TAGS = frozenset("h1 title meta img".split())
LINE_ATTRIBUTES = frozenset("alt content data-lazy data-original data-src property src width".split())


# fields that come from one rule
PRICE_FIELDS = frozenset("price_raw price_numeric currency".split())
PLACE_FIELDS = frozenset("location_raw city governorate neighborhood".split())
CRITERIA_FIELDS = frozenset("criteria surface rooms bedrooms bathrooms floor furnished".split())


def read_lines(
    pages: DataFrame, tags: frozenset[str], keep: str, picks: Picks, reads: dict[str, frozenset[str]], fields: frozenset[str] | None
) -> DataFrame:
    """Pages with their document, and of ``reads`` what some of the ``fields`` is made from; the rest is NULL.

    ``reads`` names the fields made from ``lines`` (with their labels), the joined texts and each of ``picks``.
    """
    read = {part for part, made in reads.items() if fields is None or made & fields}
    joined = tuple(name for name in JOINED if name in read)
    chosen = {name: tests for name, tests in picks.items() if name in read}
    doc = with_document(
        pages, attributes=LINE_ATTRIBUTES, tags=tags, keep=keep if "lines" in read else None, picks=chosen, joined=joined)
    absent = [("lines", "array<string>"), ("labels", "array<string>"), *((name, "string") for name in JOINED)]
    places = (F.col(f"at.{name}") if name in chosen else F.lit(None).cast("array<int>").alias(name) for name in picks)
    have = set(doc.columns)
    return doc.withColumns({name: F.lit(None).cast(kind) for name, kind in absent if name not in have} | {"at": F.struct(*places)})


def na() -> Column:
    """The missing sentinel."""
    return F.lit(rules.MISSING)


def page_columns(pages: DataFrame) -> DataFrame:
    """Input pages with the optional columns filled in.

    ``seq`` (ingestion order) falls back to ``page_id``; ``fetched_at`` becomes
    ``scraped_at``.
    """
    have = set(pages.columns)
    seq = F.col("seq") if "seq" in have else F.col("page_id")
    fetched = F.col("fetched_at") if "fetched_at" in have else F.lit(None)
    return pages.withColumns({"seq": seq.cast("bigint"), "scraped_at": fetched.cast("timestamp")})


def cut_site_name(title: Column, site: Site) -> Column:
    """'Flat - SiteName ...' -> 'Flat'."""
    return F.regexp_replace(title, rf"(?iu)[{SPACE_CLASS}]*[-|][{SPACE_CLASS}]*{site.title_suffix}.*$", "")


def page_title(pieces: Column, elements: Column, site: Site, skip_empty: bool) -> Column:
    """h1, else og:title, else <title> without the site name, else N/A."""
    heading = text_of(pieces, find(elements, "h1"))
    meta = find(elements, "meta", where=attr_equals("property", "og:title"))
    shared = strip(attr(meta, "content"))
    if skip_empty:
        heading = F.nullif(heading, F.lit(""))
        shared = F.when(attr(meta, "content") != "", shared)
    else:
        shared = F.when(meta.isNotNull(), F.coalesce(shared, F.lit("")))
    tag = cut_site_name(text_of(pieces, find(elements, "title")), site)
    return F.coalesce(heading, shared, tag, na())


def truthy(c: Column) -> Column:
    """The text, or NULL when it is empty."""
    return F.nullif(c, F.lit(""))


def at_most(urls: Column, n: int | None) -> Column:
    """The first ``n`` of an array; all without a bound."""
    return urls if n is None else F.slice(urls, 1, n)


def images_with_alt(elements: Column, fits: object, site: Site) -> Column:
    """Picture URLs of a page whose alt text passes ``fits``, distinct."""
    def source(img: Column) -> Column:
        return F.coalesce(*(truthy(attr(img, a)) for a in ("data-src", "data-original", "data-lazy", "src")))

    def usable(img: Column) -> Column:
        width = attr(img, "width")
        small = width.rlike(r"^[0-9]+$") & (width.try_cast("bigint") < rules.MIN_IMAGE_WIDTH)
        src = source(img)
        return (
            src.isNotNull()
            & ~F.lower(src).rlike("|".join(rules.IMAGE_URL_EXCLUDES))
            & ~F.coalesce(small, F.lit(False))
            & fits(F.coalesce(attr(img, "alt"), F.lit("")))
        )

    urls = F.transform(find_all(elements, "img", where=usable), lambda img: resolve_url(source(img), site.base_url))
    return F.array_distinct(urls)


def lifted(criteria: Column, key: str) -> Column:
    """Numeric criterion as a top-level value."""
    return F.try_element_at(criteria, F.lit(key)).try_cast("double")


def part(parts: Column, i: int) -> Column:
    """i-th part, counted from the end when negative."""
    return F.get(parts, F.size(parts) + i if i < 0 else F.lit(i))


def emit(df: DataFrame, columns: dict[str, Column], keep: Column | None, fields: frozenset[str] | None = None) -> DataFrame:
    """One record per page, or only the named fields of it; ``keep`` sees the finished record struct.

    The record goes through ``inline``: its fields are computed once even
    though the required-field test reads some of them, because Catalyst does
    not push a filter through a generator and repeat the expressions.
    """
    named = [c.alias(name) for name, c in columns.items()]
    if keep is None:
        rows = conform(df.select(*named), LISTING)
        return rows if fields is None else rows.select(*(name for name in rows.columns if name in fields))
    return conform(df.select(F.inline(F.filter(F.array(F.struct(*named)), keep))), LISTING)


def required(record: Column) -> Column:
    """All required fields are present in a record struct."""
    tests = [has_required(record, field) for field in rules.REQUIRED_FIELDS]
    condition = tests[0]
    for test in tests[1:]:
        condition = condition & test
    return condition

