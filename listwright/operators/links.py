"""Listing links and paging of result pages, as expressions over a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.functions.text import SPACE_CLASS, let
from listwright.functions.urls import resolve_url, without_fragment
from listwright.operators.document import attr, attr_exists, attr_matches, find_all, sole_text, with_document
from listwright.settings import SITES, Site

_S = f"[{SPACE_CLASS}]*"

# --- fixed values: link shapes and paging labels -------------------------------
CARD_CLASS = r"ad-card|listing-card|item-card"
CARD_TESTID = r"ad-|listing-"
CARD_LINK_CLASS = r"card.*link|link.*card"
PORTAL_LINK = r"/(?:fr/)?(?:a|pa)/[0-9]+/"
PORTAL_NEXT = rf"(?i)^{_S}(suivant|next|>|>>){_S}$"
REFLINE_NEXT = rf"^{_S}>>?{_S}$"
CLASSIFIEDS_MIN_LINKS = 5
REFLINE_MIN_LINKS = 3
# what the rules look at
LINK_TAGS, LINK_ATTRIBUTES = frozenset(("a",)), frozenset(("class", "data-testid", "href"))
# -------------------------------------------------------------------------------


def hrefs(elements: Column, where=None) -> Column:
    """href values of the links, in document order."""
    test = (lambda e: attr_exists("href")(e) & where(e)) if where else attr_exists("href")
    return F.transform(find_all(elements, "a", where=test), lambda a: attr(a, "href"))


def _absolute(urls: Column, site: Site, cut: bool = True) -> Column:
    """Absolute URLs, first occurrence of each, in order."""
    def full(u: Column) -> Column:
        absolute = resolve_url(u, site.base_url)
        return without_fragment(absolute) if cut else absolute

    # each text is resolved once, though result pages link to a listing several times
    return F.array_distinct(F.transform(F.array_distinct(urls), full))


def classifieds_links(elements: Column, site: Site = SITES["classifieds"], strict: bool = False) -> Column:
    """Links by URL shape; card markup only when there are none."""
    def is_listing(u: Column) -> Column:
        shaped = u.contains("/ad/") | u.contains("/ads/") | u.contains("/item/")
        return shaped & ~u.contains("/c/") & ~u.contains("page=") & ~F.lower(u).contains("search")

    by_shape = _absolute(F.filter(hrefs(elements), is_listing), site, cut=False)
    tests = [attr_matches("data-testid", CARD_TESTID)]
    if not strict:
        tests = [attr_matches("class", CARD_CLASS), *tests, attr_matches("class", CARD_LINK_CLASS)]

    def cards(test) -> Column:
        found = _absolute(F.filter(hrefs(elements, test), lambda u: u != ""), site, cut=False)
        return let(found, lambda f: F.when(F.size(f) > 0, f))

    fallback = F.coalesce(*(cards(t) for t in tests), F.array().cast("array<string>"))
    return let(by_shape, lambda f: F.when(F.size(f) > 0, f).otherwise(fallback))


def refline_links(elements: Column, site: Site = SITES["refline"]) -> Column:
    return _absolute(F.filter(hrefs(elements), lambda u: u.contains("/annonce/")), site)


def portal_links(elements: Column, site: Site = SITES["portal"]) -> Column:
    return _absolute(F.filter(hrefs(elements), lambda u: u.rlike(PORTAL_LINK)), site)


def _page_numbers(elements: Column, pattern: str) -> Column:
    """Page numbers that links point to."""
    return F.flatten(F.transform(hrefs(elements), lambda u: F.regexp_extract_all(u, F.lit(pattern), F.lit(1))))


def _has_label(pieces: Column, elements: Column, pattern: str) -> Column:
    """Some link's only text is a paging label."""
    labels = F.transform(find_all(elements, "a"), lambda a: sole_text(pieces, a))
    return F.exists(labels, lambda t: F.coalesce(t.rlike(pattern), F.lit(False)))


def classifieds_has_next(links: Column) -> Column:
    """Paging labels never overrule the link count, so the count decides."""
    return F.size(links) >= CLASSIFIEDS_MIN_LINKS


def refline_has_next(pieces: Column, elements: Column, links: Column, page_no: Column) -> Column:
    following = (page_no + 1).cast("string")
    linked = F.array_contains(_page_numbers(elements, r"page=([0-9]+)(?:&|$)"), following)
    return (linked | _has_label(pieces, elements, REFLINE_NEXT)) & (F.size(links) >= REFLINE_MIN_LINKS)


def portal_has_next(pieces: Column, elements: Column, page_no: Column) -> Column:
    following = (page_no + 1).cast("string")
    linked = F.array_contains(_page_numbers(elements, r":p:([0-9]+)(?:/|$)"), following)
    return linked | _has_label(pieces, elements, PORTAL_NEXT)


def read_result_pages(
    pages: DataFrame, profile: str, site: Site | None = None, strict: bool = False, paging: bool = True
) -> DataFrame:
    """Result pages (page_no, html, ...) with ``links`` and, if ``paging`` is wanted, ``has_next`` added."""
    site = site or SITES[profile]
    # texts are looked at for paging only, and not by the rules of classifieds
    doc = with_document(pages, attributes=LINK_ATTRIBUTES, tags=LINK_TAGS, texts=paging and profile != "classifieds")
    p, e, n = F.col("pieces"), F.col("elements"), F.col("page_no")
    if profile == "classifieds":
        found = doc.withColumn("links", classifieds_links(e, site, strict))
        has_next = classifieds_has_next(F.col("links"))
    elif profile == "refline":
        found = doc.withColumn("links", refline_links(e, site))
        has_next = refline_has_next(p, e, F.col("links"), n)
    elif profile == "portal":
        found = doc.withColumn("links", portal_links(e, site))
        has_next = portal_has_next(p, e, n)
    else:
        raise ValueError(f"unknown profile: {profile}")
    return (found.withColumn("has_next", has_next) if paging else found).drop("pieces", "elements")


def link_rows(result_pages: DataFrame, *keys: str) -> DataFrame:
    """One row per link with its position on the page."""
    return result_pages.select(*keys, F.posexplode("links").alias("link_no", "url"))


def join_detail_pages(links: DataFrame, pages: DataFrame, order: list[str]) -> DataFrame:
    """Detail page of each distinct link, with the link's first place.

    Links are reduced to one row per URL before the join (combined map-side),
    so a link that occurs on a third of all result pages meets its page once.
    """
    place = F.struct(*order)
    first = links.groupBy("url").agg(F.min(place).alias("_place"), F.count(F.lit(1)).alias("times_linked"))
    return first.join(pages, "url").select("*", "_place.*").drop("_place")
