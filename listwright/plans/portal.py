"""Profile ``portal``: rules on the leading text lines; search gives the category."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.dates import iso_text, parse_french, parse_relative_french
from listwright.functions.text import (
    LINE_SPACES,
    PORTAL_KEEP,
    SPACE_CLASS,
    ascii_fold,
    let,
    lookup,
    match,
    portal_label,
    stable_id,
    strip,
)
from listwright.functions.values import (
    currency_code_any_case,
    entry,
    last_wins_map,
    number_dotted,
    number_spoken,
)
from listwright.operators.document import all_places, first_after, first_position, line_at, places_of, window
from listwright.plans.common import (
    CRITERIA_FIELDS, LINE_TAGS, PLACE_FIELDS, PRICE_FIELDS, at_most, emit, images_with_alt, lifted, na, page_columns, page_title, part,
    read_lines, required,
)
from listwright.settings import PORTAL, Site

# --- fixed values: patterns of this profile (on folded, normalised text) -------
PRICE_PATTERN = r"(?i)((?:a partir de\s*)?[0-9][0-9\s.,]*)\s*(TND|DT|EUR|USD|\$|euro)"
PRICE_LINE = r"[0-9][0-9\s.,]*\s*(tnd|dt|eur|usd)"
METRIC_LINE = r"[0-9]+\s*m|[0-9]+\s+pieces?|[0-9]+\s+ch|[0-9]+\s+salles?\s+de\s+bain"
SKIPPED_LINE = (
    r"^(?:[0-9]+(\.[0-9]+)?\s*m|[0-9]+\s+pieces?|[0-9]+\s+ch|[0-9]+\s+salles?\s+de\s+bain"
    r"|prix a consulter$|[0-9][0-9\s.,]*\s*(tnd|dt|eur|usd))"
)
# runs are taken whole: a shorter one is followed by more of it, never by the unit
CRITERIA_PATTERNS = {
    "surface": r"(?<![0-9])([0-9][0-9\s.,]*+)m",
    "rooms": r"(?<![0-9])([0-9]++)\s++piece",
    "bedrooms": r"(?<![0-9])([0-9]++)\s++(?:chambres?|ch)\b",
    "bathrooms": r"(?<![0-9])([0-9]++)\s++salles?\s++de\s++bain",
}
POSTED_PATTERN = r"(?:publiee?|deposee?)\s+(?:le\s*)?:?\s*([0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4})"
# place lines such as "Quarter à City"
PLACE_WORD = rf"(?iu)[{SPACE_CLASS}][aà][{SPACE_CLASS}]"
PLACE_SPLIT = rf"(?iu)^(.+?)[{SPACE_CLASS}]+[aà][{SPACE_CLASS}]+(.+)$"
# lines the rules look at closer; only what can't match a rule may be missing
PICKS = {
    "priced": {
        "line": [re.compile(r"[$\ufe69\uff04]")],
        "label": [re.compile(r"[0-9] ?(?:tnd|dt|eur|usd)"), re.compile(re.escape(rules.PORTAL_NO_PRICE))],
    },
    "placed": {
        "line": [re.compile("[,aàAÀ](?:(?<=,)|(?<=[{0}].)(?=[{0}]))".format(LINE_SPACES))], "label": [re.compile(" a(?=\n)")],
    },
    "skipped": {"label": [re.compile("\n[0-9]"), re.compile(f"\n{re.escape(rules.PORTAL_NO_PRICE)}(?=\n)")]},
    "options": {"label": frozenset(rules.PORTAL_OPTIONS.values())},
    "stops": {"label": frozenset(rules.PORTAL_DESCRIPTION_STOP)},
    "details_end": {"label": frozenset(rules.PORTAL_DETAILS_END)},
}
# and the fields made from each part of a page
READS = {
    "lines": PRICE_FIELDS | PLACE_FIELDS | CRITERIA_FIELDS | {"description", "date_posted"},
    "label_text": CRITERIA_FIELDS | {"date_posted"},
    "priced": PRICE_FIELDS,
    "placed": PLACE_FIELDS,
    "skipped": frozenset(("description",)),
    "options": CRITERIA_FIELDS | {"description"},
    "stops": PLACE_FIELDS | {"description"},
    "details_end": CRITERIA_FIELDS,
}
# -----------------------------------------------------------------------------


def listing_id(url: Column, site: Site = PORTAL) -> Column:
    return F.coalesce(match(url, r"/(?:a|pa)/([0-9]+)/", 1), stable_id(url, site.hash_prefix))


def price(lines: Column, labels: Column, priced: Column | None = None) -> Column:
    """Struct from the first line that is a price or 'price on request'."""
    def opened(at: Column) -> Column:
        line, label = line_at(lines, at), line_at(labels, at)
        return F.struct(
            line.alias("line"),
            ascii_fold(line).alias("folded"),
            label.contains(rules.PORTAL_NO_PRICE).alias("on_request"),
            label.rlike("[0-9]").alias("numbered"),
        )

    seen = F.transform(all_places(lines) if priced is None else priced, opened)
    first = F.get(F.filter(seen, lambda w: w["on_request"] | w["numbered"] & w["folded"].rlike(PRICE_PATTERN)), 0)

    def read(w: Column) -> Column:
        priced = w["line"].isNotNull() & ~w["on_request"]
        return F.struct(
            F.when(w["on_request"], F.lit(rules.PORTAL_NO_PRICE_RAW)).when(priced, w["line"]).otherwise(na()).alias("price_raw"),
            F.when(priced, number_spoken(F.regexp_extract(w["folded"], PRICE_PATTERN, 1))).alias("price_numeric"),
            F.when(priced, currency_code_any_case(F.regexp_extract(w["folded"], PRICE_PATTERN, 2)))
            .otherwise(F.lit("TND")).alias("currency"),
        )

    return let(first, read)


def place_line(
    lines: Column, labels: Column, title: Column, max_chars: int | None = None, placed: Column | None = None, stops: Column | None = None
) -> Column:
    """Most likely location line: between the title and the first section, else on the whole page.

    ``max_chars`` refuses longer lines.
    """
    def candidate(start: Column, end: Column) -> Column:
        def read(at: Column) -> Column:
            line, label = line_at(lines, at), line_at(labels, at)
            following = F.when(at + 1 < end, line_at(lines, at + 1)).otherwise("")
            joined = F.when(label.endswith(" a") & (following != ""), F.concat_ws(" ", line, following)).otherwise(line)

            def fit(joined: Column) -> Column:
                unfit = (
                    (F.lit(False) if max_chars is None else F.length(line) > max_chars)
                    | label.rlike(METRIC_LINE)
                    | label.contains(rules.PORTAL_NO_PRICE)
                    | label.rlike(PRICE_LINE)
                    | label.isin(*rules.PORTAL_NOT_A_PLACE)
                )
                return F.when((joined.contains(",") | joined.rlike(PLACE_WORD)) & ~unfit, joined)

            return let(joined, fit)

        places = window(all_places(lines) if placed is None else placed, start, end)
        return F.get(F.array_compact(F.transform(places, read)), 0)

    def find(found: Column) -> Column:
        title_at, all_end = found["title_at"], F.size(lines) + 1
        stop = first_after(places_of(labels, rules.PORTAL_DESCRIPTION_STOP) if stops is None else stops, title_at, all_end)
        return F.coalesce(let(stop, lambda end: candidate(title_at, end)), candidate(F.lit(0), all_end), na())

    return let(F.struct(F.greatest(F.array_position(lines, title).cast("int"), F.lit(1)).alias("title_at")), find)


def split_place(raw: Column) -> Column:
    """Struct (city, governorate, neighborhood) of a location line."""
    def fields(parts: Column) -> Column:
        several = F.size(parts) >= 2
        spoken = raw.rlike(PLACE_SPLIT)
        city = F.when(several, part(parts, -1)).when(spoken, strip(F.regexp_extract(raw, PLACE_SPLIT, 2)))
        quarter = F.when(several, F.get(parts, 0)).when(spoken, strip(F.regexp_extract(raw, PLACE_SPLIT, 1)))
        known = (raw != "") & (raw != na())
        return F.struct(
            F.when(known, F.coalesce(city, strip(raw))).alias("city"),
            F.when(known, city).alias("governorate"),
            F.when(known, quarter).alias("neighborhood"),
        )

    return let(F.filter(F.transform(F.split(raw, ","), strip), lambda p: p != ""), fields)


def description(
    lines: Column, labels: Column, title: Column, min_chars: int = 0, skipped: Column | None = None,
    options: Column | None = None, stops: Column | None = None,
) -> Column:
    """Lines after the title up to the first stop label; ``min_chars`` drops shorter ones."""
    looked_at = all_places(lines) if skipped is None else skipped
    flags = places_of(labels, tuple(rules.PORTAL_OPTIONS.values())) if options is None else options
    ends = places_of(labels, rules.PORTAL_DESCRIPTION_STOP) if stops is None else stops

    def kept(span: Column) -> Column:
        start, end = span["start"], span["end"]
        skips = F.filter(window(looked_at, start, end), lambda at: line_at(labels, at).rlike(SKIPPED_LINE))
        out = F.concat(skips, window(flags, start, end))
        body = F.slice(lines, start + 1, end - start - 1)

        def stays(out: Column) -> Column:
            def test(line: Column, i: Column) -> Column:
                inside = ~F.array_contains(out, start + 1 + i)
                return inside if min_chars <= 0 else inside & (F.length(line) >= min_chars)

            return F.filter(body, test)

        return let(out, stays)

    start = F.array_position(lines, title).cast("int")
    span = let(start, lambda at: F.struct(at.alias("start"), first_after(ends, at, F.size(lines) + 1).alias("end")))
    return F.coalesce(F.nullif(strip(F.array_join(let(span, kept), "\n")), F.lit("")), na())


def _label_text(labels: Column) -> Column:
    """Normalised text of all lines."""
    return F.array_join(F.filter(labels, lambda t: t != ""), " ")


def criteria(
    lines: Column, labels: Column, text: Column | None = None, options: Column | None = None, details_end: Column | None = None
) -> Column:
    """Numbers in the text, label/value lines and option flags."""
    flagged = places_of(labels, tuple(rules.PORTAL_OPTIONS.values())) if options is None else options
    text = _label_text(labels) if text is None else text
    ends = places_of(labels, rules.PORTAL_DETAILS_END) if details_end is None else details_end
    numbers = F.array(*(entry(k, number_dotted(F.regexp_extract(text, p, 1))) for k, p in CRITERIA_PATTERNS.items()))

    def details(span: Column) -> Column:
        start, end = span["start"], span["end"]
        return F.transform(
            F.slice(labels, start + 1, F.when(start > 0, end - start - 1).otherwise(0)),
            lambda label, i: entry(
                lookup(rules.PORTAL_DETAIL_LABELS, label), F.when(start + i + 2 < end, line_at(lines, start + i + 2))),
        )

    start = first_position(labels, rules.PORTAL_DETAILS_START)
    span = let(start, lambda at: F.struct(at.alias("start"), first_after(ends, at, F.size(lines) + 1).alias("end")))
    flags = let(
        F.transform(flagged, lambda at: line_at(labels, at)),
        lambda found: F.array(*(entry(k, F.array_contains(found, word)) for k, word in rules.PORTAL_OPTIONS.items())),
    )
    entries = F.concat(numbers, let(span, details), flags)
    return last_wins_map(F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))


def date_posted(text: Column, as_of: Column) -> Column:
    """Absolute date in the normalised text, else a relative one counted back from ``as_of``."""
    # the plain searches go first
    named = text.contains("publi") | text.contains("depos")
    written = F.when(named & text.rlike(POSTED_PATTERN), parse_french(F.regexp_extract(text, POSTED_PATTERN, 1)))
    return iso_text(written.otherwise(parse_relative_french(text, as_of)))


def images(elements: Column, title: Column, site: Site = PORTAL) -> Column:
    """Pictures without alt text or whose alt text contains the title."""
    def with_title(label: Column) -> Column:
        return images_with_alt(elements, lambda alt: (alt == "") | portal_label(alt).contains(label), site)

    return let(portal_label(title), with_title)


def extract(
    pages: DataFrame,
    site: Site = PORTAL,
    validate: bool = True,
    category: str | None = "apartment",
    transaction: str | None = "sale",
    max_images: int | None = None,
    place_max_chars: int | None = None,
    text_min_chars: int = 0,
    fields: Iterable[str] | None = None,
    **_,
) -> DataFrame:
    """Pages to listing records.

    Category and transaction are those of the search: page columns
    ``category`` / ``transaction_type`` when the pages were joined to their
    search, else the arguments.  ``max_images`` bounds the stored pictures, not
    their count; see :func:`place_line` and :func:`description` for the others.  ``fields`` are those wanted of records
    that are not validated; what only others are made from is not read.
    """
    wanted = None if validate or fields is None else frozenset(fields)
    p, e, url, title = F.col("pieces"), F.col("elements"), F.col("url"), F.col("title")
    lines, labels, text = F.col("lines"), F.col("labels"), F.col("label_text")
    have = set(pages.columns)
    searched = page_columns(pages).select(
        "seq", "url", "scraped_at", "html",
        (F.col("category") if "category" in have else F.lit(category)).alias("category"),
        (F.col("transaction_type") if "transaction_type" in have else F.lit(transaction)).alias("transaction_type"),
    )
    read = read_lines(searched, LINE_TAGS, PORTAL_KEEP, PICKS, READS, wanted).withColumn("title", page_title(p, e, site, skip_empty=True))
    ruled = read.select(
        "seq", "url", "scraped_at", "title", "category", "transaction_type",
        price(lines, labels, F.col("at.priced")).alias("price"),
        place_line(lines, labels, title, place_max_chars, F.col("at.placed"), F.col("at.stops")).alias("location_raw"),
        description(lines, labels, title, text_min_chars, F.col("at.skipped"), F.col("at.options"), F.col("at.stops")).alias("description"),
        date_posted(text, F.to_date("scraped_at")).alias("date_posted"),
        criteria(lines, labels, text, F.col("at.options"), F.col("at.details_end")).alias("criteria"),
        images(e, title, site).alias("image_urls"),
    ).withColumn("place", split_place(F.col("location_raw")))

    features = F.col("criteria")
    columns = {
        "seq": F.col("seq"),
        "source": F.lit(site.domain),
        "listing_id": listing_id(url, site),
        "listing_url": url,
        "title": title,
        "description": F.col("description"),
        "category": F.col("category"),
        "transaction_type": F.col("transaction_type"),
        "price_raw": F.col("price.price_raw"),
        "price_numeric": F.col("price.price_numeric"),
        "currency": F.col("price.currency"),
        "location_raw": F.col("location_raw"),
        "city": F.col("place.city"),
        "governorate": F.col("place.governorate"),
        "neighborhood": F.col("place.neighborhood"),
        **{k: lifted(features, k) for k in ("surface", "rooms", "bedrooms", "bathrooms", "floor")},
        "furnished": F.try_element_at(features, F.lit("furnished")).try_cast("boolean"),
        "criteria": features,
        "image_urls": at_most(F.col("image_urls"), max_images),
        "image_count": F.size("image_urls"),
        "date_posted": F.col("date_posted"),
        "scraped_at": F.col("scraped_at"),
    }
    return emit(ruled, columns, required if validate else None, wanted)
