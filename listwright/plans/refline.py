"""Profile ``refline``: text rules on page text and lines, with a reference line."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.dates import iso_text, parse_french
from listwright.functions.text import (
    REFLINE_KEEP,
    SPACE_CLASS,
    WORD_CLASS,
    first_contained,
    let,
    lookup,
    match,
    refline_label,
    stable_id,
    strip,
)
from listwright.functions.values import (
    AMOUNT,
    currency_code,
    entry,
    first_count,
    last_wins_map,
    looks_like_amount,
    number_dotted,
)
from listwright.operators.document import all_places, find_all, first_after, line_at, places_of, section, text_of, window
from listwright.plans.common import (
    CRITERIA_FIELDS, LINE_TAGS, PLACE_FIELDS, PRICE_FIELDS, at_most, emit, images_with_alt, lifted, na, page_columns, page_title, part,
    read_lines, required,
)
from listwright.settings import REFLINE, Site

_S = f"[{SPACE_CLASS}]"

# --- fixed values: patterns of this profile ----------------------------------
AMOUNT_PATTERN = rf"(?iu)({AMOUNT}){_S}*(DT|TND)(?:{_S}*/{_S}*([A-Za-z]+))?"
REFERENCE_PATTERN = rf"(?iu)R[èe]f{_S}*:{_S}*([A-Za-z0-9_-]+)"
POSTED_PATTERN = rf"(?iu)D[ée]pos[ée]e?{_S}+le{_S}*:{_S}*([0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}})"
COUNT_PATTERNS = {
    "bedrooms": rf"(?iu)Chambres?{_S}*:{_S}*(\p{{Nd}}+\+?)",
    "bathrooms": rf"(?iu)Salles?{_S}+de{_S}+bain{_S}*:{_S}*(\p{{Nd}}+\+?)",
    "rooms": rf"(?iu)Pi[èeé]ces?{_S}*(?:\(Totale\))?{_S}*:{_S}*(\p{{Nd}}+\+?)",
}
SIZE_PATTERNS = {
    "surface": rf"(?iu)Surf{_S}+habitable{_S}*:{_S}*([\p{{Nd}}{SPACE_CLASS}.,]+){_S}*m(?:2|²)?",
    "surface_land": rf"(?iu)Surf{_S}+terrain{_S}*:{_S}*([\p{{Nd}}{SPACE_CLASS}.,]+){_S}*m(?:2|²)?",
}
_EDGE_AFTER = rf"(?![{WORD_CLASS}])"
RENT_WORDS, SALE_WORDS = ("louer", "location"), ("vendre", "vente", "acheter")
# -----------------------------------------------------------------------------

SECTION_LABELS = tuple(dict.fromkeys(
    rules.REFLINE_DESCRIPTION_START + rules.REFLINE_DESCRIPTION_END + rules.REFLINE_OPTIONS_START + rules.REFLINE_OPTIONS_END
))


# lines the rules look at closer; only what can't match a rule may be missing
PICKS = {"placed": {"line": [re.compile(",")]}, "sections": {"label": frozenset(SECTION_LABELS)}}
# and the fields made from each part of a page
READS = {
    "lines": PLACE_FIELDS | CRITERIA_FIELDS | {"description"},
    "page_text": PRICE_FIELDS | CRITERIA_FIELDS | {"listing_id", "transaction_type", "date_posted"},
    "placed": PLACE_FIELDS,
    "sections": PLACE_FIELDS,
}


def listing_id(url: Column, page_text: Column, site: Site = REFLINE) -> Column:
    """Trailing number of the URL, the reference on the page, or generated."""
    return F.coalesce(
        match(url, r"-([0-9]+)/?$", 1), match(page_text, REFERENCE_PATTERN, 1), stable_id(url, site.hash_prefix)
    )


def price(page_text: Column) -> Column:
    """Struct (price_raw, price_numeric, currency, price_period)."""
    def read(found: Column) -> Column:
        # the groups are read from the short match, not from the page again
        def group(i: int) -> Column:
            return F.regexp_extract(found, AMOUNT_PATTERN, i)

        return F.struct(
            F.coalesce(strip(found), na()).alias("price_raw"),
            number_dotted(group(1)).alias("price_numeric"),
            F.coalesce(currency_code(group(2)), F.lit("TND")).alias("currency"),
            F.nullif(F.lower(group(3)), F.lit("")).alias("price_period"),
        )

    return let(match(page_text, AMOUNT_PATTERN), read)


def category(pieces: Column, elements: Column, url: Column, title: Column) -> Column:
    """First link whose text the synonym table changes, else a key word."""
    texts = F.transform(find_all(elements, "a"), lambda a: F.lower(text_of(pieces, a)))
    renamed = F.transform(texts, lambda t: F.nullif(lookup(rules.CATEGORIES, t), t))
    words = first_contained(rules.CATEGORIES, F.lower(F.concat_ws(" ", url, title)))
    return F.coalesce(F.get(F.filter(renamed, lambda t: t.isNotNull()), 0), words, na())


def transaction(url: Column, title: Column, page_text: Column) -> Column:
    """Rent words before sale words in URL, title and the page."""
    def has(t: Column, words: tuple[str, ...]) -> Column:
        # the pattern tests the edge of a word at each place, so the plain search goes first
        found = [t.contains(word) & t.rlike(f"{word[0]}(?<![{WORD_CLASS}]{word[0]}){word[1:]}{_EDGE_AFTER}") for word in words]
        return reduce(Column.__or__, found)

    return let(
        F.lower(F.concat_ws(" ", url, title, page_text)),
        lambda t: F.when(has(t, RENT_WORDS), F.lit("rent")).when(has(t, SALE_WORDS), F.lit("sale")),
    )


def location(lines: Column, labels: Column, title: Column, placed: Column | None = None, sections: Column | None = None) -> Column:
    """Struct from the first line with a comma between the title and the first section."""
    looked_at = all_places(lines) if placed is None else placed
    ends = places_of(labels, SECTION_LABELS) if sections is None else sections

    def fits(at: Column) -> Column:
        line, label = line_at(lines, at), line_at(labels, at)
        return line.contains(",") & ~label.isin(*rules.REFLINE_NOT_A_PLACE) & ~looks_like_amount(line)

    def first(span: Column) -> Column:
        return line_at(lines, F.get(F.filter(window(looked_at, span["start"], span["end"]), fits), 0))

    title_at = F.greatest(F.array_position(lines, title).cast("int"), F.lit(1))
    hit = let(let(title_at, lambda at: F.struct(at.alias("start"), first_after(ends, at, F.size(lines) + 1).alias("end"))), first)

    def split_place(line: Column) -> Column:
        def fields(parts: Column) -> Column:
            n = F.size(parts)
            return F.struct(
                F.coalesce(line, na()).alias("location_raw"),
                F.when(n >= 3, part(parts, -2)).when(n >= 1, F.get(parts, 0)).alias("city"),
                F.when(n >= 2, part(parts, -1)).alias("governorate"),
                F.when(n >= 3, F.get(parts, 0)).alias("neighborhood"),
            )

        return let(F.filter(F.transform(F.split(line, ","), strip), lambda p: p != ""), fields)

    return let(hit, split_place)


def description(lines: Column, labels: Column) -> Column:
    body = section(lines, labels, rules.REFLINE_DESCRIPTION_START, rules.REFLINE_DESCRIPTION_END)
    return F.coalesce(F.nullif(strip(F.array_join(body, "\n")), F.lit("")), na())


def date_posted(page_text: Column) -> Column:
    return iso_text(parse_french(match(page_text, POSTED_PATTERN, 1)))


def options(lines: Column, labels: Column) -> Column:
    """Known option labels of the options section, else its text as one option."""
    text = F.array_join(section(lines, labels, rules.REFLINE_OPTIONS_START, rules.REFLINE_OPTIONS_END), " ")

    def pick(t: Column) -> Column:
        label = refline_label(t)
        known = let(
            label,
            lambda n: F.array_compact(F.array(*(F.when(n.contains(o.lower()), F.lit(o)) for o in rules.REFLINE_OPTIONS))),
        )
        found = let(known, lambda k: F.when(F.size(k) > 0, k).otherwise(F.array(strip(t))))
        return F.when(t != "", found).otherwise(F.array().cast("array<string>"))

    return let(text, pick)


def criteria(page_text: Column, chosen: Column, period: Column) -> Column:
    """Detail numbers, options as JSON text, option flags and the price period."""
    numbers = [entry(k, first_count(F.regexp_extract(page_text, p, 1))) for k, p in COUNT_PATTERNS.items()]
    numbers += [entry(k, number_dotted(F.regexp_extract(page_text, p, 1))) for k, p in SIZE_PATTERNS.items()]
    has_options = F.size(chosen) > 0
    label = refline_label(F.array_join(chosen, " "))
    flags = let(
        label,
        lambda n: F.array(*(entry(k, F.when(has_options, n.contains(w))) for k, w in rules.REFLINE_FLAGS.items())),
    )
    extra = F.array(entry("options", F.when(has_options, F.to_json(chosen))), entry("price_period", period))
    entries = F.concat(F.array(*numbers), flags, extra)
    return last_wins_map(F.filter(entries, lambda e: e["value"].isNotNull()))


def images(elements: Column, title: Column, site: Site = REFLINE) -> Column:
    """Pictures whose alt text, if any, contains the title."""
    def with_title(label: Column) -> Column:
        def fits(alt: Column) -> Column:
            labelled = let(refline_label(alt), lambda a: (a == "") | (label == "na") | a.contains(label))
            return F.when(alt == "", F.lit(True)).otherwise(labelled)

        return images_with_alt(elements, fits, site)

    return let(refline_label(title), with_title)


def extract(
    pages: DataFrame, site: Site = REFLINE, validate: bool = True, max_images: int | None = None, fields: Iterable[str] | None = None, **_
) -> DataFrame:
    """Pages to listing records; ``max_images`` bounds the stored pictures, not their count.

    ``fields`` are those wanted of records that are not validated; what only others are made from is not read.
    """
    wanted = None if validate or fields is None else frozenset(fields)
    p, e, url, title = F.col("pieces"), F.col("elements"), F.col("url"), F.col("title")
    lines, labels, text = F.col("lines"), F.col("labels"), F.col("page_text")
    parsed = read_lines(
        page_columns(pages).select("seq", "url", "scraped_at", "html"), LINE_TAGS | {"a"}, REFLINE_KEEP, PICKS, READS, wanted)
    read = parsed.withColumn("title", page_title(p, e, site, skip_empty=True))
    ruled = read.select(
        "seq", "url", "scraped_at", "title", "page_text",
        listing_id(url, text, site).alias("listing_id"),
        price(text).alias("price"),
        category(p, e, url, title).alias("category"),
        transaction(url, title, text).alias("transaction_type"),
        location(lines, labels, title, F.col("at.placed"), F.col("at.sections")).alias("place"),
        description(lines, labels).alias("description"),
        date_posted(text).alias("date_posted"),
        options(lines, labels).alias("options"),
        images(e, title, site).alias("image_urls"),
    ).withColumn("criteria", criteria(text, F.col("options"), F.col("price.price_period")))

    features = F.col("criteria")
    columns = {
        "seq": F.col("seq"),
        "source": F.lit(site.domain),
        "listing_id": F.col("listing_id"),
        "listing_url": url,
        "title": title,
        "description": F.col("description"),
        "category": F.col("category"),
        "transaction_type": F.col("transaction_type"),
        "price_raw": F.col("price.price_raw"),
        "price_numeric": F.col("price.price_numeric"),
        "currency": F.col("price.currency"),
        "location_raw": F.col("place.location_raw"),
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
