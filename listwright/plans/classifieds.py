"""Profile ``classifieds``: embedded JSON record first, markup rules otherwise."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.dates import iso_text, parse_iso, parse_written
from listwright.functions.text import SPACE_CLASS, first_contained, let, match, stable_id, strip
from listwright.functions.urls import resolve_url
from listwright.functions.values import (
    AMOUNT,
    criteria_key,
    criteria_value,
    currency_code,
    currency_mentioned,
    entry,
    last_wins_map,
    normalise_category,
    number_of_digits,
    number_plain,
)
from listwright.operators.document import (
    attr,
    attr_equals,
    attr_exists,
    attr_matches,
    descendants,
    find,
    find_all,
    parse_html,
    text_of,
)
from listwright.plans.common import at_most, na, emit, lifted, page_columns, page_title, part, required, truthy
from listwright.settings import CLASSIFIEDS, Site

# --- fixed values: patterns of this profile ----------------------------------
PRICE_CLASS = r"(?i)price|prix"
PLACE_CLASS = r"(?i)location|localisation|address|ville"
TEXT_CLASS = r"(?i)description|desc|content|detail"
DATE_CLASS = r"(?i)date|time|posted"
TABLE_CLASS = r"(?i)detail|spec|feature|criteria"
BOX_CLASS = r"(?i)feature|spec|detail|criteria"
LABEL_CLASS = r"(?i)label|key|name"
VALUE_CLASS = r"(?i)value|data"
GALLERY_CLASS = r"(?i)gallery|carousel|slider|images"
# elements that rules find by name alone; the others are found by an attribute
RULE_TAGS = frozenset("* a dd dl dt h1 img meta p td th time title tr".split())
CONTENT_CLASS = r"(?i)content|detail|listing"
EMBEDDED_ID = "__NEXT_DATA__"
EMBEDDED_PATH = "$.props.pageProps.adDetails"
# -----------------------------------------------------------------------------


# --- embedded record -----------------------------------------------------------


def _kind(v: Column) -> Column:
    """Variant kind: STRING, BIGINT, VOID, OBJECT<..>; '' when the path is absent."""
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def embedded_script(html: Column) -> Column:
    """JSON text of the embedded record, NULL without one."""
    return match(html, rf"(?is)<script\b[^>]*\bid\s*=\s*[\"']?{EMBEDDED_ID}[\"']?[^>]*>(.*?)</script", 1)


def embedded_record(script: Column, site: Site = CLASSIFIEDS) -> Column:
    """Record struct of the embedded JSON.

    NULL unless the whole record is usable; one bad value (non-numeric price,
    null list, feature value that is not text) rejects it, and the markup rules
    take over.
    """
    def build(ad: Column) -> Column:
        def text(path: str) -> Column:
            return F.try_variant_get(ad, f"$.{path}", "string")

        def node(path: str, kind: str = "variant") -> Column:
            return F.try_variant_get(ad, f"$.{path}", kind)

        price, price_text = _kind(node("price")), text("price")
        amount = (
            F.when(price == "", F.lit(0.0))
            .when(price == "VOID", F.lit(None).cast("double"))
            .otherwise(strip(price_text).try_cast("double"))
        )
        price_ok = price.isin("", "VOID") | (~price.rlike("^(OBJECT|ARRAY)") & amount.isNotNull())
        images, place, params = _kind(node("images")), _kind(node("location")), _kind(node("adParams"))
        image_nodes = F.coalesce(node("images", "array<variant>"), F.array().cast("array<variant>"))
        param_nodes = F.coalesce(node("adParams", "array<variant>"), F.array().cast("array<variant>"))
        images_ok = (images == "") | (images.startswith("ARRAY") & F.forall(image_nodes, lambda v: _kind(v) == "STRING"))
        place_ok = (place == "") | place.startswith("OBJECT")

        def param_ok(p: Column) -> Column:
            label = _kind(F.try_variant_get(p, "$.label", "variant"))
            return label.isin("", "STRING") & (_kind(F.try_variant_get(p, "$.value", "variant")) == "STRING")

        params_ok = (params == "") | (params.startswith("ARRAY") & F.forall(param_nodes, param_ok))

        def feature(p: Column) -> Column:
            key = criteria_key(F.coalesce(F.try_variant_get(p, "$.label", "string"), F.lit("")))
            return let(key, lambda k: entry(k, criteria_value(k, F.try_variant_get(p, "$.value", "string"))))

        city, governorate = text("location.delegation"), text("location.governorate")
        spoken = [F.coalesce(c, F.lit("None")) for c in (city, governorate)]
        urls = F.transform(
            F.transform(image_nodes, lambda v: F.try_variant_get(v, "$", "string")),
            lambda u: F.when(u.startswith("http"), u).otherwise(resolve_url(u, site.base_url)),
        )
        has_price = (price_text != "") & (F.coalesce(amount, F.lit(1.0)) != 0)
        record = F.struct(
            text("id").alias("listing_id"),
            text("title").alias("title"),
            text("description").alias("description"),
            amount.alias("price_numeric"),
            F.when(has_price, F.concat(price_text, F.lit(" DT"))).otherwise(na()).alias("price_raw"),
            F.lit("TND").alias("currency"),
            text("category").alias("category"),
            text("publishedOn").alias("date_posted"),
            urls.alias("image_urls"),
            city.alias("city"),
            governorate.alias("governorate"),
            F.concat_ws(", ", *spoken).alias("location_raw"),
            last_wins_map(F.transform(param_nodes, feature)).alias("criteria"),
        )
        usable = price_ok & images_ok & place_ok & params_ok & _kind(ad).startswith("OBJECT") & (_kind(ad) != "OBJECT<>")
        return F.when(usable, record)

    ad = F.try_variant_get(F.try_parse_json(script), EMBEDDED_PATH, "variant")
    return F.when(script.isNotNull(), let(ad, build))


# --- markup rules ----------------------------------------------------------------


def _first_rule(elements: Column, tags: tuple[str, ...], class_pattern: str, others, strict: bool) -> Column:
    """First element by rule order.  ``strict`` leaves the class rule out."""
    tests = ([] if strict else [attr_matches("class", class_pattern)]) + list(others)
    return F.coalesce(*(find(elements, *tags, where=test) for test in tests))


def listing_id(url: Column, elements: Column, site: Site = CLASSIFIEDS) -> Column:
    """Id from the URL, from id attributes of the page, or generated."""
    last = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    from_path = F.when(url.contains("/item/") & last.rlike(r"^[\p{L}\p{N}]+$"), last)

    def number_in(e: Column) -> Column:
        value = F.coalesce(truthy(attr(e, "data-ad-id")), truthy(attr(e, "data-listing-id")), attr(e, "id"))
        return match(value, r"[0-9]+")

    tests = (attr_exists("data-ad-id"), attr_exists("data-listing-id"), attr_matches("id", r"ad-[0-9]+|listing-[0-9]+"))
    in_page = [let(find(elements, where=test), number_in) for test in tests]
    return F.coalesce(match(url, r"/ad/([0-9]+)", 1), from_path, *in_page, stable_id(url, site.hash_prefix))


_PRICED = rf"(?iu)({AMOUNT})[{SPACE_CLASS}]*(TND|DT|dt|€|EUR|\$|USD)"


def _price_element(elements: Column, strict: bool) -> Column:
    return _first_rule(
        elements, ("span", "div", "p", "strong"), PRICE_CLASS,
        (attr_equals("itemprop", "price"), attr_matches("data-testid", "price")), strict,
    )


def price(pieces: Column, elements: Column, strict: bool = False) -> Column:
    """Struct (price_raw, price_numeric, currency)."""
    element = _price_element(elements, strict)

    def from_element(text: Column) -> Column:
        return F.struct(
            text.alias("price_raw"),
            number_of_digits(text).alias("price_numeric"),
            F.coalesce(currency_mentioned(text), F.lit("TND")).alias("currency"),
        )

    def from_match(found: Column) -> Column:
        return F.struct(
            F.coalesce(found, na()).alias("price_raw"),
            number_plain(F.regexp_extract(found, _PRICED, 1)).alias("price_numeric"),
            F.coalesce(currency_code(F.regexp_extract(found, _PRICED, 2)), F.lit("TND")).alias("currency"),
        )

    def from_page(text: Column) -> Column:
        return let(match(text, _PRICED), from_match)

    def choose(text: Column) -> Column:
        return F.when(text.isNotNull(), from_element(text)).otherwise(let(F.array_join(pieces, ""), from_page))

    return let(text_of(pieces, element), choose)


def price_readings(pieces: Column, elements: Column, strict: bool = False) -> Column:
    """Struct (digits, plain, differ): the price element read by both rules.

    An element's digits are all joined, a text's number keeps its decimals;
    ``differ`` marks the listings whose price depends on the rule, such as
    ``250.50 DT``.
    """
    def read(text: Column) -> Column:
        both = F.struct(number_of_digits(text).alias("digits"), number_plain(F.regexp_extract(text, _PRICED, 1)).alias("plain"))
        return let(both, lambda b: F.struct(b["digits"].alias("digits"), b["plain"].alias("plain"), F.coalesce(b["digits"] != b["plain"], F.lit(False)).alias("differ")))

    return let(text_of(pieces, _price_element(elements, strict)), read)


def category(pieces: Column, elements: Column, url: Column) -> Column:
    """Last breadcrumb link, else data-category, else a key word in the URL."""
    trail = find(elements, "nav", "ol", "ul", where=attr_matches("class", "breadcrumb"))
    links = let(trail, lambda e: find_all(descendants(elements, e), "a"))
    from_trail = let(links, lambda a: normalise_category(F.lower(text_of(pieces, part(a, -1)))))
    marked = attr(find(elements, where=attr_exists("data-category")), "data-category")
    return F.coalesce(
        from_trail, F.nullif(normalise_category(marked), na()), first_contained(rules.CATEGORIES, F.lower(url)), na()
    )


def location(pieces: Column, elements: Column, strict: bool = False) -> Column:
    """Struct (location_raw, city, governorate, neighborhood)."""
    element = _first_rule(
        elements, ("span", "div", "p", "address"), PLACE_CLASS,
        (attr_equals("itemprop", "address"), attr_matches("data-testid", "location")), strict,
    )

    def split_place(text: Column) -> Column:
        def fields(parts: Column) -> Column:
            several = F.size(parts) >= 2
            return F.struct(
                F.coalesce(text, na()).alias("location_raw"),
                F.when(several, F.get(parts, 1)).otherwise(F.get(parts, 0)).alias("city"),
                F.when(several, F.get(parts, 0)).alias("governorate"),
                F.get(parts, 2).alias("neighborhood"),
            )

        return let(F.transform(F.split(text, ","), strip), fields)

    return let(text_of(pieces, element), split_place)


def description(pieces: Column, elements: Column, strict: bool = False) -> Column:
    """Paragraphs of the text block, its own text, og:description, or N/A."""
    element = _first_rule(
        elements, ("div", "section", "article", "p"), TEXT_CLASS,
        (attr_equals("itemprop", "description"), attr_matches("data-testid", "description")), strict,
    )

    def body(e: Column) -> Column:
        def paragraphs(ps: Column) -> Column:
            texts = F.filter(F.transform(ps, lambda p: text_of(pieces, p)), lambda t: t != "")
            return F.when(F.size(ps) > 0, F.array_join(texts, "\n\n")).otherwise(text_of(pieces, e))

        return F.when(e.isNotNull(), let(find_all(descendants(elements, e), "p"), paragraphs))

    meta = find(elements, "meta", where=attr_equals("property", "og:description"))
    return F.coalesce(let(element, body), attr(meta, "content"), na())


def date_posted(pieces: Column, elements: Column) -> Column:
    """datetime attribute (ISO) or text of the first date element that parses."""
    candidates = (
        find(elements, "time"),
        find(elements, where=attr_exists("datetime")),
        find(elements, "span", "div", where=attr_matches("class", DATE_CLASS)),
    )

    def read(e: Column) -> Column:
        return F.coalesce(parse_iso(attr(e, "datetime")), parse_written(text_of(pieces, e)))

    return iso_text(F.coalesce(*(let(c, read) for c in candidates)))


def criteria(pieces: Column, elements: Column) -> Column:
    """Feature map from the first dl, feature tables and label/value boxes."""
    def typed(key_element: Column, value_element: Column) -> Column:
        key = criteria_key(text_of(pieces, key_element))
        return let(key, lambda k: entry(k, criteria_value(k, text_of(pieces, value_element))))

    def zipped(keys: Column, values: Column) -> Column:
        def pair(both: Column) -> Column:
            shared = F.slice(both["k"], F.lit(1), F.least(F.size(both["k"]), F.size(both["v"])))
            return F.transform(shared, lambda k, i: typed(k, F.get(both["v"], i)))

        return let(F.struct(keys.alias("k"), values.alias("v")), pair)

    def from_list(inner: Column) -> Column:
        return zipped(find_all(inner, "dt"), find_all(inner, "dd"))

    def from_table(table: Column) -> Column:
        def row(tr: Column) -> Column:
            cells = find_all(descendants(elements, tr), "td", "th")
            return let(cells, lambda c: F.when(F.size(c) >= 2, typed(F.get(c, 0), F.get(c, 1))))

        return F.transform(find_all(descendants(elements, table), "tr"), row)

    def from_box(box: Column) -> Column:
        inner = descendants(elements, box)
        return let(
            inner,
            lambda es: zipped(
                find_all(es, "span", "div", "p", where=attr_matches("class", LABEL_CLASS)),
                find_all(es, "span", "div", "p", where=attr_matches("class", VALUE_CLASS)),
            ),
        )

    nothing = F.array().cast("array<struct<key:string,value:string>>")
    lists = let(find(elements, "dl"), lambda dl: F.when(dl.isNotNull(), let(descendants(elements, dl), from_list)))
    tables = F.flatten(F.transform(find_all(elements, "table", where=attr_matches("class", TABLE_CLASS)), from_table))
    boxes = F.flatten(F.transform(find_all(elements, "div", where=attr_matches("class", BOX_CLASS)), from_box))
    entries = F.concat(*(F.coalesce(part_, nothing) for part_ in (lists, tables, boxes)))
    return last_wins_map(F.filter(entries, lambda e: e.isNotNull()))


def images(elements: Column, site: Site = CLASSIFIEDS) -> Column:
    """Gallery pictures, else those of the content block, else all."""
    gallery = find(elements, "div", "section", where=attr_matches("class", GALLERY_CLASS))
    content = find(elements, "main", "article", "div", where=attr_matches("class", CONTENT_CLASS))
    scope = let(
        F.coalesce(gallery, content),
        lambda e: F.when(e.isNotNull(), descendants(elements, e)).otherwise(elements),
    )

    def source(img: Column) -> Column:
        return F.coalesce(truthy(attr(img, "data-src")), truthy(attr(img, "src")))

    def usable(img: Column) -> Column:
        width = strip(attr(img, "width"))
        small = width.rlike(r"^[+-]?[0-9]+$") & (width.try_cast("bigint") < rules.MIN_IMAGE_WIDTH)
        return source(img).isNotNull() & ~F.coalesce(small, F.lit(False))

    urls = F.transform(find_all(scope, "img", where=usable), lambda img: resolve_url(source(img), site.base_url))
    return F.array_distinct(urls)


# --- plan ------------------------------------------------------------------------


def extract(
    pages: DataFrame, site: Site = CLASSIFIEDS, validate: bool = True, strict: bool = False, max_images: int | None = None,
    fields: Iterable[str] | None = None,
) -> DataFrame:
    """Pages to listing records.

    ``strict=True`` leaves out the class-attribute rules for price, place and
    text.  Records read from embedded JSON are not validated here.
    ``max_images`` bounds the stored pictures; the count is that of all.  ``fields`` are those wanted of records that
    are not validated.
    """
    wanted = None if validate or fields is None else frozenset(fields)
    base = page_columns(pages)
    opened = base.select(
        "seq", "url", "scraped_at", "html", embedded_script(F.col("html")).alias("script")
    ).select("seq", "url", "scraped_at", "html", embedded_record(F.col("script"), site).alias("ready"))
    parsed = opened.select(
        "seq", "url", "scraped_at", "ready",
        # pages with a usable embedded record are not parsed at all
        parse_html(F.when(F.col("ready").isNull(), F.col("html")), tags=RULE_TAGS).alias("doc"),
    ).select("seq", "url", "scraped_at", "ready", "doc.pieces", "doc.elements")

    p, e, url, ready = F.col("pieces"), F.col("elements"), F.col("url"), F.col("ready")
    # without a parsed document the rules see NULL arrays and cost nothing
    ruled = parsed.select(
        "seq", "url", "scraped_at", "ready",
        listing_id(url, e, site).alias("listing_id"),
        page_title(p, e, site, skip_empty=False).alias("title"),
        price(p, e, strict).alias("price"),
        category(p, e, url).alias("category"),
        location(p, e, strict).alias("place"),
        description(p, e, strict).alias("description"),
        date_posted(p, e).alias("date_posted"),
        criteria(p, e).alias("criteria"),
        images(e, site).alias("image_urls"),
    )

    def pick(name: str, markup: str | None = None) -> Column:
        return F.when(ready.isNotNull(), F.col(f"ready.{name}")).otherwise(F.col(markup or name))

    features, pictures = pick("criteria"), pick("image_urls")
    columns = {
        "seq": F.col("seq"),
        "source": F.lit(site.domain),
        "listing_id": pick("listing_id"),
        "listing_url": url,
        "title": pick("title"),
        "description": pick("description"),
        "category": pick("category"),
        "price_raw": pick("price_raw", "price.price_raw"),
        "price_numeric": pick("price_numeric", "price.price_numeric"),
        "currency": pick("currency", "price.currency"),
        "location_raw": pick("location_raw", "place.location_raw"),
        "city": pick("city", "place.city"),
        "governorate": pick("governorate", "place.governorate"),
        "neighborhood": F.when(ready.isNull(), F.col("place.neighborhood")),
        **{k: lifted(features, k) for k in ("surface", "rooms", "bedrooms", "bathrooms")},
        "criteria": features,
        "image_urls": at_most(pictures, max_images),
        "image_count": F.size(pictures),
        "date_posted": pick("date_posted"),
        "scraped_at": F.col("scraped_at"),
        "embedded": ready.isNotNull(),
    }
    keep = (lambda r: r["embedded"] | required(r)) if validate else None
    return emit(ruled, columns, keep, wanted)
