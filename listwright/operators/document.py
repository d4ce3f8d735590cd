"""HTML pages as tables: text pieces and elements.

``parse_html`` is the only Python stage of the library.  It turns one HTML text
into

* ``pieces``   - the visible text nodes in document order, and
* ``elements`` - the elements in document order; ``first``/``last`` is the half
  open range of pieces below the element, ``end`` the position after its last
  descendant, ``sole`` the piece that is its only content (or -1).

Because elements are in pre-order, "descendants of e" is a slice and "first
match" is the first hit of a filter, so every extraction rule is a Catalyst
expression over these two arrays: no shuffle, no further Python.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.functions.text import let, strip
from listwright.operators import reader

# the reader travels with the task, so executors need no copy of the package
cloudpickle.register_pickle_by_value(reader)

ELEMENT_TYPE = (
    "struct<pos:int,tag:string,attrs:map<string,string>,first:int,last:int,end:int,sole:int>"
)
DOCUMENT_TYPE = f"struct<pieces:array<string>,elements:array<{ELEMENT_TYPE}>>"
LINED_TYPE = f"struct<pieces:array<string>,elements:array<{ELEMENT_TYPE}>,lines:array<string>,labels:array<string>>"
JOINED = ("page_text", "label_text")

# attributes some rule looks at; others are not carried through Arrow
RULE_ATTRIBUTES = frozenset(
    "alt class content data-ad-id data-category data-lazy data-listing-id data-original "
    "data-src data-testid datetime href id itemprop property src width".split()
)


# lines worth a look: name -> tests by view, "line" or "label"; a test is a set of whole texts, or Python patterns
# that see each line between two line ends
Picks = dict[str, dict[str, object]]


def parse_html(
    html: Column, attributes: frozenset[str] | None = RULE_ATTRIBUTES, tags: frozenset[str] | None = None, keep: str | None = None,
    texts: bool = True, picks: Picks | None = None, joined: tuple[str, ...] = (),
) -> Column:
    """Document struct of an HTML column; ``attributes=None`` keeps all attributes.

    ``tags`` leaves out elements of other tags; "*" among them stands for any tag with one of the attributes.
    ``keep`` adds the text lines and, with that punctuation kept, their labels:
    the same as :func:`text_lines` and ``normalise_lines`` give.  ``joined`` may name ``page_text``, the
    :func:`joined_text` of all pieces by spaces, and with ``keep`` ``label_text``, the labels that are not empty joined
    by spaces.  With ``keep`` there are for each of ``picks`` the 1-based places of the lines that pass one of its tests, in order.  ``texts=False`` is for rules that
    look at tags and attributes only: no pieces, and NULL for ``first``, ``last``, ``end`` and ``sole``.

    Marked non-deterministic so that Catalyst parses each page exactly once: a
    filter on an extracted field is not pushed below it and evaluated twice.
    Filters on page columns (url, source) belong before this stage.
    """
    kind = DOCUMENT_TYPE if keep is None else LINED_TYPE
    more = [f"{name}:string" for name in JOINED if name in joined] + [f"{name}:array<int>" for name in picks or ()]
    kind = ",".join([kind.removesuffix(">"), *more]) + ">"
    return F.arrow_udf(reader.batch_reader(attributes, tags, keep, texts, picks, joined), kind).asNondeterministic()(html)


def with_document(
    pages: DataFrame, html: str = "html", keep_html: bool = False, attributes: frozenset[str] | None = RULE_ATTRIBUTES,
    tags: frozenset[str] | None = None, keep: str | None = None, texts: bool = True, picks: Picks | None = None, joined: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``pieces`` and ``elements`` (see :func:`parse_html`); drop the HTML text unless asked to keep it.

    With ``keep`` also ``lines``, ``labels`` and what is ``joined``; the picks come as the struct ``at``.
    """
    doc = F.col("_doc")
    named = {name: doc[name] for name in ("pieces", "elements", *(("lines", "labels") if keep is not None else ()), *joined)}
    if picks:
        named["at"] = F.struct(*(doc[name].alias(name) for name in picks))
    parsed = pages.withColumn("_doc", parse_html(F.col(html), attributes, tags, keep, texts, picks, joined)).withColumns(named)
    return parsed.drop("_doc") if keep_html else parsed.drop("_doc", html)


# --- selectors over the two arrays --------------------------------------------

def attr(element: Column, name: str) -> Column:
    return F.try_element_at(element["attrs"], F.lit(name))


def has_attr(element: Column, name: str) -> Column:
    return F.map_contains_key(element["attrs"], name)


def find_all(elements: Column, *tags: str, where=None) -> Column:
    """Elements of the given tags (any tag if none) for which ``where`` holds."""
    def keep(e: Column) -> Column:
        tests = [e["tag"].isin(*tags)] if tags else []
        if where is not None:
            tests.append(F.coalesce(where(e), F.lit(False)))
        condition = tests[0]
        for test in tests[1:]:
            condition = condition & test
        return condition

    return F.filter(elements, keep)


def find(elements: Column, *tags: str, where=None) -> Column:
    """First such element in document order, NULL if there is none."""
    return F.get(find_all(elements, *tags, where=where), 0)


def attr_equals(name: str, value: str):
    return lambda e: attr(e, name) == value


def attr_matches(name: str, pattern: str):
    return lambda e: attr(e, name).rlike(pattern)


def attr_exists(name: str):
    return lambda e: has_attr(e, name)


def descendants(elements: Column, element: Column) -> Column:
    return F.slice(elements, element["pos"] + 2, element["end"] - element["pos"] - 1)


def joined_text(pieces: Column, separator: str = "") -> Column:
    """Trimmed non-empty pieces joined: the stripped text of the whole array."""
    return F.array_join(F.filter(F.transform(pieces, strip), lambda p: p != ""), separator)


def text_of(pieces: Column, element: Column, separator: str = "") -> Column:
    """Stripped text below an element; NULL for a NULL element."""
    def read(e: Column) -> Column:
        return joined_text(F.slice(pieces, e["first"] + 1, e["last"] - e["first"]), separator)

    return let(element, read)


def sole_text(pieces: Column, element: Column) -> Column:
    """The element's only text, NULL if it has other content."""
    return F.when(element["sole"] >= 0, F.get(pieces, element["sole"]))


def text_lines(pieces: Column) -> Column:
    """Visible text lines: trimmed, empty ones dropped."""
    lines = F.split(F.array_join(pieces, "\n"), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]")
    return F.filter(F.transform(lines, strip), lambda line: line != "")


def section(lines: Column, labels: Column, starts: tuple[str, ...], ends: tuple[str, ...]) -> Column:
    """Lines after the first start label up to the next end label.

    ``labels`` are the normalised lines, parallel to ``lines``.  NULL-free: an
    absent start label gives an empty array.
    """
    def body(rest: Column) -> Column:
        lines_, stop = rest["lines"], rest["stop"]
        return F.when(stop > 0, F.slice(lines_, F.lit(1), stop - 1)).otherwise(lines_)

    def tail(start: Column) -> Column:
        rest = F.struct(
            F.slice(lines, start + 1, F.size(lines)).alias("lines"),
            first_position(F.slice(labels, start + 1, F.size(labels)), ends).alias("stop"),
        )
        return F.when(start > 0, let(rest, body)).otherwise(F.slice(lines, 1, 0))

    return let(first_position(labels, starts), tail)


def first_position(labels: Column, wanted: tuple[str, ...]) -> Column:
    """1-based position of the first line whose label is wanted, 0 if none."""
    found = [F.array_position(labels, label).cast("int") for label in dict.fromkeys(wanted)]
    if len(found) == 1:
        return found[0]
    # a search for each label, because those compile and a test of each line does not
    return F.when(labels.isNotNull(), F.coalesce(F.least(*(F.nullif(at, F.lit(0)) for at in found)), F.lit(0)))


def first_after(places: Column, start: Column, default: Column) -> Column:
    """First of the picked places behind ``start``."""
    return F.coalesce(F.get(F.filter(places, lambda at: at > start), 0), default)


def all_places(lines: Column) -> Column:
    """1-based places of all lines, where none were picked."""
    return F.transform(lines, lambda _, i: i + 1)


def places_of(labels: Column, wanted: tuple[str, ...]) -> Column:
    """1-based places of the lines whose label is wanted."""
    return F.array_compact(F.transform(labels, lambda label, i: F.when(label.isin(*wanted), i + 1)))


def window(places: Column, start: Column, end: Column) -> Column:
    """Picked places between two others."""
    return F.filter(places, lambda at: (at > start) & (at < end))


def line_at(lines: Column, place: Column) -> Column:
    return F.get(lines, place - 1)


# --- relational form -----------------------------------------------------------


def nodes(pages: DataFrame, key: str = "page_id", html: str = "html", attributes=None) -> DataFrame:
    """One row per element (schema B5), for ad-hoc selector queries."""
    parsed = pages.select(key, parse_html(F.col(html), attributes).alias("_doc")).select(key, "_doc.*")

    def row(e: Column) -> Column:
        # the texts are cut out here, so that no element row carries the page
        return F.struct(
            e["pos"].alias("pos"),
            e["end"].alias("end_pos"),
            e["tag"].alias("tag"),
            e["attrs"].alias("attrs"),
            F.split(attr(e, "class"), " ").alias("classes"),
            text_of(F.col("pieces"), e).alias("text"),
        )

    return parsed.select(key, F.inline(F.transform("elements", row)))
