"""Text expressions: trimming, accent folding, label and slug normalisation.

All functions map Column -> Column and stay in the JVM.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as one string (for trim) and as a regex class body
SPACES = "".join(
    chr(cp) for cp in range(0x3001) if chr(cp).isspace()
)
SPACE_CLASS = r"\t-\r\x1c-\x20\x85\p{Z}"
# those of them that a text line may hold, as a class body of Python's regexes
LINE_SPACES = r"\t\x1f \xa0\u1680\u2000-\u200a\u202f\u205f\u3000"
# a "word" character in the Unicode sense: letter, number or underscore
WORD_CLASS = r"\p{L}\p{N}_"


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` alone keeps nbsp)."""
    return F.trim(c, F.lit(SPACES))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def is_blank(c: Column) -> Column:
    return c.isNull() | (c == "")


@lru_cache(maxsize=None)
def _fold_tables() -> tuple[str, str, str, str]:
    """Compatibility decomposition reduced to ASCII, derived from Unicode data.

    Returns the two sides of a one-to-one character table, a coarse regex class
    around the characters that expand to several ASCII characters (few ranges,
    so that it is fast), and these expansions in ``str_to_map`` notation.
    """
    single_from, single_to, several = [], [], {}
    for cp in chain(range(0x80, 0xD800), range(0xE000, 0x20000)):
        plain = unicodedata.normalize("NFKD", chr(cp)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            single_from.append(chr(cp))
            single_to.append(plain)
        elif plain:
            several[chr(cp)] = plain
    ranges: list[list[int]] = []
    for cp in map(ord, several):
        if ranges and cp - ranges[-1][1] < 1024:
            ranges[-1][1] = cp
        else:
            ranges.append([cp, cp])
    around = "".join(rf"\x{{{low:x}}}-\x{{{high:x}}}" for low, high in ranges)
    pairs = "\x01".join(f"{k}\x02{v}" for k, v in several.items())
    return "".join(single_from), "".join(single_to), f"[{around}]", pairs


def ascii_fold(c: Column) -> Column:
    """Accents off, compatibility forms spelled out, other non-ASCII dropped."""
    single_from, single_to, several, pairs = _fold_tables()
    expansions = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))

    def spell_out(plain: Column) -> Column:
        # most texts are ASCII after the translation; else only the characters that may expand are
        # looked up, not those between them
        found = F.regexp_extract_all(plain, F.lit(several), F.lit(0))
        joined = F.zip_with(
            F.split(plain, several, -1), found,
            lambda text, ch: F.concat(text, F.coalesce(F.try_element_at(expansions, ch), ch, F.lit(""))),
        )
        spelled = F.when(plain.rlike(several), F.array_join(joined, "")).otherwise(plain)
        return F.when(plain.rlike(r"[^\x00-\x7F]"), F.regexp_replace(spelled, r"[^\x00-\x7F]", "")).otherwise(plain)

    # the text is worked out once, though it is tested first
    return let(c, lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), let(F.translate(t, single_from, single_to), spell_out)).otherwise(t))


def _without_punctuation(folded: Column, keep: str) -> Column:
    """Drop ASCII punctuation and control characters except ``keep``.

    The class lists what goes (folded text is ASCII): much faster than a
    negated class, which the regex engine tests character by character.
    """
    gone = (chr(cp) for cp in range(128) if not (chr(cp).isalnum() or chr(cp).isspace() or chr(cp) in "_" + keep))
    return F.regexp_replace(folded, "[" + "".join(rf"\x{ord(ch):02x}" for ch in gone) + "]+", "")


def normalise_label(c: Column, keep: str) -> Column:
    """Fold, lower-case, drop punctuation except ``keep``, collapse spaces."""
    t = _without_punctuation(F.lower(ascii_fold(c)), keep)
    return F.trim(F.regexp_replace(t, r"[\s\x1c-\x1f]+", " "))


REFLINE_KEEP = "/*+>-"
PORTAL_KEEP = "/:+>-"


def refline_label(c: Column) -> Column:
    return normalise_label(c, REFLINE_KEEP)


def portal_label(c: Column) -> Column:
    return normalise_label(c, PORTAL_KEEP)


def normalise_lines(lines: Column, keep: str) -> Column:
    """:func:`normalise_label` of every line, done on the joined text at once.

    One pass over a page instead of one per line; lines hold no newline, so the
    positions stay parallel.
    """
    t = _without_punctuation(F.lower(ascii_fold(F.array_join(lines, "\n"))), keep)
    t = F.regexp_replace(t, r"[ \t\x0b\f\r\x1c-\x1f]+", " ")
    t = F.trim(F.replace(F.replace(t, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))
    return F.when(F.size(lines) > 0, F.split(t, "\n")).otherwise(F.slice(lines, 1, 0))


def slugify(c: Column) -> Column:
    """A human place name as a URL slug."""
    t = F.regexp_replace(ascii_fold(c), r"[^a-zA-Z0-9]+", "-")
    return F.lower(F.trim(t, F.lit("-")))


def slug_path(c: Column) -> Column:
    """Slugify every non-blank segment of a ``/`` separated path."""
    segments = F.filter(F.split(c, "/"), lambda s: strip(s) != "")
    return F.array_join(F.transform(segments, slugify), "/")


def stable_id(url: Column, prefix: str, digits: int = 32) -> Column:
    """Generated listing id: prefix + hex digits of the URL's MD5, all of them unless told otherwise."""
    return F.concat(F.lit(prefix), F.substring(F.md5(url), 1, digits))


def lookup(table: dict[str, str], key: Column) -> Column:
    """Dictionary lookup; NULL when the key is unknown."""
    entries = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.try_element_at(entries, key)


def first_contained(table: dict[str, str], haystack: Column) -> Column:
    """Value of the first key (in table order) that occurs in ``haystack``."""
    hits = [F.when(haystack.contains(k), F.lit(v)) for k, v in table.items()]
    return F.coalesce(*hits)


def present(c: Column) -> Column:
    """Truthy and not the missing sentinel."""
    return c.isNotNull() & (c != "") & (c != "N/A")


def match(c: Column, pattern: str, group: int = 0) -> Column:
    """Regex group of the first match, NULL (not '') when it is empty or absent."""
    return let(F.regexp_extract(c, pattern, group), lambda found: F.when(found != "", found))
