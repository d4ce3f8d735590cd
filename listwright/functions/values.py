"""Value expressions: numbers, booleans, currencies, categories, criteria."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from listwright import rules
from listwright.functions.text import SPACE_CLASS, WORD_CLASS, ascii_fold, let, lookup, strip

_DIGITS = "".join(chr(c) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Nd")
_DIGITS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)

# a number as adverts write it: digits, then digits / spaces / dots / commas
AMOUNT = rf"\p{{Nd}}[\p{{Nd}}{SPACE_CLASS}.,]*"


def ascii_digits(c: Column) -> Column:
    """Decimal digits of other scripts as 0-9."""
    return F.translate(c, _DIGITS, _DIGITS_ASCII)


# The casts below give NULL for an empty text, so no emptiness tests are needed,
# and each argument occurs once: inside lambdas nothing is shared.


def number_of_digits(c: Column) -> Column:
    """All digits of a price element joined: '250.50 TND' is 25050."""
    return ascii_digits(F.regexp_replace(c, r"\P{Nd}", "")).try_cast("double")


def number_plain(c: Column) -> Column:
    """Spaces and commas dropped, the dot is the decimal point."""
    return strip(ascii_digits(F.translate(c, " ,", ""))).try_cast("double")


def number_dotted(c: Column) -> Column:
    """Comma and dot both are decimal points; two of them give NULL."""
    kept = F.translate(F.regexp_replace(c, r"[^\p{Nd}.,]", ""), ",", ".")
    return ascii_digits(kept).try_cast("double")


def number_spoken(c: Column) -> Column:
    """As :func:`number_dotted`, after folding and dropping 'a partir de'."""
    return number_dotted(F.regexp_replace(ascii_fold(c), r"(?i)a partir de", ""))


def first_count(c: Column) -> Column:
    """First whole number: '10+' is 10."""
    return ascii_digits(F.regexp_extract(c, r"\p{Nd}+", 0)).try_cast("double")


def first_decimal(c: Column) -> Column:
    """First number with an optional fraction."""
    return ascii_digits(F.regexp_extract(c, r"\p{Nd}+\.?\p{Nd}*", 0)).try_cast("double")


def parse_boolean(c: Column) -> Column:
    """True when one of the affirmative words occurs anywhere."""
    return F.lower(c).rlike("|".join(rules.TRUE_WORDS))


def currency_code(c: Column) -> Column:
    """Known symbol (exact case) or the upper-cased text."""
    return F.coalesce(lookup(rules.CURRENCIES, c), F.upper(c))


def currency_code_any_case(c: Column) -> Column:
    """Portal rule: dinar spellings in any case, the word 'euro', then symbols."""
    upper = F.upper(c)
    return (
        F.when(upper.isin("DT", "TND"), F.lit("TND"))
        .when(upper == "EURO", F.lit("EUR"))
        .otherwise(F.coalesce(lookup(rules.CURRENCIES, c), upper))
    )


def currency_mentioned(c: Column) -> Column:
    """Code of the first known symbol contained in the text, any case."""
    text = F.lower(c)
    return F.coalesce(*(F.when(text.contains(s.lower()), F.lit(code)) for s, code in rules.CURRENCIES.items()))


def normalise_category(c: Column) -> Column:
    """Synonym table on the trimmed lower-case text; unknown text is kept."""
    return F.coalesce(lookup(rules.CATEGORIES, strip(F.lower(c))), c)


def criteria_key(c: Column) -> Column:
    """Label of a feature as a key; accents are kept on purpose."""
    key = F.regexp_replace(F.lower(c), rf"[^{WORD_CLASS}{SPACE_CLASS}]", "")
    key = F.regexp_replace(key, rf"[{SPACE_CLASS}]+", "_")
    return F.coalesce(lookup(rules.CRITERIA_KEYS, key), key)


def criteria_value(key: Column, value: Column) -> Column:
    """Typed feature value in text form: '120.0', 'true', or the text itself."""
    def typed(v: Column) -> Column:
        number = F.when(key.isin(*rules.NUMERIC_CRITERIA), first_decimal(v)).cast("string")
        flag = F.when(key.isin(*rules.BOOLEAN_CRITERIA), parse_boolean(v)).cast("string")
        return F.coalesce(number, flag, v)

    return let(value, typed)


def looks_like_amount(c: Column) -> Column:
    """Line with a number and a currency."""
    return c.rlike(rf"(?iu){AMOUNT}[{SPACE_CLASS}]*(DT|TND|EUR|€|\$)")


def last_wins_map(entries: Column) -> Column:
    """Map of (key, value) structs in which a later entry replaces an earlier one."""
    def keep_last(es: Column) -> Column:
        backwards = F.reverse(F.transform(es, lambda e: e["key"]))
        return let(
            backwards,
            lambda keys: F.filter(es, lambda e, i: F.array_position(keys, e["key"]) == F.size(keys) - i),
        )

    return F.map_from_entries(let(entries, keep_last))


def entry(key: str | Column, value: Column) -> Column:
    """One (key, value) struct for :func:`last_wins_map`."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.struct(key.alias("key"), value.cast("string").alias("value"))
