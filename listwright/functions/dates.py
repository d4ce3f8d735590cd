"""Date expressions.  Every parser returns DATE and NULL for bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listwright.functions.text import SPACE_CLASS, let, strip

# --- fixed values: shapes of written dates ---
_CLOCK = r"(?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?|[0-5][0-9](?:[0-5][0-9](?:[.,][0-9]+)?)?)?"
_OFFSET = r"(?:Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9](?::?[0-5][0-9](?:[.,][0-9]+)?)?)?)?"
_TIME_PART = rf"(?:(?s:.){_CLOCK}{_OFFSET})?$"

_ISO_DASHED = rf"^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}){_TIME_PART}"
_ISO_BASIC = rf"^([0-9]{{8}}){_TIME_PART}"
_ISO_WEEK = rf"^([0-9]{{4}})-?W([0-9]{{2}})(?:-?([1-7]))?{_TIME_PART}"


def _iso_week_date(c: Column) -> Column:
    year = F.regexp_extract(c, _ISO_WEEK, 1).try_cast("int")
    week = F.regexp_extract(c, _ISO_WEEK, 2).try_cast("int")
    day = F.coalesce(F.nullif(F.regexp_extract(c, _ISO_WEEK, 3), F.lit("")).try_cast("int"), F.lit(1))
    monday = F.date_add(F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week"), (week - 1) * 7)
    return F.when((week >= 1) & (F.weekofyear(monday) == week), F.date_add(monday, day - 1))


def parse_iso(c: Column) -> Column:
    """ISO 8601 date or date-time; the date part is taken in its own offset."""
    return F.coalesce(
        F.when(c.rlike(_ISO_DASHED), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")),
        F.when(c.rlike(_ISO_BASIC), F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd")),
        F.when(c.rlike(_ISO_WEEK), _iso_week_date(c)),
    )


def parse_written(c: Column) -> Column:
    """25/01/2024, 2024-1-5, 25-01-2024 or January 25, 2024."""
    spaced = F.regexp_replace(c, rf"[{SPACE_CLASS}]+", " ")
    return F.coalesce(
        F.when(c.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(c, "d/M/yyyy")),
        F.when(c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_date(c, "yyyy-M-d")),
        F.when(c.rlike(r"^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$"), F.try_to_date(c, "d-M-yyyy")),
        F.when(spaced.rlike(r"^[A-Za-z]+ [0-9]{1,2}, [0-9]{4}$"), F.try_to_date(spaced, "MMMM d, yyyy")),
    )


def parse_posted(c: Column) -> Column:
    """Posting date as the date filter reads it: ISO first, then written forms."""
    text = strip(c)
    return F.coalesce(parse_iso(text), parse_written(text))


def parse_stored(c: Column) -> Column:
    """Posting date as the store reads it: ISO only."""
    return parse_iso(c)


def parse_french(c: Column) -> Column:
    """d/m/y with two or four year digits; two-digit years from 69 are 19xx."""
    short = r"^([0-9]{1,2}/[0-9]{1,2}/)([0-9]{2})$"

    def full_year(text: Column) -> Column:
        year = F.regexp_extract(text, short, 2)
        century = F.when(year >= "69", F.lit("19")).otherwise(F.lit("20"))
        return F.when(text.rlike(short), F.concat(F.regexp_extract(text, short, 1), century, year)).otherwise(text)

    def read(text: Column) -> Column:
        return F.when(text.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(text, "d/M/yyyy"))

    return let(let(c, full_year), read)


# unit word in normalised French text -> days per unit
# --- fixed values: days of relative time words ---
_RELATIVE_DAYS = {"jours?": 1, "semaines?": 7, "mois": 30, "heures?": 0}


def parse_relative_french(c: Column, as_of: Column) -> Column:
    """'il y a 3 jours' and the like, counted back from the ``as_of`` date."""
    def steps(tail: Column) -> Column:
        amounts = {unit: F.regexp_extract(tail, rf"il y a\s+([0-9]+)\s+{unit}", 1).try_cast("int") for unit in _RELATIVE_DAYS}
        return F.coalesce(*(F.date_sub(as_of, amount * _RELATIVE_DAYS[unit]) for unit, amount in amounts.items()))

    # nothing matches before the words stand for the first time; the search for them is a plain one
    found = F.instr(c, "il y a")
    return F.when(found > 0, let(F.substr(c, found), steps))


def iso_text(c: Column) -> Column:
    """DATE as yyyy-MM-dd text."""
    return c.cast("string")
