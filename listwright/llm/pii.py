"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is a built-in expression: ``regexp_extract_all`` gives the matches,
``split`` at the same pattern the text between them, and a running sum of
lengths the places, in code points. Patterns start only where a run of their
characters starts and never give characters back, so their time is linear in
the text and long runs need no stack.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.llm import worker

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
CONTEXT = 40  # characters before and after a span that are searched for context words


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _luhn(digits: Column) -> Column:
    """Whether a row of digits passes the Luhn check."""
    def summed(d: Column) -> Column:
        def share(i: Column) -> Column:  # i counts from the right end, from 0
            digit = F.substr(d, F.length(d) - i, F.lit(1)).cast("int")
            doubled = digit * 2
            return F.when(i % 2 == 0, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda acc, i: acc + share(i)) % 10 == 0
    return _let(digits, summed)


def _mod97(account: Column) -> Column:
    """Whether an account number without spaces passes the mod-97 check."""
    def remainder(a: Column) -> Column:
        turned = F.concat(F.substr(a, F.lit(5)), F.substr(a, F.lit(1), F.lit(4)))

        def step(acc: Column, i: Column) -> Column:
            value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(turned, i, F.lit(1))) - 1
            return (acc * F.when(value > 9, 100).otherwise(10) + value) % 97
        return F.aggregate(F.sequence(F.lit(1), F.length(a)), F.lit(0), step) == 1
    return _let(account, remainder)


def _sized(digits: Column, least: int, most: int) -> Column:
    return F.length(digits).between(least, most)


class Kind(NamedTuple):
    name: str
    hint: str  # texts without it can't hold the kind
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    for_words: str  # context that speaks for the kind
    against_words: str  # and against it


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

# Lengths of account numbers by country (ISO 13616).
ACCOUNT_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def account_pattern() -> str:
    """Account numbers of their country's length, single spaces anywhere; none reaches into a group that starts another one."""
    one = "(?:(?! [A-Z]{2}[0-9]{2}) ?[A-Z0-9])"
    sized = "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}{one}{{{n - 4}}}" for n, codes in ACCOUNT_LENGTHS.items())
    return f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{sized})(?![A-Za-z0-9])"


# In the order of the results; the first four are the base kinds.
KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda m: F.lit(True), 0.8, r"e-?mail|mail|contact|write|courriel|correo|kontakt", "example|noreply"),
    Kind("ip", ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"), 0.7, r"\bip\b|host|server|address|login|adresse", r"version|release|chapter|section"),
    Kind("card", "", r"[0-9](?:[ -]?[0-9])++",
         lambda m: _let(F.regexp_replace(m, "[ -]", ""), lambda d: F.when(_sized(d, 16, 19), _luhn(d)).otherwise(False)), 0.8,
         r"card|visa|credit|payment|karte|carte|tarjeta", r"order|serial|isbn"),
    Kind("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]",
         lambda m: _sized(F.regexp_replace(m, "[^0-9]", ""), 8, 15), 0.7, r"phone|tel|call|mobile|fax|whatsapp|anruf|appel", "formula|score"),
    Kind("iban", "", account_pattern(), lambda m: _mod97(F.replace(m, F.lit(" "))), 0.9,
         "iban|account|konto|compte|cuenta|bank", "serial"),
)
BASE = tuple(k.name for k in KINDS[:4])


def _score(kind: Kind, before: Column, after: Column) -> Column:
    """The kind's own score, 0.2 up or 0.3 down for words close by."""
    near = F.lower(F.concat_ws(" ", F.right(before, F.lit(CONTEXT)), F.left(after, F.lit(CONTEXT))))
    raised = F.when(near.rlike(kind.for_words), 0.2).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.lit(kind.score) + raised - F.when(near.rlike(kind.against_words), 0.3).otherwise(0.0)), 2)


def _spans(kind: Kind, matches: Column, between: Column) -> Column:
    """Confirmed spans; `between` are the texts around the matches."""
    parts = F.arrays_zip(matches.alias("m"), between.alias("b"), F.slice(between, F.lit(2), F.greatest(F.size(between), F.lit(1))).alias("a"))

    def step(state: Column, part: Column) -> Column:
        m = part["m"]
        start = state["at"] + F.length(part["b"])
        end = start + F.coalesce(F.length(m), F.lit(0))
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), _score(kind, part["b"], part["a"]).alias("score"))
        found = F.when(m.isNotNull() & kind.confirm(m), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.cast("int").alias("at"), found.cast(SPANS).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    return F.aggregate(parts, zero, step, lambda state: state["spans"])


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Adds `out`, all confirmed spans (kind, start, end, score), by kind, then start.

    Places are code points, the end is exclusive. Null and empty texts have no
    spans (an empty array); rows are independent, repeated rows and empty
    tables need no rule, and all other columns pass unchanged whatever their
    names; a column named `out` is replaced.
    """
    names = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*worker.columns(names)).alias("row"), F.coalesce(*worker.columns([text]), F.lit("")).alias("t"))
    parts = {}
    for k in KINDS:
        possible = F.col("t").contains(k.hint) if k.hint else F.lit(True)
        # matches and the texts between them are worked out once each
        parts[f"m_{k.name}"] = F.when(possible, F.regexp_extract_all("t", F.lit(k.pattern), F.lit(0)))
        parts[f"b_{k.name}"] = F.when(possible & F.col("t").rlike(k.pattern), F.split("t", k.pattern, -1))
    found = [F.coalesce(F.when(F.size(f"m_{k.name}") > 0, _spans(k, F.col(f"m_{k.name}"), F.col(f"b_{k.name}"))), F.array().cast(SPANS)) for k in KINDS]
    return rows.withColumns(parts).select("row.*", F.concat(*found).alias(out))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(name: str) -> Callable[[Column], Column]:
    return lambda kind: kind == name


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the base kinds, base_sha256, spans, scores.

    A null key stays null; see `find` for null, empty and repeated texts.
    """
    found = find(docs.select(*(c.alias(n) for c, n in zip(worker.columns([key, text]), ("key", "text"))))).select("key", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    kinds = F.col("pii.kind")
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        F.col("key").alias(key), *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"),
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"))


def redact(docs: DataFrame, text: str = "text", least_score: float = 0.4) -> DataFrame:
    """Replaces spans of at least `least_score` by their kind, as in ``[EMAIL]``.

    The score says how sure a span is: a kind's own score, raised or lowered by
    the words around it, between 0.4 and 1. The default takes every confirmed
    span; 0.6 leaves those that their context speaks against, such as a version
    number that looks like an address.
    Overlapping spans become one mark, that of the first. Null stays null;
    texts without such spans stay as they are; other columns pass unchanged.
    """
    names = docs.columns
    source = docs.select(F.struct(*worker.columns(names)).alias("row"), worker.columns([text])[0].alias("text"))
    found = find(source)
    spans = F.array_sort(F.transform(F.filter("pii", lambda s: s["score"] >= least_score), lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def step(state: Column, s: Column) -> Column:
        start, end = s["start"], s["end"]
        gap = F.substr(F.col("text"), state["at"] + 1, F.greatest(start - state["at"], F.lit(0)))
        mark = F.concat(gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], end).alias("at"), F.when(start >= state["at"], F.concat(state["out"], F.array(mark))).otherwise(state["out"]).cast("array<string>").alias("out"))

    done = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step,
                       lambda state: F.concat(F.array_join(state["out"], ""), F.substr(F.col("text"), state["at"] + 1)))
    marked = found.withColumn("spans", spans).withColumn("marked", F.when(F.size("spans") > 0, done).otherwise(F.col("text")))
    return marked.select(*[F.col("marked").alias(c) if c == text else F.col("row")[c].alias(c) for c in names])
