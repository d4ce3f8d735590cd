"""Quality rules, line first: failing lines go, then documents that lost too much.

A line fails when it reads like no sentence (no mark that ends one, a flood of
symbols or exclamation marks), like navigation (short items between
separators) or like boilerplate (licence, cookie and copyright phrases). The
lines that fail are removed; a document stays when the lines that passed hold
at least ``1 - max_lost`` of the characters of all its lines with a word, and
when the plain counts below don't rule it out.

Everything is a built-in expression over one row, so there is no shuffle and no
Python worker; filter on other columns before, because filters on the results
stay above the expressions. Repeated five-word windows are found through their hashes: a
text whose hashes all differ is done, in others equal neighbours of the sorted
hashes are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.llm import worker

WHITE = " \t\n\x0b\f\r"
# Patterns and phrases of the line rules, the same for Spark and for SQL.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
SENTENCE_END = "[.!?…][\"'\\)\\]»”’]*(?:[\\x20\\x09-\\x0D]|$)"
SEPARATOR = "[|»›•·]"
BOILERPLATE = (
    "all rights reserved", "licensed under", "terms of use", "terms of service", "privacy policy", "cookie", "javascript", "lorem ipsum",
    "copyright", "alle rechte vorbehalten", "tous droits", "todos los derechos",
)
WINDOW = 5  # words of a window that may repeat
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words


def _any(text: Column) -> Column:
    found = text.contains(BOILERPLATE[0])
    for phrase in BOILERPLATE[1:]:
        found = found | text.contains(phrase)
    return found


def line_fails(line: Column, boilerplate: bool = True) -> Column:
    """Whether a line breaks a rule, with or without boilerplate; lines without a word break none.

    ``items`` is the number of blanks plus one. Navigation: two separators or
    more, at least one for three items. Punctuation: no sentence mark at a
    word's end, or more symbols, or more exclamation marks, than half the items.
    """
    items = F.size(F.split(line, " "))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = (separators >= 2) & (separators * 3 >= items)
    flood = (F.regexp_count(line, F.lit(SYMBOL)) * 2 > items) | (F.length(line) - F.length(F.replace(line, F.lit("!"))) > items / 2)
    broken = ~line.rlike(SENTENCE_END) | flood | navigation
    return line.rlike(WORD) & (broken | _any(F.lower(line)) if boilerplate else broken)


def _counts(rows: DataFrame) -> DataFrame:
    """Adds the plain counts to rows with a text ``t``."""
    trimmed = F.btrim("t", F.lit(WHITE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))
    lines = F.split("t", "\n")
    worded = F.filter("lines", lambda line: line.rlike(WORD))
    rows = rows.withColumns({"words": words, "lines": lines}).withColumns({"n_words": F.size("words"), "worded": worded})

    def window(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *(F.get("words", i + k) for k in range(1, WINDOW)))

    starts = F.slice("words", F.lit(1), F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)))
    rows = rows.withColumn("hashes", F.transform(starts, window))
    repeated = F.size(F.array_distinct("hashes")) < F.size("hashes")
    rows = rows.withColumn("sorted", F.when(repeated, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def same(here: Column, there: Column) -> Column:
        equal = F.slice("words", here["i"] + 1, F.lit(WINDOW)) == F.slice("words", there["i"] + 1, F.lit(WINDOW))
        return F.coalesce(F.when(here["h"] == there["h"], equal), F.lit(False))

    found = F.filter("sorted", lambda s, j: same(s, F.get("sorted", j - 1)) | same(s, F.get("sorted", j + 1)))
    rows = rows.withColumn("places", F.sort_array(F.transform(found, lambda s: s["i"])))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def cover(state: Column, i: Column) -> Column:
        return F.struct((i + WINDOW).alias("end"), (state["n"] + i + WINDOW - F.greatest(i, state["end"])).alias("n"))

    covered = F.coalesce(F.aggregate("places", zero, cover, lambda state: state["n"]), F.lit(0))
    return rows.withColumns({
        "word_chars": F.aggregate("words", F.lit(0), lambda n, w: n + F.length(w)),
        "n_symbols": F.regexp_count("t", F.lit(SYMBOL)),
        "n_dup_lines": F.size("worded") - F.size(F.array_distinct("worded")),
        "n_repeat_words": covered,
    }).drop("hashes", "sorted", "places", "words")


def _lines(rows: DataFrame, max_lost: float) -> DataFrame:
    """Adds what the line rules leave to rows with the columns of `_counts`."""
    # phrases are looked for in the whole text first, outside the lines' expression, which would repeat it for each line
    rows = rows.withColumn("low", F.lower("t"))
    rows = rows.withColumn("failed", F.when(_any(F.col("low")), F.transform("lines", lambda line: line_fails(line))).otherwise(F.transform("lines", lambda line: line_fails(line, False))))
    measured = F.zip_with("lines", "failed", lambda line, bad: F.when(bad, F.length(line)).otherwise(0))
    size = lambda lengths: F.aggregate(lengths, F.lit(0), lambda n, x: n + x)
    rows = rows.withColumns({"lost_chars": size(measured), "line_chars": size(F.transform("worded", F.length))})
    base = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    passed = ~F.col("base_failed") & (F.col("lost_chars") <= F.col("line_chars") * F.lit(max_lost))
    # marked as not deterministic: a filter on a result must not be moved below, where it would work everything out again for each word
    return rows.withColumn("base_failed", base).withColumn("kept", passed & (F.monotonically_increasing_id() >= 0))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def clean(docs: DataFrame, text: str = "text", cleaned: str = "cleaned", kept: str = "kept", max_lost: float = 0.5) -> DataFrame:
    """Adds `cleaned`, the text without its failing lines, and `kept`.

    Lines are those between line feeds; lines without a word stay where they
    are. Null and empty texts are cleaned to the empty text and not kept.
    Rows are independent, so repeated rows and empty tables need no rule; other
    columns pass unchanged whatever their names, those named `cleaned` or
    `kept` are replaced.
    """
    names = [c for c in docs.columns if c not in (cleaned, kept)]
    rows = docs.select(F.struct(*worker.columns(names)).alias("row"), F.coalesce(*worker.columns([text]), F.lit("")).alias("t"))
    done = _lines(_counts(rows), max_lost)
    passing = F.filter("lines", lambda _, i: ~F.get("failed", i))
    return done.select(*[F.col("row").getField(c).alias(c) for c in names], F.array_join(passing, "\n").alias(cleaned), F.col("kept").alias(kept))


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text", max_lost: float = 0.5) -> DataFrame:
    """Per row: key, the plain counts, base_failed, kept, n_lines_failed, lost_chars.

    A null key stays null; see `clean` for null, empty and repeated texts.
    """
    own, t = worker.columns([key, text])
    done = _lines(_counts(docs.select(own.alias("key"), F.coalesce(t, F.lit("")).alias("t"))), max_lost)
    failed = F.size(F.filter("failed", lambda x: x))
    return done.select(
        F.col("key").alias(key), *[F.col(c).cast("long").alias(c) for c in COUNTS], "base_failed", "kept",
        failed.cast("long").alias("n_lines_failed"), F.col("lost_chars").cast("long").alias("lost_chars"))


def oracle(max_lost: float = 0.5) -> str:
    """DuckDB SQL for `summary` over documents."""
    quoted = lambda s: s.replace("'", "''")
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
        l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
        measured AS (
            SELECT doc_id, line, len(string_split(line, ' ')) AS items, len(regexp_extract_all(line, '{SEPARATOR}')) AS separators,
                   len(regexp_extract_all(line, '{SYMBOL}')) AS symbols, length(line) - length(replace(line, '!', '')) AS bangs
            FROM l WHERE regexp_matches(line, '{WORD}')),
        judged AS (
            SELECT doc_id, line, NOT regexp_matches(line, '{quoted(SENTENCE_END)}') OR symbols * 2 > items OR bangs * 2 > items
                   OR (separators >= 2 AND separators * 3 >= items) OR {phrases} AS bad FROM measured),
        lines AS (
            SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (bad) AS n_lines_failed,
                   coalesce(sum(length(line)) FILTER (bad), 0)::BIGINT AS lost_chars, sum(length(line))::BIGINT AS line_chars
            FROM judged GROUP BY doc_id),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}),
        windows AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM starts),
        twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
        covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, range({WINDOW}) r(k) GROUP BY doc_id),
        counted AS (
            SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{GAP}', '', 'g'))::BIGINT AS word_chars,
                   len(regexp_extract_all(t, '{SYMBOL}'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines_failed, 0)::BIGINT AS n_lines_failed,
                   coalesce(lost_chars, 0)::BIGINT AS lost_chars, coalesce(line_chars, 0) AS line_chars
            FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
        based AS (SELECT *, n_words < {LEAST_WORDS} OR n_repeat_words * 100 > n_words * {MOST_REPEATED} AS base_failed FROM counted)
        SELECT doc_id, {', '.join(COUNTS)}, base_failed, NOT base_failed AND lost_chars <= line_chars * {max_lost} AS kept, n_lines_failed, lost_chars
        FROM based
    """
