"""Language identification by Bayesian evidence fusion.

Four kinds of evidence about a row's language are combined as log odds:

* the text: a trigram model trained on a bounded sample of labelled rows,
  its log likelihood tempered because neighbouring trigrams are not independent;
* the language its markup declares, right with a given reliability;
* the address suffix, likewise;
* the host's prior: the shares of languages among all rows of the host,
  smoothed towards those of its domain, those towards all rows'.

Shares are grouped aggregates of a first pass over the texts of all rows. They
are written as a table, so that the join to the rows is a broadcast only while
the table is below Spark's threshold, and beyond it a join that splits hot
hosts. Text that no language explains better than chance is ``und``.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.llm import worker
from listwright.session import scratch_path

SLOTS = 1 << 15  # trigrams are hashed to so many slots
NONE = "und"
# Languages of country suffixes.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "co": "es", "uk": "en", "us": "en", "au": "en", "ie": "en"}
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def slots(text: str):
    """Slots of the trigrams of a text's words, in parts of bounded size."""
    words = b" ".join(text.lower().encode().translate(_PLAIN).split())
    if not words:
        return
    data = np.frombuffer(b" " + words + b" ", dtype=np.uint8)
    for start in range(0, len(data) - 2, 1 << 20):
        part = data[start:start + (1 << 20) + 2].astype(np.uint32)
        yield ((part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)) >> np.uint32(17)


class Model:
    """Log likelihoods of trigram slots by language; ``und`` takes all slots alike."""

    def __init__(self, counts: dict[str, np.ndarray]) -> None:
        self.languages = [*sorted(counts), NONE]
        rows = [np.log((counts[c] + 0.5) / (counts[c].sum() + 0.5 * SLOTS)) for c in self.languages[:-1]]
        self.table = np.array([*rows, np.full(SLOTS, -math.log(SLOTS))], dtype=np.float32)

    def score(self, text: str) -> np.ndarray | None:
        """Log likelihoods by language; None without letters."""
        total = None
        for part in slots(text):
            found = np.array([row.take(part).sum(dtype=np.float64) for row in self.table])
            total = found if total is None else total + found
        return total


def train(rows: DataFrame, text: str = "text", language: str = "lang", rows_per_language: int = 2000, max_languages: int = 500) -> Model:
    """A model of every language that labels a row, from a bounded sample of each one's texts.

    The languages are those of all labelled rows. Of each, the
    `rows_per_language` different texts with the least hashes are learned, all
    if there are fewer, so a rare language is known at every size of the table
    and the sample is the same at every run. Null labels and texts are left
    out. A column with more than `max_languages` labels holds no languages and
    raises ValueError; the model's size is bounded by it.
    """
    l, t = worker.columns([language, text])
    labelled = rows.where(l.isNotNull() & t.isNotNull()).select(l.cast("string").alias("language"), t.alias("text")).withColumn("h", F.xxhash64("text"))
    # each task sends few hashes a language; the last of them bounds the sample
    distinct = labelled.select("language", "h").distinct()
    least = distinct.withColumn("rank", F.row_number().over(Window.partitionBy("language").orderBy("h"))).where(F.col("rank") <= rows_per_language)
    bounds = least.groupBy("language").agg(F.max("h").alias("bound")).orderBy("language").limit(max_languages + 1).collect()
    if len(bounds) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not bounds:
        return Model({})
    known = rows.sparkSession.createDataFrame([(r["language"], r["bound"]) for r in bounds], "known string, bound long")
    sample = labelled.join(F.broadcast(known), F.col("language") == F.col("known")).where("h <= bound").groupBy("language", "h").agg(F.min("text").alias("text"))

    def count(frames):
        worker.only()
        counts: dict[str, np.ndarray] = {}
        for frame in frames:
            for name, t in zip(frame["language"], frame["text"]):
                own = counts.setdefault(name, np.zeros(SLOTS, np.int64))
                for part in slots(t):
                    own += np.bincount(part, minlength=SLOTS)
        yield pd.DataFrame([(name, slot, int(n)) for name, own in counts.items() for slot, n in enumerate(own) if n], columns=["language", "slot", "n"])

    # counts of at most `SLOTS` slots a language leave the cluster
    found = sample.mapInPandas(count, "language string, slot int, n long").groupBy("language", "slot").agg(F.sum("n").alias("n"))
    counts = {r["language"]: np.zeros(SLOTS, np.int64) for r in bounds}
    for r in found.groupBy("language").agg(F.collect_list(F.struct("slot", "n")).alias("c")).toLocalIterator():
        for slot, n in r["c"]:
            counts[r["language"]][slot] = n
    return Model(counts)


def _posterior(log_odds: np.ndarray) -> np.ndarray:
    shifted = np.exp(log_odds - log_odds.max())
    return shifted / shifted.sum()


def _text_log_odds(model: Model, text: str, temper: float) -> np.ndarray | None:
    found = model.score(text)
    return None if found is None else found * temper


def priors(rows: DataFrame, model: Model, host: Column, domain: Column, text: str = "text", strength: float = 20.0, temper: float = 0.2) -> DataFrame:
    """(host, prior array<double>): shares of languages by host, smoothed towards the domain's and those towards all rows'.

    Each row counts by its posterior under equal priors. Null hosts are no
    host: they get no row here and the overall shares later.
    """
    n = len(model.languages)
    # with its class, because workers need no copy of this package
    shared = rows.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    names = [f"s{i}" for i in range(n)]

    def weigh(batches):
        worker.only()
        model = pickle.loads(shared.value)
        for batch in batches:
            weights = []
            for t in worker.texts(batch.column("text")):
                odds = _text_log_odds(model, t, temper)
                weights.append(np.zeros(n) if odds is None else _posterior(odds))
            table = np.array(weights).reshape(-1, n)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("domain"), *(pa.array(table[:, i]) for i in range(n))], names=["host", "domain", *names])

    source = rows.select(host.cast("string").alias("host"), domain.cast("string").alias("domain"), worker.columns([text])[0].alias("text"))
    weights = source.mapInArrow(weigh, "host string, domain string, " + ", ".join(f"{c} double" for c in names))
    by_host = weights.groupBy("host", "domain").agg(*[F.sum(c).alias(c) for c in names])
    path = scratch_path(rows.sparkSession, "langid-hosts")
    by_host.write.parquet(path)
    by_host = rows.sparkSession.read.parquet(path)
    totals = by_host.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names]).first()
    # even the overall shares keep a little for every language, and little for none
    everywhere = np.array(list(totals)) + 1.0
    everywhere[-1] = 1.0
    everywhere /= everywhere.sum()
    everywhere[-1] = min(everywhere[-1], 1e-3)

    def smoothed(counts: list[str], above: list[Column]) -> list[Column]:
        whole = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
        return [(F.col(c) + F.lit(strength) * up) / (whole + strength) for c, up in zip(counts, above)]

    by_domain = by_host.where("domain IS NOT NULL").groupBy(F.col("domain").alias("of_domain")).agg(*[F.sum(c).alias(f"d{c}") for c in names])
    joined = by_host.where("host IS NOT NULL").join(by_domain, F.col("domain") == F.col("of_domain"), "left")
    overall = [F.lit(float(x)) for x in everywhere]
    of_domain = [F.coalesce(d, o) for d, o in zip(smoothed([f"d{c}" for c in names], overall), overall)]
    prior = joined.select("host", F.array(*smoothed(names, of_domain)).alias("prior")).groupBy("host").agg(F.first("prior").alias("prior"))
    out = scratch_path(rows.sparkSession, "langid-priors")
    prior.union(rows.sparkSession.range(1).select(F.lit(None).cast("string"), F.array(*overall))).write.parquet(out)
    return rows.sparkSession.read.parquet(out)


def identify(
    docs: DataFrame, model: Model, text: str = "text", host: Column | None = None, domain: Column | None = None, declared: Column | None = None, suffix: Column | None = None,
    language: str = "language", confidence: str = "confidence", temper: float = 0.2, declared_reliability: float = 0.9, suffix_reliability: float = 0.7, strength: float = 20.0,
) -> DataFrame:
    """Adds `language` and `confidence`, the most probable language and its posterior.

    Null and empty texts, and texts without letters, are ``und`` with
    confidence 1. Null hosts take the overall shares as prior; declared
    languages and suffixes that are null or unknown say nothing; equal
    posteriors go to the first language by name. Other columns pass unchanged
    whatever their names, repeated rows give repeated results, and an empty
    table none.
    """
    names = [c for c in docs.columns if c not in (language, confidence)]
    null = F.lit(None).cast("string")
    host, domain = null if host is None else host, null if domain is None else domain
    table = priors(docs, model, host, domain, text, strength, temper)
    base = table.where("host IS NULL").first()["prior"]
    rows = docs.select(
        F.struct(*worker.columns(names)).alias("row"), host.cast("string").alias("own_host"),
        (null if declared is None else F.lower(declared)).alias("declared"), (null if suffix is None else F.lower(suffix)).alias("suffix"))
    joined = rows.join(table.where("host IS NOT NULL"), F.col("own_host") == F.col("host"), "left").select("row", "declared", "suffix", "prior")
    shared, at = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), names.index(text)

    def run(batches):
        worker.only()
        m = pickle.loads(shared.value)
        known = {c: i for i, c in enumerate(m.languages[:-1])}

        def said(name: str | None, reliability: float) -> np.ndarray | float:
            if name not in known or len(known) < 2:
                return 0.0
            odds = np.full(len(m.languages), math.log((1 - reliability) / (len(known) - 1)))
            odds[known[name]] = math.log(reliability)
            return odds

        for batch in batches:
            found, sure = [], []
            extra = (batch.column(c).to_pylist() for c in ("declared", "suffix", "prior"))
            for t, d, s, p in zip(worker.texts(batch.column("row").field(at)), *extra):
                odds = _text_log_odds(m, t, temper)
                if odds is None:
                    found.append(NONE)
                    sure.append(1.0)
                    continue
                after = _posterior(odds + np.log(p or base) + said(d, declared_reliability) + said(SUFFIXES.get(s, s), suffix_reliability))
                best = int(after.argmax())
                found.append(m.languages[best])
                sure.append(float(after[best]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.string()), pa.array(sure, pa.float64())], names=["row", "found", "sure"])

    fields = T.StructType([rows.schema["row"], T.StructField("found", T.StringType()), T.StructField("sure", T.DoubleType())])
    done = joined.mapInArrow(run, fields)
    return done.select(*[F.col("row")[c].alias(c) for c in names], F.col("found").alias(language), F.col("sure").alias(confidence))


def document_evidence(docs: DataFrame, text: str = "text", source: str = "source") -> dict[str, Column]:
    """What documents say besides their words: host, domain, declared language and address suffix.

    The source is the host; where it is a name with dots, its last two parts
    are the domain and a last part of two letters is the suffix. The declared
    language is that of the first html or body tag in the text. Absent evidence
    is null and says nothing.
    """
    t, s = worker.columns([text, source])
    host = F.lower(F.regexp_replace(s, r"^[A-Za-z][A-Za-z0-9+.-]*+://|[/:?#].*$", ""))
    found = lambda c, pattern: F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
    return {
        "host": host, "domain": found(host, r"([^.]++\.[^.]++)$"), "suffix": found(host, r"\.([a-z]{2})$"),
        "declared": F.when(t.contains("<"), found(t, r"(?i)<(?:html|body)\b[^>]*?\b(?:xml:)?lang\s*+=\s*+[\"']?([a-z]{2,3})\b")),
    }


def page_evidence(pages: DataFrame) -> DataFrame:
    """Adds text, host, domain, declared and suffix to raw pages (url, html)."""
    html = F.regexp_replace(F.col("html"), r"(?is)<(script|style)\b[^>]*+>.*?</\1\s*+>|<!--.*?-->|<[^>]*+>|&[#A-Za-z0-9]++;", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/@?#]*+@)?([^/:?#]++)", 1))
    return pages.withColumns({
        "text": html, "host": F.when(host != "", host),
        "declared": F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*+=\s*+[\"']?([a-z]{2,3})\b", 1),
    }).withColumns({"domain": F.regexp_extract("host", r"([^.]++\.[^.]++)$", 1), "suffix": F.regexp_extract("host", r"\.([a-z]{2})$", 1)})
