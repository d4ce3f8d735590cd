"""Secret scans: patterns, and zstandard novelty primed with a dictionary.

Three patterns give the base spans. Beyond them, long strings close behind a
sensitive word are candidates: each is compressed together with the text
around it, by a compressor primed with the corpus' frequent identifiers, and
what it adds over its surroundings alone is its novelty. A string made of known
identifiers or repeated nearby adds a few bytes; a random one about as many as
its alphabet needs. Candidates that add at least `least_novelty` bytes a
character are spans of kind ``novel``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listwright.llm import worker
from listwright.llm.frequent import frequent

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"passw|passphrase|pwd|secret|token|api.?key|private.?key|access.?key|credential|authorization|bearer|signature", re.A | re.I)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
IDENTIFIER = re.compile(r"\b[A-Za-z_]{4,24}\b", re.A)  # without digits, so that copied secrets don't get in

SPANS = "array<struct<kind:string,start:int,end:int,novelty:int>>"


class Scanner:
    """Finds the secrets of single texts."""

    def __init__(self, dictionary: bytes, least_novelty: float, reach: int, around: int) -> None:
        options = {}
        if len(dictionary) >= 8:
            options["dict_data"] = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=False, **options)
        self.least, self.reach, self.around = least_novelty, reach, around

    def novelty(self, text: str, start: int, end: int) -> int:
        """Bytes that a span adds to its compressed surroundings.

        Other copies of the span are blanked out of the surroundings, so that
        each copy has the novelty of a single one.
        """
        own = text[start:end]
        before, after = text[max(0, start - self.around):start].replace(own, " "), text[end:end + self.around].replace(own, " ")
        size = lambda t: len(self.compressor.compress(t.encode()))
        return max(0, size(before + own + after) - size(before + after))

    def base(self, text: str) -> Iterator[tuple[str, int, int]]:
        low = text.lower()
        if "token" in low or "secret" in low or "passw" in low or "api" in low:
            for m in ASSIGN.finditer(text):
                if m.end(2) - m.start(2) >= 6:
                    yield "assign", m.start(), m.end()
        if "AKIA" in text:
            for m in ACCESS.finditer(text):
                yield "access", m.start(), m.end()
        for m in HEX.finditer(text):
            yield "hex", m.start(), m.end()

    def spans(self, text: str) -> list[dict]:
        """All spans by start, then kind."""
        found = list(self.base(text))
        taken = sorted((a, b) for _, a, b in found)
        seen, at = -1, 0
        for m in SENSITIVE.finditer(text):
            for c in CANDIDATE.finditer(text, max(m.end(), seen), m.end() + self.reach + 4096):
                if c.start() > m.end() + self.reach:
                    break
                start, end = c.span()
                if end == m.end() + self.reach + 4096:  # goes on beyond the part searched
                    end = CANDIDATE.match(text, start).end()
                seen = end
                while at < len(taken) and taken[at][1] <= start:
                    at += 1
                if at < len(taken) and taken[at][0] < end:
                    continue
                if self.novelty(text, start, end) >= self.least * (end - start):
                    found.append(("novel", start, end))
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
        return [{"kind": k, "start": a, "end": b, "novelty": self.novelty(text, a, b)} for k, a, b in found]


def identifier_dictionary(docs: DataFrame, text: str = "text", min_share: float = 1e-4, size: int = 65_536) -> bytes:
    """The most frequent identifiers of all texts, the most frequent last, where zstandard finds them nearest."""
    found, out = 0, []
    for item in frequent(docs, text, IDENTIFIER.findall, min_share, size // 4, exact=True):
        found += len(item) + 1
        if found > size:
            break
        out.append(item)
    return " ".join(reversed(out)).encode()


def scan(docs: DataFrame, text: str = "text", out: str = "secrets", least_novelty: float = 0.65, reach: int = 64, around: int = 256, dictionary: bytes | None = None) -> DataFrame:
    """Adds `out`, all spans (kind, start, end, novelty) by start, then kind.

    Places are code points, the end is exclusive. Null and empty texts have no
    spans (an empty array); rows are independent, so repeated rows and empty
    tables need no rule; other columns pass unchanged, one named `out` is
    replaced. `dictionary` replaces the one made of all texts of `docs`.

    A candidate has 16 characters or more and starts within `reach` characters
    behind a sensitive word; it is measured against `around` characters on
    either side and is a secret when it adds `least_novelty` bytes a character
    or more. Letters and digits need not be mixed.
    """
    names = [c for c in docs.columns if c != out]
    primed = docs.sparkSession.sparkContext.broadcast(identifier_dictionary(docs, text) if dictionary is None else dictionary)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.int32())]))

    def run(batches):
        scanner = Scanner(primed.value, least_novelty, reach, around)
        for batch in batches:
            spans = [scanner.spans(t) for t in worker.texts(batch.column(text))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], names=[*names, out])

    kept = docs.select(*worker.columns(names))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, `{out}` {SPANS}")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(name: str):
    return lambda kind: kind == name


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: key, counts of the base kinds and of `novel`, base_sha256, spans, novelty.

    A null key stays null; see `scan` for null, empty and repeated texts.
    """
    found = scan(docs.select(*(c.alias(n) for c, n in zip(worker.columns([key, text]), ("key", "text")))), **options)
    kinds = F.col("secrets.kind")
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.filter("secrets", lambda s: s["kind"] != "novel")
    return found.select(
        F.col("key").alias(key), *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("secrets")).alias("spans"),
        F.array_join(F.col("secrets.novelty").cast("array<string>"), ",").alias("novelty"))
