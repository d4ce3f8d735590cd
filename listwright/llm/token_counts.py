"""Token counts by a two-tier lookup on the map side.

A first pass finds the frequent pre-tokens of all texts: each task keeps a
bounded Misra-Gries summary and sends only entries that reach a share of its
own pre-tokens, a quarter of `min_share`, so no frequent one is missed. The token lengths of the `table_limit` most
frequent ones are broadcast, a table of bounded size. The second pass sums
lengths from this table; misses are encoded and kept in a worker's cache. No
pre-token is shuffled, only the summaries' few entries are. Which tier answers
never changes a count.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.llm import worker
from listwright.llm.bpe import tokenizer
from listwright.llm.frequent import frequent


def frequent_lengths(docs: DataFrame, path: str, text: str = "text", min_share: float = 1e-4, table_limit: int = 65_536) -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of column `text`."""
    def pieces_of(t: str) -> list[str]:
        bpe = tokenizer(path)
        return [p for plain, _ in bpe.segments(t) for p in bpe.split(plain)]

    found = frequent(docs, text, pieces_of, min_share, table_limit)
    bpe = tokenizer(path)
    return {p: len(bpe.encode_piece(p)) // 4 for p in found}


class _Lengths(dict):
    """The second tier: lengths of pre-tokens met by this worker."""

    def __init__(self, bpe, limit: int = 400_000) -> None:
        self.bpe, self.limit = bpe, limit

    def __missing__(self, piece: str) -> int:
        n = len(self.bpe.encode_piece(piece)) // 4
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = n
        return n


class _Tiers(dict):
    """The broadcast table in front of a worker's cache."""

    def __init__(self, table: dict[str, int], cache: _Lengths) -> None:
        super().__init__(table)
        self.cache = cache

    def __missing__(self, piece: str) -> int:
        return self.cache[piece]


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 1024, table: dict[str, int] | None = None) -> DataFrame:
    """Per row of `docs`: key, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null text counts as empty (0 bytes, 0 tokens), a null key stays null and
    repeated rows give repeated results; an empty table gives none.
    `table` replaces the frequent lengths found by a pass over `docs`.
    """
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text) if table is None else table)
    source = docs.select(*(c.alias(n) for c, n in zip(worker.columns([key, text]), ("key", "text"))))

    def run(batches):
        bpe = tokenizer(path)
        tiers = _Tiers(frequent.value, worker.kept(("lengths", path), lambda: _Lengths(bpe)))
        for batch in batches:
            sizes, counts = [], []
            for t in worker.texts(batch.column("text")):
                n = 0
                for plain, special in bpe.segments(t):
                    n += sum(map(tiers.__getitem__, bpe.split(plain))) + (special is not None)
                sizes.append(len(t.encode()))
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
