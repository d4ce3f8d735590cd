"""Frequent items of all texts by bounded summaries, without shuffling items."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.llm import worker
from listwright.session import cut_lineage


class Summary:
    """Misra-Gries counts: every item above 1/size of the stream is in it."""

    def __init__(self, size: int) -> None:
        self.size, self.seen, self.taken, self.counts = size, 0, 0, Counter()

    def add(self, items: list[str]) -> None:
        self.seen += len(items)
        self.counts.update(items)
        if len(self.counts) > 2 * self.size:
            least = sorted(self.counts.values(), reverse=True)[self.size]
            self.taken += least
            self.counts = Counter({k: n - least for k, n in self.counts.items() if n > least})

    def heavy(self, share: float) -> dict[str, int]:
        """Items that may have `share` of the stream, with the most they can have."""
        return {k: n + self.taken for k, n in self.counts.items() if n + self.taken >= share * self.seen}


def frequent(docs: DataFrame, text: str, items_of: Callable[[str], list[str]], min_share: float, limit: int, exact: bool = False) -> list[str]:
    """The at most `limit` most frequent items of a text column, each with `min_share` of all, the most frequent first.

    Each task sends the items with a quarter of `min_share` in its own texts.
    An item with `min_share` of all loses at most a quarter of its count that
    way, so it is among those whose sent counts reach three quarters, of which
    there are at most 4/3 of 1/`min_share`. With `exact` these are counted
    once more in all texts and the result doesn't depend on how the rows are
    split; without, the sent counts decide among them.
    """
    size = int(8 / min_share)
    column = worker.columns([text])[0].alias("text")

    def batches_of(count):
        def run(batches):
            seen, found = count(t for batch in batches for t in worker.texts(batch.column(0)))
            # the row without an item counts all of them
            yield pa.RecordBatch.from_arrays([pa.array([None, *found], pa.string()), pa.array([seen, *found.values()], pa.int64())], names=["item", "n"])
        return docs.select(column).mapInArrow(run, "item string, n long").groupBy("item").agg(F.sum("n").alias("n"))

    def summarise(texts):
        summary = Summary(size)
        for t in texts:
            summary.add(items_of(t))
        return summary.seen, summary.heavy(min_share / 4)

    def share(counts: DataFrame, least: float) -> list[str]:
        total = counts.where("item IS NULL").agg(F.sum("n")).first()[0] or 0
        rows = counts.where(F.col("item").isNotNull() & (F.col("n") >= F.lit(least * total))).orderBy(F.desc("n"), "item").limit(int(2 / min_share)).collect()
        return [r["item"] for r in rows]

    candidates = share(cut_lineage(batches_of(summarise)), 0.75 * min_share)
    if not exact or not candidates:
        return candidates[:limit]
    named = docs.sparkSession.sparkContext.broadcast(frozenset(candidates))

    def recount(texts):
        wanted, seen, found = named.value, 0, Counter()
        for t in texts:
            items = items_of(t)
            seen += len(items)
            found.update(filter(wanted.__contains__, items))
        return seen, found

    return share(cut_lineage(batches_of(recount)), min_share)[:limit]
