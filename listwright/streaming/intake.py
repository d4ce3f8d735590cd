"""Incremental runs: page intake, dedupe and upsert as streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from listwright.operators.store import ListingStore


def read_stream(
    spark: SparkSession, directory: str, pattern: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a directory as a stream; schema from the present files.

    ``pattern`` is for the names of files.  A table that may be one file or a
    folder of files is named by a glob as ``directory``: Spark streams a plain
    path only if it is a folder.
    """
    present = spark.read.option("pathGlobFilter", pattern).parquet(directory)
    reader = spark.readStream.schema(present.schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(directory)


def stream_extract(
    pages: DataFrame, extract: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Extract new pages into a Parquet table; progress is kept in ``checkpoint``."""
    return (
        extract(pages).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )


_STAMPS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def dedupe_stream(listings: DataFrame, event_time: str, delay: str, key: str = "listing_id", order: str = "seq") -> DataFrame:
    """The first row by ``order`` of each listing id, whole, among those that arrive within a delay.

    A row of a new id opens a window that lasts for the delay from the row's
    event time.  The row with the least ``order`` in it is given out when the
    watermark has passed the window or a row beyond it arrives; then the id is
    forgotten, so the state is bounded by the ids of one delay.  An id seen
    again later counts as new.  Rows without an id are left out, those without
    an event time belong to the open window.  Which row stays does not depend on the
    order of arrival within the window.
    """
    plain = listings.select(
        F.col(key).cast("string").alias("id"), F.col(order).cast("long").alias("place"), F.col(event_time).cast("timestamp").alias("at"),
        F.to_json(F.struct(*listings.columns), {**_STAMPS, "ignoreNullFields": "false"}).alias("row"))
    timed = plain.where("id IS NOT NULL").withWatermark("at", delay)
    wait = int(listings.sparkSession.range(1).select(F.expr(f"unix_millis(TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {delay})")).first()[0])

    def keep(own: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            best = state.get
            state.remove()
            yield pd.DataFrame({"row": [best[1]]})
            return
        best, closes, closed = None, 0, []
        if state.exists:
            place, row, closes = state.get
            best = (place, row)
        for frame in frames:
            for place, at, row in zip(frame["place"].tolist(), frame["at"], frame["row"]):
                when = None if pd.isna(at) else int(at.timestamp() * 1000)
                if best is not None and when is not None and when > closes:
                    closed.append(best[1])
                    best = None
                if best is None:
                    best, closes = (place, row), (state.getCurrentWatermarkMs() if when is None else when) + wait
                elif (place, row) < best:
                    best = (place, row)
        state.update((*best, closes))
        state.setTimeoutTimestamp(max(closes, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"row": closed})

    kept = timed.groupBy("id").applyInPandasWithState(keep, "row string", "place long, row string, closes long", "append", GroupStateTimeout.EventTimeTimeout)
    return kept.select(F.from_json("row", listings.schema, _STAMPS).alias("r")).select("r.*")


def run_to_table(df: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run a stream over everything available and return the written table."""
    query = (
        df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(out)


def stream_merge(
    listings: DataFrame, store: ListingStore, as_of: Column, checkpoint: str, flavour: str = "narrow"
) -> StreamingQuery:
    """Upsert every micro-batch into the store.

    The number of the batch is committed with its rows under the stream's id,
    which the checkpoint keeps, so a batch that is played again after a failure,
    or after a restart from the checkpoint, changes nothing.  A new checkpoint
    is a new stream, whose batches count from the start.
    """
    def apply(batch: DataFrame, epoch: int) -> None:
        stream = json.loads(store.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        store.upsert(batch, as_of, flavour, run=(f"stream {stream}", {"epoch": epoch + 1}))

    return (
        listings.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


class StepCounts(StreamingQueryListener):
    """Adds up what ``observe`` counts in the batches of streaming queries: name -> rows."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, metrics in event.progress.observedMetrics.items():
            self.rows[name] = self.rows.get(name, 0) + (metrics["rows"] or 0)

    def onQueryTerminated(self, event) -> None:
        pass
