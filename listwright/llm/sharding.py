"""Sharding by a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime
size, a walk of its own offset and step. The shards take turns; each claims
the first slot of its order that is still free, until all slots are taken. A
key's hash names a slot and the slot its shard. Shares differ by one slot at
most, and a shard that comes or goes leaves nearly all other slots alone.

The table is made once of the shards' names and its size is its bound; it is
broadcast and a key is placed by one hash lookup, without a shuffle and
whatever the skew of any other column.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listwright.llm import worker

SIZE = 8191  # a prime, over a hundred slots for each of 64 shards


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], size: int = SIZE) -> list[int]:
    """Slot -> number of its shard."""
    if not 0 < len(set(shards)) == len(shards) <= size:
        raise ValueError("shards need different names and a slot each")
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("the table's size must be prime")
    walks = [(_number(f"offset {s}") % size, _number(f"step {s}") % (size - 1) + 1) for s in shards]
    table, tried, free = [-1] * size, [0] * len(shards), size
    while True:
        for shard, (offset, step) in enumerate(walks):
            while table[slot := (offset + tried[shard] * step) % size] >= 0:
                tried[shard] += 1
            table[slot] = shard
            free -= 1
            if not free:
                return table


def slot_of(key: Column, size: int = SIZE) -> Column:
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long") % size


def table_frame(spark: SparkSession, shards: list[str], size: int = SIZE) -> DataFrame:
    """(place, shard) of all slots."""
    text = ",".join(map(str, lookup_table(shards, size)))
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("place", "s")).select("place", F.col("s").cast("int").alias("shard"))


def place(rows: DataFrame, key: str, shards: list[str], size: int = SIZE) -> DataFrame:
    """Adds slot and shard (number in `shards`) by the hash of column `key`.

    Rows with a null key are placed by the hash of all their other columns, so
    that many of them don't meet in one slot. Equal keys share a shard; other
    columns pass unchanged, and columns named slot or shard are replaced;
    an empty table gives none.
    """
    names = [c for c in rows.columns if c not in ("slot", "shard")]
    held = F.struct(*worker.columns(names)).alias("row")
    whole = F.to_json(F.struct(*worker.columns(names)))
    keyed = rows.select(held, slot_of(F.coalesce(worker.columns([key])[0].cast("string"), whole), size).alias("slot"))
    table = F.broadcast(table_frame(rows.sparkSession, shards, size))
    placed = keyed.join(table, F.col("slot") == F.col("place"))
    return placed.select(*[F.col("row").getField(c).alias(c) for c in names], "slot", "shard")


def write(rows: DataFrame, key: str, shards: list[str], path: str, size: int = SIZE) -> None:
    """Writes one folder a shard; large shards are written by several tasks."""
    place(rows, key, shards, size).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
