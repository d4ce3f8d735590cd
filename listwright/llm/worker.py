"""What Python workers keep between tasks, and text of Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """The value of `key` in this worker process, made at its first use.

    Code that travels by value has new globals in each task; the values are
    therefore held by a module of their own.
    """
    store = _store()
    if key not in store:
        store[key] = make()
    return store[key]


def _store() -> dict[tuple, Any]:
    return sys.modules.setdefault("_listwright_worker", types.ModuleType("_listwright_worker")).__dict__.setdefault("kept", {})


def only(*purposes: str) -> None:
    """Drops values kept for other purposes (the first part of a key) and gives their memory back.

    Spark hands a worker process on from one job to the next, with the caches of a job that is over.
    """
    store = _store()
    spent = [key for key in store if key[0] not in purposes]
    for key in spent:
        del store[key]
    if spent:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def texts(column: pa.Array | pa.ChunkedArray):
    """The texts of a column one at a time; null reads as the empty text."""
    for value in column:
        yield value.as_py() or ""


def columns(names: list[str]) -> list[Column]:
    """Columns by their exact names, whatever characters they hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


BROADCAST_ROWS = 1_000_000


def sized(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of short rows, to be broadcast if it has at most `rows`; beyond that Spark shuffles it."""
    return F.broadcast(table) if table.count() <= rows else table
