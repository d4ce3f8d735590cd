"""Session helpers: settings, scratch space and lineage cuts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on; pass to the builder or to spark-submit.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # checkpoints that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # pages are large rows: keep the Arrow batches of the HTML stage small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def build_session(app: str = "listwright", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession, rows: int = 2048) -> None:
    """Arrow batches of at most ``rows`` rows from now on; a lower setting stays.

    Whole texts go to Python in batches, several of which both processes of a
    task hold at once, and what they have allocated stays with them.
    """
    if not 0 < int(spark.conf.get(_BATCH_ROWS, "10000")) <= rows:
        spark.conf.set(_BATCH_ROWS, str(rows))


@lru_cache(maxsize=1)
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="listwright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session without a cluster, as in tests, may do without: it gets a
    folder of its own that goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


_scratch: list[str] = []


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder.

    Tables there are needed as long as results made from them are;
    :func:`clear_scratch` deletes them afterwards.
    """
    path = f"{shared_dir(spark)}/listwright/{purpose}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has made; gives their number.

    Call it when their results have been written.
    """
    paths = _scratch[:]
    for path in paths:
        drop_scratch(spark, path)
    return len(paths)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the table to reliable storage and go on from there."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


# Spark deletes the shuffle files of a write when it is done, not when the driver collects garbage
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_put_by: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def put_by(df: DataFrame) -> DataFrame:
    """The table, written to compressed scratch storage.

    For the rounds of a loop: unlike :func:`cut_lineage` it leaves nothing behind
    but the table itself, and that goes by :func:`drop_put_by` when the next round is written.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, "round"), spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _put_by[table] = path
    return table


def drop_put_by(*tables: DataFrame) -> None:
    """Delete tables of :func:`put_by` that nothing reads any more."""
    for table in tables:
        path = _put_by.pop(table, None)
        if path is not None:
            drop_scratch(table.sparkSession, path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _scratch.remove(path)
