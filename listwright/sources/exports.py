"""Reading exported listings back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listwright.schemas import LISTING

ENVELOPE_METADATA = "export_timestamp string, total_listings bigint, source string, category string"


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = LISTING) -> DataFrame:
    """Export in JSON lines form (the form that scales)."""
    return spark.read.schema(schema).json(path)


def read_json_envelope(spark: SparkSession, path: str, schema: T.StructType = LISTING) -> DataFrame:
    """Export as one document ``{metadata, listings: [...]}``."""
    envelope = T.StructType(
        [
            T.StructField("metadata", T.StructType.fromDDL(ENVELOPE_METADATA)),
            T.StructField("listings", T.ArrayType(schema)),
        ]
    )
    return spark.read.schema(envelope).json(path, multiLine=True).select(F.inline("listings"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV export; columns by position, text types as written."""
    return spark.read.csv(path, schema=schema, header=True, escape='"', multiLine=True, nullValue="\\N", enforceSchema=True)
