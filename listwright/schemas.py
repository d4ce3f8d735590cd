"""Table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

_TYPES = {
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "strings": T.ArrayType(T.StringType()),
    "texts": T.MapType(T.StringType(), T.StringType()),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(15, 2),
    "size": T.DecimalType(10, 2),
}


def _schema(columns: str) -> StructType:
    """Schema of 'name type, ...' without a session (types of the table above)."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

# curated listings: the common record of every profile
LISTING = _schema(
    "seq bigint, source string, listing_id string, listing_url string, "
    "title string, description string, category string, transaction_type string, "
    "price_raw string, price_numeric double, currency string, "
    "location_raw string, city string, governorate string, neighborhood string, "
    "surface double, rooms double, bedrooms double, bathrooms double, floor double, furnished boolean, "
    "criteria texts, image_urls strings, image_count int, "
    "date_posted string, scraped_at timestamp"
)

# stored listings: typed and keyed by listing_id
STORED = _schema(
    "listing_id string, title string, description string, category string, "
    "price_numeric money, currency string, price_raw string, "
    "location_raw string, city string, governorate string, neighborhood string, "
    "surface size, rooms int, bedrooms int, bathrooms int, floor int, furnished boolean, "
    "criteria texts, image_urls strings, image_count int, "
    "date_posted date, listing_url string, scraped_at timestamp, "
    "created_at timestamp, updated_at timestamp"
)

# quality issues: one row per issue
ISSUE = _schema("listing_id string, issue string, field string, price double")


def conform(df: DataFrame, schema: StructType = LISTING) -> DataFrame:
    """Select exactly the schema's columns, cast; absent ones become NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
