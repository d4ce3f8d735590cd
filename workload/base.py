"""Listing-shaped tables derived from the given tables.

The SQL texts run unchanged on Spark and on DuckDB, so that a query and its
oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# listings with every defect the curation rules look for
LISTINGS_SQL = """
SELECT o_orderkey AS seq,
 CAST(o_orderkey - CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS STRING) AS listing_id,
 CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' ELSE concat(c_mktsegment, ' ', c_name) END AS title,
 CASE WHEN o_orderkey % 29 = 0 THEN 'N/A'
      ELSE concat(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), ' DT') END AS price_raw,
 CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN CAST(0 AS DOUBLE)
      ELSE o_totalprice END AS price_numeric,
 CASE substring(o_orderpriority,1,1) WHEN '1' THEN 'appartement' WHEN '2' THEN 'Villa'
      WHEN '3' THEN ' terrain ' WHEN '4' THEN 'bureau' ELSE 'Ferme' END AS category_raw,
 concat(r_name, ', ', n_name) AS location_raw,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE n_name END AS city,
 CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE r_name END AS governorate,
 CASE WHEN o_orderkey % 11 = 0 THEN 'N/A' ELSE concat('Order ', o_orderstatus, ' of ', c_name) END AS description,
 CASE o_orderkey % 6 WHEN 0 THEN d
   WHEN 1 THEN concat(substring(d,9,2),'/',substring(d,6,2),'/',substring(d,1,4))
   WHEN 2 THEN concat(substring(d,9,2),'-',substring(d,6,2),'-',substring(d,1,4))
   WHEN 3 THEN concat(d,'T23:30:00-05:00') WHEN 4 THEN 'N/A' ELSE 'il y a 3 jours' END AS date_posted,
 CAST(o_orderkey % 8 AS INT) AS image_count,
 CASE WHEN o_orderkey % 113 = 0 THEN NULL
      ELSE concat('https://listings.example/item/x/', CAST(o_orderkey AS STRING), '/') END AS listing_url,
 o_orderdate AS scraped_at, CAST(o_orderkey % 300 AS DOUBLE) AS surface, CAST(o_orderkey % 7 AS INT) AS rooms
FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) o
JOIN {customer} c ON o_custkey = c_custkey JOIN {nation} n ON c_nationkey = n_nationkey
JOIN {region} r ON n_regionkey = r_regionkey
"""

# the facts that generated pages are written from
_FACTS = """
SELECT o_orderkey AS k, n_name AS n, r_name AS r,
 concat('Résidence & jardin ', c_name, ' lot ', CAST(o_orderkey AS STRING)) AS t,
 concat('Résidence &amp; jardin ', c_name, ' lot ', CAST(o_orderkey AS STRING)) AS th,
 CAST(floor(o_totalprice) AS BIGINT) AS amount,
 concat(CAST(CAST(floor(floor(o_totalprice) / 1000) AS BIGINT) AS STRING), ' ',
        lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0')) AS spaced,
 CAST(CAST(o_orderdate AS DATE) AS STRING) AS d,
 o_orderdate AS fetched_at,
 CAST(o_orderkey % 400 + 20 AS BIGINT) AS m2,
 CAST(o_orderkey % 9 + 1 AS BIGINT) AS rooms_n,
 CAST(o_orderkey % 5 + 1 AS BIGINT) AS beds_n,
 o_orderkey % 2 AS x2, o_orderkey % 3 AS x3, o_orderkey % 4 AS x4, o_orderkey % 5 AS x5,
 o_orderkey % 7 AS x7, o_orderkey % 21 AS x21, o_orderkey % 35 AS x35, o_orderkey % 49 AS x49
FROM """
_FACTS_FROM = """{orders} o JOIN {customer} c ON o_custkey = c_custkey
JOIN {nation} n ON c_nationkey = n_nationkey JOIN {region} r ON n_regionkey = r_regionkey
"""
FACTS_SQL = _FACTS + _FACTS_FROM

_NAMES = ("orders", "customer", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def on_duckdb(sql: str) -> str:
    """The SQL text with the plain table names."""
    for name in _NAMES:
        sql = sql.replace("{" + name + "}", name)
    return sql


def on_spark(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{name: table(spark, sf_dir, name) for name in _NAMES})


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_spark(spark, sf_dir, LISTINGS_SQL)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts, dealt out to the shuffle partitions because heavy work per row follows.

    What is dealt are the joined rows: the partitions that a join leaves are merged to about one a core,
    by the bytes of its narrow rows.
    """
    joined = on_spark(spark, sf_dir, "SELECT o_orderkey, o_totalprice, o_orderdate, c_name, n_name, r_name FROM " + _FACTS_FROM)
    return spark.sql(_FACTS + "{joined}", joined=dealt(joined))
