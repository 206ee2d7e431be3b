"""A posting-shaped table derived from the order tables.

The library is written for a wide table of vacancy postings whose text columns
are dirty.  No such table is at hand, so one is derived, row for row, from
``orders``, ``customer`` and ``nation``.  The SQL below uses only what Spark and
DuckDB read alike; the checks in ``__spark_entry__`` run the same text on both.

The remainder rules spread dirty spellings over *all* orders; they drop no row.
Amounts are in steps of a quarter: sums of such doubles are exact in any order,
so that means can be compared between engines bit for bit, without rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns that need the orders table only.
_ORDER_COLUMNS = """
  o_orderkey AS posting_no,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL
       WHEN o_orderkey % 10 = 9 THEN CAST(o_orderkey - 1 AS STRING)
       ELSE CAST(o_orderkey AS STRING) END AS id,
  CASE o_orderkey % 7
    WHEN 0 THEN NULL
    WHEN 1 THEN 'от ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || ' руб.'
    WHEN 2 THEN replace(CAST(CAST(floor(o_totalprice * 4) / 4 AS DECIMAL(18,2)) AS STRING), '.', ',')
    WHEN 3 THEN ''
    WHEN 4 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) || '-'
                || CAST(CAST(floor(o_totalprice) AS BIGINT) + 500 AS STRING)
    WHEN 5 THEN 'n/a'
    ELSE CAST(CAST(floor(o_totalprice * 4) / 4 AS DECIMAL(18,2)) AS STRING) END AS salary_from,
  CASE o_orderkey % 5
    WHEN 0 THEN NULL
    WHEN 1 THEN 'до ' || CAST(CAST(floor(o_totalprice) AS BIGINT) + 900 AS STRING)
    WHEN 2 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) + 700 AS STRING) || ',5'
    WHEN 3 THEN '-'
    ELSE ' ' || CAST(CAST(floor(o_totalprice) AS BIGINT) + 300 AS STRING) || ' ' END AS salary_to,
  CASE o_orderkey % 4 WHEN 0 THEN 'rur' WHEN 1 THEN ' usd ' WHEN 2 THEN '' ELSE NULL END
    AS salary_currency,
  CASE o_orderkey % 6
    WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN ' 1 ' WHEN 3 THEN 'да'
    WHEN 4 THEN 'Полный день' ELSE NULL END AS test_required,
  CASE o_orderkey % 8
    WHEN 0 THEN 'TRUE' WHEN 1 THEN 'нет' WHEN 2 THEN '2' WHEN 3 THEN 'y'
    WHEN 4 THEN '99999999999' WHEN 5 THEN '0' WHEN 6 THEN '' ELSE NULL END AS has_test,
  CASE o_orderkey % 5
    WHEN 0 THEN ' Yes ' WHEN 1 THEN 'no' WHEN 2 THEN 'Да' WHEN 3 THEN '1' ELSE NULL END
    AS salary_gross,
  CASE o_orderkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE NULL END AS premium,
  CASE o_orderkey % 11 WHEN 0 THEN 'true' WHEN 1 THEN '1' ELSE 'false' END AS archived,
  CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '3 навыка'
    ELSE CAST(o_orderkey % 9 AS STRING) END AS count_key_skills,
  o_orderpriority AS experience,
  o_orderstatus AS employment,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS published_at
"""

ORDER_POSTINGS_SQL = f"SELECT {_ORDER_COLUMNS} FROM {{orders}}"

POSTINGS_SQL = f"""
SELECT {_ORDER_COLUMNS},
  CASE WHEN o_orderkey % 41 = 0 THEN NULL
       WHEN o_orderkey % 44 = 2 THEN 'remote'  -- only amounts without a known rate
       ELSE n_name || ' ' || c_mktsegment END AS area_name,
  CASE WHEN o_orderkey % 13 = 0 THEN 'area ' || n_name
       WHEN o_orderkey % 13 = 1 THEN NULL
       ELSE ' ' || CAST(n_nationkey AS STRING) END AS area_id,
  c_name AS name,
  c_mktsegment AS schedule,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) END
    AS address_lat
FROM {{orders}}
JOIN {{customer}} ON o_custkey = c_custkey
JOIN {{nation}} ON c_nationkey = n_nationkey
"""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings columns that come from ``orders`` alone (no join)."""
    return spark.sql(ORDER_POSTINGS_SQL, orders=read_table(spark, sf_dir, "orders"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole postings table, one row per order.

    The join carries no hint: at small scale Spark broadcasts by file size, at
    large scale it sort-merges and adaptive execution splits a hot customer.
    """
    return spark.sql(
        POSTINGS_SQL,
        orders=read_table(spark, sf_dir, "orders"),
        customer=read_table(spark, sf_dir, "customer"),
        nation=read_table(spark, sf_dir, "nation"),
    )
