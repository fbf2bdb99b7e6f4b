"""The sales-domain entities, derived from the TPC-H-like test tables.

Each analog is one SQL text that both Spark SQL and DuckDB accept (the only dialect
difference, the timestamp literal, is a placeholder).  The same text defines the input
for a Spark query and for its DuckDB oracle, so both sides start from identical rows;
the operators under test (expectations, CDC, joins, aggregates) are written separately
on each side.

Dirt (padded text, NULL keys, out-of-range coordinates, bad totals) is injected by
deterministic expressions of the row keys, as FIXTURES.md asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def ts(literal: str, dialect: str) -> str:
    return f"TIMESTAMP_NTZ '{literal}'" if dialect == "spark" else f"TIMESTAMP '{literal}'"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one input table; its scan has as many tasks as the files have splits."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    """Expose the parquet inputs as temp views named like the oracle's views."""
    for name in names or TABLES[:8]:
        load_table(spark, sf_dir, name).createOrReplaceTempView(name)


# --------------------------------------------------------------------------------------
# customers: change feed of the database table (key customerid, cursor updated_at)
# --------------------------------------------------------------------------------------
_CUSTOMER_COLUMNS = """
  c.c_custkey AS customerid,
  CASE WHEN c.c_custkey % 37 = 0 THEN NULL
       WHEN c.c_custkey % 10 = 0 THEN concat('  ', c.c_name, ' ') ELSE c.c_name END AS first_name,
  CASE WHEN c.c_custkey % 41 = 0 THEN NULL
       ELSE concat('Lastname', CAST(c.c_custkey % 97 AS STRING)) END AS last_name,
  CASE WHEN c.c_custkey % 29 = 0 THEN NULL
       WHEN c.c_custkey % 13 = 0 THEN lower(replace(c.c_name, '#', '.'))
       ELSE concat(lower(replace(c.c_name, '#', '.')), '@example.com') END AS email_address,
  concat('+', CAST(c.c_nationkey + 10 AS STRING), ' ', CAST(c.c_custkey AS STRING)) AS phone_number,
  concat(CAST(c.c_custkey % 500 AS STRING), ' Main Street ') AS address,
  {city} AS city,
  c.c_mktsegment AS state,
  r.r_name AS country,
  concat(' ', r.r_name) AS continent,
  c.c_custkey * 7 % 100000 AS postal_zip_code,
  CASE c.c_mktsegment WHEN 'HOUSEHOLD' THEN ' Male' WHEN 'BUILDING' THEN 'FEMALE '
       WHEN 'AUTOMOBILE' THEN 'male' WHEN 'FURNITURE' THEN 'female' ELSE 'unknown' END AS gender,
  {updated_at} AS updated_at,
  '{op}' AS op
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def customer_changes_sql(dialect: str) -> str:
    """Three kinds of events: first load (every customer), a move (every third), a delete."""
    first = _CUSTOMER_COLUMNS.format(
        city="CASE WHEN c.c_custkey % 3 = 0 THEN concat('OLD_', n.n_name) ELSE n.n_name END",
        updated_at=ts("2024-01-01 00:00:00", dialect), op="UPSERT")
    moved = _CUSTOMER_COLUMNS.format(city="n.n_name", updated_at=ts("2024-02-01 00:00:00", dialect), op="UPSERT")
    deleted = _CUSTOMER_COLUMNS.format(city="n.n_name", updated_at=ts("2024-03-01 00:00:00", dialect), op="DELETE")
    return (f"SELECT {first}\nUNION ALL\nSELECT {moved} WHERE c.c_custkey % 3 = 0"
            f"\nUNION ALL\nSELECT {deleted} WHERE c.c_custkey % 53 = 0")


# --------------------------------------------------------------------------------------
# franchises: nation x region, coordinates from the nation key (two rows made invalid)
# --------------------------------------------------------------------------------------
FRANCHISE_COLUMNS = ["franchiseID", "name", "city", "district", "zipcode", "country", "size", "longitude", "latitude"]

FRANCHISES_SQL = """SELECT
  CAST(n.n_nationkey AS BIGINT) AS franchiseID,
  concat('Franchise ', n.n_name) AS name,
  n.n_name AS city,
  concat('District ', CAST(n.n_regionkey AS STRING)) AS district,
  lpad(CAST(n.n_nationkey * 379 % 100000 AS STRING), 5, '0') AS zipcode,
  r.r_name AS country,
  CASE n.n_nationkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'M' ELSE 'L' END AS size,
  CAST(CASE WHEN n.n_nationkey = 21 THEN 200 ELSE n.n_nationkey * 97 % 361 - 180 END AS DOUBLE) AS longitude,
  CAST(CASE WHEN n.n_nationkey = 13 THEN 91.5 ELSE n.n_nationkey * 31 % 181 - 90 END AS DOUBLE) AS latitude
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""


# --------------------------------------------------------------------------------------
# suppliers: two file deliveries (second one re-approves / un-approves a quarter)
# --------------------------------------------------------------------------------------
SUPPLIER_COLUMNS = ["supplierID", "name", "ingredient", "continent", "city", "district", "size",
                    "longitude", "latitude", "approved"]

_SUPPLIER_SELECT = """SELECT
  CASE WHEN s.s_suppkey % 17 = 16 THEN NULL ELSE s.s_suppkey END AS supplierID,
  CASE WHEN s.s_suppkey % 4 = 0 THEN concat(' ', s.s_name, '  ') ELSE s.s_name END AS name,
  CASE s.s_suppkey % 5 WHEN 0 THEN 'flour' WHEN 1 THEN 'sugar' WHEN 2 THEN 'butter '
       WHEN 3 THEN ' yeast' ELSE 'salt' END AS ingredient,
  r.r_name AS continent,
  n.n_name AS city,
  concat('District ', CAST(s.s_nationkey % 7 AS STRING)) AS district,
  CASE s.s_suppkey % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'medium' ELSE 'large ' END AS size,
  CAST(s.s_suppkey * 73 % 361 - 180 AS DOUBLE) AS longitude,
  CAST(s.s_suppkey * 37 % 181 - 90 AS DOUBLE) AS latitude,
  {approved} AS approved,
  '{file}' AS file_name,
  {file_ts} AS file_timestamp
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey"""


def supplier_deliveries_sql(dialect: str) -> str:
    first = _SUPPLIER_SELECT.format(approved="CASE WHEN s.s_acctbal >= 0 THEN 'Y' ELSE 'N' END",
                                    file="suppliers_1.csv", file_ts=ts("2024-01-01 00:00:00", dialect))
    second = _SUPPLIER_SELECT.format(approved="CASE WHEN s.s_acctbal >= 0 THEN 'N' ELSE 'Y' END",
                                     file="suppliers_2.csv", file_ts=ts("2024-02-01 00:00:00", dialect))
    return f"{first}\nUNION ALL\n{second} WHERE s.s_suppkey % 4 = 1"


# --------------------------------------------------------------------------------------
# transactions: one row per sales line (lineitem x orders x supplier x part)
# --------------------------------------------------------------------------------------
TRANSACTION_LINES_SQL = """SELECT
  l.l_orderkey AS transactionid,
  CASE WHEN l.l_orderkey % 50 = 7 THEN NULL ELSE o.o_custkey END AS customerid,
  CAST(s.s_nationkey AS BIGINT) AS franchiseid,
  o.o_orderdate AS datetime,
  CASE WHEN l.l_linenumber = 1 THEN concat(' ', p.p_brand, ' ') ELSE p.p_brand END AS product,
  CAST(l.l_quantity AS BIGINT) AS quantity,
  CAST(p.p_retailprice AS DECIMAL(18,2)) AS unitprice,
  CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * CAST(l.l_quantity AS BIGINT)
       + CASE WHEN l.l_orderkey % 10 = 0 THEN CAST(0.01 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
       AS DECIMAL(18,2)) AS totalprice,
  CASE l.l_linenumber % 3 WHEN 0 THEN 'cash' WHEN 1 THEN ' card' ELSE 'wallet ' END AS paymentmethod,
  l.l_orderkey * 10 + l.l_linenumber AS cardnumber,
  l.l_shipdate AS updated_at
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN part p ON l.l_partkey = p.p_partkey"""

# one row per key, for keyed (SCD1) ingest
ORDER_TRANSACTIONS_SQL = """SELECT
  o.o_orderkey AS transactionid,
  o.o_custkey AS customerid,
  o.o_orderdate AS datetime,
  CAST(o.o_totalprice AS DECIMAL(18,2)) AS totalprice,
  o.o_orderstatus AS status,
  o.o_orderdate AS updated_at
FROM orders o"""


def spark_sql(spark: SparkSession, sf_dir: str, text: str, tables=None) -> DataFrame:
    register_tables(spark, sf_dir, tables)
    return spark.sql(text)


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, customer_changes_sql("spark"), ("customer", "nation", "region"))


def franchises(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, FRANCHISES_SQL, ("nation", "region"))


def supplier_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, supplier_deliveries_sql("spark"), ("supplier", "nation", "region"))


def transaction_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, TRANSACTION_LINES_SQL, ("lineitem", "orders", "supplier", "part"))


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, ORDER_TRANSACTIONS_SQL, ("orders",))


# --------------------------------------------------------------------------------------
# events as a change stream (key user_id, sequence ts, delete when event_type = 'error')
# --------------------------------------------------------------------------------------
EVENTS_NULLED_SQL = """SELECT event_id, user_id, ts,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS value
FROM events"""

# week of the month: four in-order delivery batches covering every event
EVENT_BATCH_SQL = "CAST(floor((day(ts) - 1) / 8) AS INT)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "events")


def events_nulled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, EVENTS_NULLED_SQL, ("events",))
