"""The lakehouse datasets in dependency order, on the analog inputs (batch form).

Dataset references become function calls; each returns a lazy DataFrame so Catalyst
sees (and optimizes) the whole chain from the parquet scans to the chart query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.operators.cdc import CdcSpec, apply_changes
from levain.plans import analogs, sales


CUSTOMER_CDC = CdcSpec(keys=("customerid",), sequence_by="updated_at", except_columns=("op",),
                       apply_as_deletes="op = 'DELETE'")
FRANCHISE_CDC = CdcSpec(keys=("franchiseID",), sequence_by="file_timestamp",
                        except_columns=("file_timestamp", "_rescued_data"))
SUPPLIER_CDC = CdcSpec(keys=("supplierID",), sequence_by="file_timestamp",
                       except_columns=("file_timestamp", "_rescued_data"))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database customers kept with history (SCD2 on customerid, sequence updated_at)."""
    return apply_changes(analogs.customer_changes(spark, sf_dir), CUSTOMER_CDC)


def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.silver_customers(bronze_customers(spark, sf_dir))


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.dim_customer(silver_customers(spark, sf_dir))


def franchise_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The franchise file as bronze rows: one delivery, with its file name and time."""
    return analogs.franchises(spark, sf_dir).select(
        "*", F.lit("franchises_1.csv").alias("file_name"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("file_timestamp"))


def silver_franchises(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = sales.FRANCHISE_RULES.apply(franchise_deliveries(spark, sf_dir))
    return apply_changes(checked, FRANCHISE_CDC)


def dim_franchise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.dim_franchise(silver_franchises(spark, sf_dir))


def silver_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = sales.clean_suppliers(analogs.supplier_deliveries(spark, sf_dir))
    return apply_changes(sales.SUPPLIER_RULES.apply(cleaned), SUPPLIER_CDC)


def dim_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.dim_supplier(silver_suppliers(spark, sf_dir))


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.silver_transactions(analogs.transaction_lines(spark, sf_dir))


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.fact_sales(silver_transactions(spark, sf_dir))


def denormalized_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.denormalized_sales(fact_sales(spark, sf_dir), dim_customer(spark, sf_dir),
                                    dim_franchise(spark, sf_dir))
