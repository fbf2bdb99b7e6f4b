"""Silver and gold sales datasets: cleaned transactions, the daily fact, the
customer / franchise / supplier dimensions, the denormalized star and the chart queries.

Every function takes and returns DataFrames; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.functions.text import clean_lower
from levain.operators.cdc import END_AT
from levain.operators.expectations import Expectation, Expectations
from levain.streaming.aggregate_view import AggregateView
from levain.streaming.cdc_target import SIGN, CdcTarget

# ---------------------------------------------------------------------------
# transactions
# ---------------------------------------------------------------------------
TRANSACTION_RULES = Expectations(
    [Expectation("valid_total_price", "total_price = unit_price * quantity", "drop")],
    dataset="sales_transactions_silver")


def silver_transactions_projection(bronze: DataFrame, *more: str) -> DataFrame:
    """Rename and trim, with the columns ``more`` as they are; the rule below is written against these output names."""
    return bronze.select(
        F.col("transactionid"),
        F.col("customerid"),
        F.col("franchiseid"),
        F.col("datetime").alias("transaction_datetime"),
        F.trim("product").alias("product_name"),
        F.col("quantity"),
        F.col("unitprice").alias("unit_price"),
        F.col("totalprice").alias("total_price"),
        F.trim("paymentmethod").alias("payment_method"),
        F.col("cardnumber").alias("card_number"),
        F.col("updated_at"),
        *more,
    )


def silver_transactions(bronze: DataFrame, rules: Expectations = TRANSACTION_RULES) -> DataFrame:
    return rules.apply(silver_transactions_projection(bronze))


def fact_sales(silver: DataFrame) -> DataFrame:
    """Daily grain per (customer, franchise, product): one partial + one final hash aggregate.

    ``sale_year`` / ``sale_month`` are attributes of the grouped ``sale_date``, derived
    after the aggregate so they are not grouping keys.
    """
    sales = silver.filter(F.col("transactionid").isNotNull() & F.col("customerid").isNotNull()
                          & F.col("franchiseid").isNotNull())
    daily = sales.groupBy(
        F.col("customerid").alias("customer_ID"),
        F.col("franchiseid").alias("franchise_ID"),
        F.col("product_name"),
        F.to_date("transaction_datetime").alias("sale_date"),
    ).agg(
        F.count("transactionid").alias("transaction_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("total_price").cast("decimal(38,2)").alias("total_revenue"),
        F.avg("unit_price").cast("decimal(18,6)").alias("avg_unit_price"),
        F.min("transaction_datetime").alias("first_purchase"),
        F.max("transaction_datetime").alias("last_purchase"),
    )
    return daily.select(
        "customer_ID", "franchise_ID", "product_name", "sale_date",
        F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month"),
        "transaction_count", "total_quantity", "total_revenue", "avg_unit_price", "first_purchase", "last_purchase")


#: The grain of the daily fact.
FACT_GRAIN = ["customer_ID", "franchise_ID", "product_name", "sale_date"]


def fact_sales_view(spark: SparkSession, path: str, bronze: CdcTarget) -> AggregateView:
    """The daily fact over a target of transaction lines, kept up to date from the target's changes."""

    def rows(signed: DataFrame) -> DataFrame:
        silver = TRANSACTION_RULES.apply(silver_transactions_projection(signed, SIGN))
        silver = silver.filter("transactionid IS NOT NULL AND customerid IS NOT NULL AND franchiseid IS NOT NULL")
        return silver.select(F.col("customerid").alias("customer_ID"), F.col("franchiseid").alias("franchise_ID"), "product_name", F.to_date("transaction_datetime").alias("sale_date"),
                             "transactionid", "quantity", "total_price", "unit_price", "transaction_datetime", SIGN)

    return AggregateView(spark, path, bronze, FACT_GRAIN, rows, counts={"transaction_count": "transactionid", "__prices": "unit_price"},
                         sums={"total_quantity": "quantity", "total_revenue": "total_price", "__price": "unit_price"},
                         mins={"first_purchase": "transaction_datetime"}, maxs={"last_purchase": "transaction_datetime"},
                         columns=["transactionid", "customerid", "franchiseid", "datetime", "product", "quantity", "unitprice", "totalprice"])


def fact_sales_of(view: AggregateView) -> DataFrame:
    """The fact's rows, in the columns of :func:`fact_sales`."""
    price = (F.col("__price") / F.col("__prices")).cast("decimal(22,6)").cast("decimal(18,6)")
    return view.read().select(
        *FACT_GRAIN, F.year("sale_date").alias("sale_year"), F.month("sale_date").alias("sale_month"), "transaction_count", "total_quantity",
        F.col("total_revenue").cast("decimal(38,2)").alias("total_revenue"), price.alias("avg_unit_price"), "first_purchase", "last_purchase")


# ---------------------------------------------------------------------------
# customers
# ---------------------------------------------------------------------------
CUSTOMER_RULES = Expectations(
    [Expectation("valid_email", "email_address LIKE '%@%'", "warn"),
     Expectation("valid_gender", "gender IN ('male', 'female')", "warn")],
    dataset="sales_customers_silver")

_CUSTOMER_TEXT = ["first_name", "last_name", "email_address", "phone_number", "address", "city", "state",
                  "country", "continent"]


def silver_customers(bronze_scd2: DataFrame, rules: Expectations = CUSTOMER_RULES) -> DataFrame:
    """Current, trimmed customers with complete names; rules only warn."""
    out = bronze_scd2.filter(F.col("customerid").isNotNull() & F.col("first_name").isNotNull()
                             & F.col("last_name").isNotNull() & F.col(END_AT).isNull())
    out = out.select(F.col("customerid"), *[F.trim(c).alias(c) for c in _CUSTOMER_TEXT],
                     F.col("postal_zip_code"), clean_lower("gender").alias("gender"), F.col("updated_at"))
    return rules.apply(out)


def dim_customer(silver: DataFrame) -> DataFrame:
    return silver.filter(F.col("customerid").isNotNull()).select(
        F.col("customerid").alias("customer_ID"), "first_name", "last_name", "email_address", "phone_number",
        "address", "city", "state", "country", "continent", "postal_zip_code", "gender", "updated_at")


# ---------------------------------------------------------------------------
# franchises and suppliers
# ---------------------------------------------------------------------------
FRANCHISE_RULES = Expectations(
    [Expectation("valid_lat", "ABS(latitude) <= 90", "drop"),
     Expectation("valid_lon", "ABS(longitude) <= 180", "warn"),
     Expectation("id_not_null", "franchiseID IS NOT NULL", "fail")],
    dataset="franchises_silver")

SUPPLIER_RULES = Expectations.from_dicts("suppliers_silver", expect_all_or_drop={"id_not_null": "supplierID IS NOT NULL"})

SUPPLIER_TEXT = ["name", "ingredient", "continent", "city", "district", "size", "approved", "file_name"]


def dim_franchise(silver_scd2: DataFrame) -> DataFrame:
    return silver_scd2.filter(F.col("franchiseid").isNotNull() & F.col(END_AT).isNull()).select(
        F.col("franchiseid").alias("franchise_id"), "name", "city", "district", "zipcode", "country", "size",
        "longitude", "latitude")


def clean_suppliers(raw: DataFrame) -> DataFrame:
    """Trim every text field in one projection."""
    return raw.withColumns({c: F.trim(F.col(c)) for c in SUPPLIER_TEXT if c in raw.columns})


#: The dimension's columns, in output order.
DIM_SUPPLIER_COLUMNS = {"supplier_ID": "supplierID", **{c: c for c in (
    "name", "ingredient", "continent", "city", "district", "size", "longitude", "latitude", "approved")}}


def dim_supplier(silver_scd2: DataFrame) -> DataFrame:
    """Current versions of approved suppliers that have an id."""
    usable = F.col(END_AT).isNull() & F.col("supplierID").isNotNull() & (F.col("approved") == "Y")
    return silver_scd2.where(usable).select([F.col(c).alias(n) for n, c in DIM_SUPPLIER_COLUMNS.items()])


# ---------------------------------------------------------------------------
# star join and charts
# ---------------------------------------------------------------------------
def denormalized_sales(fact: DataFrame, customers: DataFrame, franchises: DataFrame) -> DataFrame:
    """Fact joined to the current customer and franchise rows (inner: orphans are dropped).

    Join strategy is left to Catalyst + AQE: a dimension that turns out small at run time
    is broadcast, a large one is joined by a sort-merge join whose skewed partitions AQE
    splits.  Only the dimension columns used are read (column pruning).
    """
    c = customers.select(F.col("customer_ID").alias("__c_id"),
                         F.col("first_name").alias("customer_first_name"),
                         F.col("last_name").alias("customer_last_name"),
                         F.col("city").alias("customer_city"),
                         F.col("country").alias("customer_country"))
    f = franchises.select(F.col("franchise_id").alias("__f_id"),
                          F.col("name").alias("franchise_name"),
                          F.col("city").alias("franchise_city"),
                          F.col("country").alias("franchise_country"))
    j = fact.join(c, fact["customer_ID"] == c["__c_id"], "inner").join(f, fact["franchise_ID"] == f["__f_id"], "inner")
    return j.select("customer_ID", "franchise_ID", "product_name", "transaction_count", "total_quantity",
                    "total_revenue", "avg_unit_price", "sale_date", "first_purchase", "last_purchase",
                    "customer_first_name", "customer_last_name", "customer_city", "customer_country",
                    "franchise_name", "franchise_city", "franchise_country")


def revenue_by(den: DataFrame, *dims: str) -> DataFrame:
    return den.groupBy(*dims).agg(F.sum("total_revenue").cast("decimal(38,2)").alias("total_revenue"))


def revenue_by_product(den: DataFrame) -> DataFrame:
    return revenue_by(den, "product_name")


def revenue_by_date(den: DataFrame) -> DataFrame:
    return revenue_by(den, "sale_date")


def revenue_by_franchise(den: DataFrame) -> DataFrame:
    """Bars sorted by revenue, largest first."""
    return revenue_by(den, "franchise_country", "franchise_name").orderBy(F.desc("total_revenue"))
