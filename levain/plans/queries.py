"""Registry of named queries: key -> (spark builder, oracle SQL or None).

Every builder takes (spark, sf_dir) and returns a DataFrame computed from the given
tables (or data Spark derives from them).  Builders with side effects (file ingest,
streaming targets) write under the shared folder in a fresh directory per call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.functions import clean_lower, date_parts, json_path
from levain.operators import cdc
from levain.operators.expectations import Expectations, quarantine
from levain.operators.geo_join import nearest, pairs_within
from levain.operators.semantic import SemanticModel
from levain.plans import analogs, flows
from levain.plans import chain
from levain.plans import eventlog as elog
from levain.plans import oracle as orc
from levain.plans import sales

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | Callable[[], str] | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle() if callable(oracle) else oracle
        return fn
    return deco


# ---------------------------------------------------------------- sales slice
@register("silver_transactions", orc.silver_transactions)
def q_silver_transactions(spark, sf):
    return chain.silver_transactions(spark, sf)


@register("fact_sales", orc.fact_sales)
def q_fact_sales(spark, sf):
    return chain.fact_sales(spark, sf)


@register("silver_customers", orc.silver_customers)
def q_silver_customers(spark, sf):
    return chain.silver_customers(spark, sf)


@register("dim_customer", orc.dim_customer)
def q_dim_customer(spark, sf):
    return chain.dim_customer(spark, sf)


@register("dim_franchise", orc.dim_franchise)
def q_dim_franchise(spark, sf):
    return chain.dim_franchise(spark, sf)


@register("clean_suppliers", orc.clean_suppliers)
def q_clean_suppliers(spark, sf):
    from levain.plans import analogs
    return sales.clean_suppliers(analogs.supplier_deliveries(spark, sf))


@register("dim_supplier", orc.dim_supplier)
def q_dim_supplier(spark, sf):
    return chain.dim_supplier(spark, sf)


@register("denormalized_sales", orc.denormalized_sales)
def q_denormalized_sales(spark, sf):
    return chain.denormalized_sales(spark, sf)


@register("revenue_by_product", lambda: orc.revenue_by("product_name"))
def q_revenue_by_product(spark, sf):
    return sales.revenue_by_product(chain.denormalized_sales(spark, sf))


@register("revenue_by_date", lambda: orc.revenue_by("sale_date"))
def q_revenue_by_date(spark, sf):
    return sales.revenue_by_date(chain.denormalized_sales(spark, sf))


@register("revenue_by_franchise", lambda: orc.revenue_by("franchise_country", "franchise_name"))
def q_revenue_by_franchise(spark, sf):
    return sales.revenue_by_franchise(chain.denormalized_sales(spark, sf))


# ---------------------------------------------------------------- CDC on the events change stream


EVENT_COLUMNS = ("event_type", "value")
EVENT_DELETE = "event_type = 'error'"


@register("scd2", lambda: orc.scd2_events())
def q_scd2(spark, sf):
    """SCD2 over every event: key user_id, sequence ts, all columns tracked."""
    return cdc.scd2(analogs.events(spark, sf), "user_id", "ts", columns=EVENT_COLUMNS)


@register("scd2_delete", lambda: orc.scd2_events(delete=EVENT_DELETE))
def q_scd2_delete(spark, sf):
    return cdc.scd2(analogs.events(spark, sf), "user_id", "ts", columns=EVENT_COLUMNS, apply_as_deletes=EVENT_DELETE)


@register("scd2_current", lambda: f"SELECT * FROM ({orc.scd2_events(delete=EVENT_DELETE)}) v WHERE __END_AT IS NULL")
def q_scd2_current(spark, sf):
    return cdc.current(q_scd2_delete(spark, sf))


@register("scd2_track_history", lambda: orc.scd2_events(tracked=("event_type",), untracked=("value",)))
def q_scd2_track_history(spark, sf):
    """Only event_type opens versions; value is updated in place (newest within the version)."""
    return cdc.scd2(analogs.events(spark, sf), "user_id", "ts", columns=EVENT_COLUMNS, track_history=("event_type",))


@register("scd2_struct_sequence", orc.scd2_struct_sequence)
def q_scd2_struct_sequence(spark, sf):
    """Hourly timestamps tie; STRUCT(hour, event_id) breaks the tie."""
    ev = analogs.events(spark, sf).withColumn("h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    seq = F.struct(F.col("h"), F.col("event_id").alias("id"))
    out = cdc.scd2(ev, "user_id", seq, columns=EVENT_COLUMNS)
    return out.select("user_id", "event_type", "value",
                      F.col("__START_AT.h").alias("start_h"), F.col("__START_AT.id").alias("start_id"),
                      F.col("__END_AT.h").alias("end_h"), F.col("__END_AT.id").alias("end_id"))


@register("scd1", lambda: orc.scd1_events())
def q_scd1(spark, sf):
    return cdc.scd1(analogs.events(spark, sf), "user_id", "ts", columns=("ts",) + EVENT_COLUMNS)


@register("scd1_delete", lambda: orc.scd1_events(delete=EVENT_DELETE))
def q_scd1_delete(spark, sf):
    return cdc.scd1(analogs.events(spark, sf), "user_id", "ts", columns=("ts",) + EVENT_COLUMNS,
                    apply_as_deletes=EVENT_DELETE)


EVENT_TRUNCATE = "value > 480"


@register("scd1_truncate", lambda: orc.scd1_events(truncate=EVENT_TRUNCATE))
def q_scd1_truncate(spark, sf):
    return cdc.scd1(analogs.events(spark, sf), "user_id", "ts", columns=("ts",) + EVENT_COLUMNS,
                    apply_as_truncates=EVENT_TRUNCATE)


@register("scd_ignore_null_updates", orc.scd_ignore_null_updates)
def q_scd_ignore_null_updates(spark, sf):
    return cdc.scd2(analogs.events_nulled(spark, sf), "user_id", "ts", columns=EVENT_COLUMNS,
                    ignore_null_updates=True)


# ---------------------------------------------------------------- expectations


@register("expect_warn", orc.expect_warn)
def q_expect_warn(spark, sf):
    """Warn rules keep every row; the result is the per-rule pass / fail count."""
    bronze = chain.bronze_customers(spark, sf)
    kept = sales.silver_customers(bronze)  # rows unchanged by warn rules
    return sales.CUSTOMER_RULES.metrics(kept)


@register("expect_drop", orc.expect_drop)
def q_expect_drop(spark, sf):
    rules = Expectations([r for r in sales.FRANCHISE_RULES.rules if r.on_violation != "fail"], "franchises_silver")
    return rules.apply(chain.franchise_deliveries(spark, sf))


@register("expect_fail", orc.expect_fail)
def q_expect_fail(spark, sf):
    """FAIL UPDATE: an update over the deliveries, and one in which every seventh id is NULL: did it fail, and
    how many rows it wrote."""
    from pyspark.errors import PySparkException

    from levain.plans.flows import run_dir
    rules = Expectations([r for r in sales.FRANCHISE_RULES.rules if r.on_violation == "fail"], "franchises_silver")
    good = chain.franchise_deliveries(spark, sf)
    bad = good.withColumn("franchiseID", F.expr("CASE WHEN franchiseID % 7 = 0 THEN NULL ELSE franchiseID END"))
    root, out = run_dir(spark, "expect_fail"), []
    for name, rows in (("deliveries", good), ("ids_missing", bad)):
        try:
            rules.apply(rows).write.parquet(f"{root}/{name}")
            out.append((name, False, spark.read.parquet(f"{root}/{name}").count()))
        except PySparkException as e:
            if "id_not_null" not in str(e):
                raise
            out.append((name, True, 0))
    return spark.createDataFrame(out, "update string, raised boolean, written long")


@register("expect_all", orc.expect_all)
def q_expect_all(spark, sf):
    rules = Expectations.from_dicts("suppliers_silver", expect_all_or_drop={
        "id_not_null": "supplierID IS NOT NULL", "valid_lat": "abs(latitude) <= 90",
        "valid_lon": "abs(longitude) <= 180"})
    return rules.apply(sales.clean_suppliers(analogs.supplier_deliveries(spark, sf)))


@register("expectation_metrics", orc.expectation_metrics)
def q_expectation_metrics(spark, sf):
    """Passed / failed counts of every rule of the pipeline, one aggregate per dataset."""
    cust = sales.CUSTOMER_RULES.metrics(sales.silver_customers(chain.bronze_customers(spark, sf)))
    tx = sales.TRANSACTION_RULES.metrics(sales.silver_transactions_projection(analogs.transaction_lines(spark, sf)))
    fr = sales.FRANCHISE_RULES.metrics(chain.franchise_deliveries(spark, sf))
    su = sales.SUPPLIER_RULES.metrics(sales.clean_suppliers(analogs.supplier_deliveries(spark, sf)))
    return cust.unionByName(tx).unionByName(fr).unionByName(su)


@register("quarantine", orc.quarantine)
def q_quarantine(spark, sf):
    return quarantine(analogs.supplier_deliveries(spark, sf), "supplierID IS NULL", "supplierID IS NULL",
                      with_timestamp=False)


# ---------------------------------------------------------------- scalar functions


@register("text_cleaning", orc.text_cleaning)
def q_text_cleaning(spark, sf):
    ch = analogs.customer_changes(spark, sf)
    return ch.select("customerid", "op", "updated_at", F.trim("first_name").alias("first_name"),
                     F.trim("address").alias("address"), F.trim("continent").alias("continent"),
                     clean_lower("gender").alias("gender"))


@register("date_parts", orc.DATE_PARTS)
def q_date_parts(spark, sf):
    o = analogs.load_table(spark, sf, "orders")
    return o.select("o_orderkey", *[v.alias(k) for k, v in date_parts("o_orderdate", "order").items()])


@register("json_path", orc.JSON_PATH)
def q_json_path(spark, sf):
    ev = analogs.events(spark, sf)
    return ev.select("event_id", json_path("props", "k").cast("int").alias("k"))


# ---------------------------------------------------------------- event log reports


def _event_log(spark, sf):
    return elog.log_from_events(analogs.events(spark, sf))


@register("event_log_recent", orc.event_log_recent)
def q_event_log_recent(spark, sf):
    return elog.recent(_event_log(spark, sf)).select(
        "timestamp", "event_type", F.col("origin.pipeline_id").alias("pipeline_id"),
        F.col("origin.update_id").alias("update_id"), "details")


@register("latest_update", orc.latest_update)
def q_latest_update(spark, sf):
    return elog.latest_update(_event_log(spark, sf))


@register("json_explode", orc.json_explode)
def q_json_explode(spark, sf):
    ex = elog.expectation_rows(_event_log(spark, sf))
    return ex.select("timestamp", "update_id", F.col("row_expectations.name").alias("expectation"),
                     F.col("row_expectations.dataset").alias("dataset"),
                     F.col("row_expectations.passed_records").alias("passed_records"),
                     F.col("row_expectations.failed_records").alias("failed_records"))


@register("event_log_quality", orc.event_log_quality)
def q_event_log_quality(spark, sf):
    return elog.quality_report(_event_log(spark, sf))


@register("event_log_flows", orc.event_log_flows)
def q_event_log_flows(spark, sf):
    return elog.flow_report(_event_log(spark, sf))


# ---------------------------------------------------------------- semantic layer, distance

DISTANCE_MAX_KM = 2500.0
NEAREST_SUPPLIERS = 5


@register("semantic_count", orc.semantic_count)
def q_semantic_count(spark, sf):
    model = SemanticModel.over_columns(chain.denormalized_sales(spark, sf))
    return model.query(["franchise_country", "product_name"], ["count"])


def _located(spark, sf):
    f = chain.silver_franchises(spark, sf).filter(
        "franchiseID IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND __END_AT IS NULL"
    ).select(F.col("franchiseID").alias("franchise_ID"), F.col("latitude").alias("f_lat"),
             F.col("longitude").alias("f_lon"))
    s = chain.silver_suppliers(spark, sf).filter(
        "supplierID IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND approved = 'Y' "
        "AND __END_AT IS NULL"
    ).select(F.col("supplierID").alias("supplier_ID"), F.col("latitude").alias("s_lat"),
             F.col("longitude").alias("s_lon"))
    return f, s


@register("distance", lambda: orc.distance(NEAREST_SUPPLIERS))
def q_distance(spark, sf):
    """The NEAREST_SUPPLIERS suppliers of each franchise by great-circle distance (growing grid search)."""
    f, s = _located(spark, sf)
    p = nearest(f, s, NEAREST_SUPPLIERS, "franchise_ID", "supplier_ID", ("f_lat", "f_lon"), ("s_lat", "s_lon"))
    return p.withColumn("distance_km", F.round("distance_km", 6))


@register("distance_within", lambda: orc.distance_within(DISTANCE_MAX_KM))
def q_distance_within(spark, sf):
    """Franchise-supplier pairs within DISTANCE_MAX_KM (grid equi-join)."""
    f, s = _located(spark, sf)
    p = pairs_within(f, s, DISTANCE_MAX_KM, ("f_lat", "f_lon"), ("s_lat", "s_lon"))
    return p.select("franchise_ID", "supplier_ID", F.round("distance_km", 6).alias("distance_km"))


# ---------------------------------------------------------------- ingest and streaming flows

register("csv_stream_ingest", orc.csv_stream_ingest)(flows.csv_stream_ingest)
register("csv_dialect", orc.csv_dialect)(flows.csv_dialect)
register("csv_path_glob", orc.csv_path_glob)(flows.csv_path_glob)
register("csv_infer_schema", orc.csv_infer_schema)(flows.csv_infer_schema)
register("csv_schema_hints", orc.csv_schema_hints)(flows.csv_schema_hints)
register("csv_evolve_add", orc.csv_evolve_add)(flows.csv_evolve_add)
register("csv_evolve_fail", orc.csv_evolve_fail)(flows.csv_evolve_fail)
register("csv_rescue", orc.csv_rescue)(flows.csv_rescue)
register("csv_throttle", orc.csv_throttle)(flows.csv_throttle)
register("csv_skip_existing", orc.csv_skip_existing)(flows.csv_skip_existing)
register("csv_file_metadata", orc.csv_file_metadata)(flows.csv_file_metadata)
register("csv_both_throttles", orc.csv_both_throttles)(flows.csv_both_throttles)
register("csv_header_case", orc.csv_stream_ingest)(flows.csv_header_case)
register("csv_ragged_rescue", orc.csv_ragged_rescue)(flows.csv_ragged_rescue)
register("json_evolve_add", orc.JSON_EVOLVE_ADD)(flows.json_evolve_add)
register("json_evolve_fail", orc.JSON_EVOLVE_FAIL)(flows.json_evolve_fail)
register("json_rescue", orc.JSON_RESCUE)(flows.json_rescue)
register("parquet_stream_ingest", orc.COLUMNAR_STREAM_INGEST)(flows.parquet_stream_ingest)
register("orc_stream_ingest", orc.COLUMNAR_STREAM_INGEST)(flows.orc_stream_ingest)
register("json_stream_ingest", orc.JSON_STREAM_INGEST)(flows.json_stream_ingest)
register("streaming_table_append", "SELECT * FROM events")(flows.streaming_table_append)
register("incremental_second_run", "SELECT * FROM orders")(flows.incremental_second_run)
register("scan_table", "SELECT * FROM orders")(flows.scan_table)
register("scan_stream_table", "SELECT * FROM customer")(flows.scan_stream_table)
register("materialized_view_refresh", orc.fact_sales)(flows.materialized_view_refresh)
register("table_properties", orc.table_properties)(flows.table_properties)
register("layer_setup", orc.layer_setup)(flows.layer_setup)
register("list_tables", orc.list_tables)(flows.list_tables)
register("scd2_incremental", lambda: orc.scd2_events(delete=EVENT_DELETE))(flows.scd2_incremental)
register("scd_late_events", orc.scd_late_events)(flows.scd_late_events)
register("scd_late_merge", lambda: orc.scd2_events(delete=EVENT_DELETE))(flows.scd_late_merge)
register("fact_sales_incremental", orc.fact_sales)(flows.fact_sales_incremental)
register("cursor_incremental_scd2", orc.cursor_incremental_scd2)(flows.cursor_incremental_scd2)
register("cursor_incremental_scd1", orc.CURSOR_SCD1)(flows.cursor_incremental_scd1)
register("cursor_late_commit", orc.CURSOR_SCD1)(flows.cursor_late_commit)
register("cursor_null", orc.CURSOR_NULL)(flows.cursor_null)
register("json_array_ingest", orc.JSON_STREAM_INGEST)(flows.json_array_ingest)
register("cursor_resume", orc.CURSOR_SCD1)(flows.cursor_resume)
register("scd2_composite_key", orc.scd2_composite_key)(flows.scd2_composite_key)
register("scd1_truncate_incremental", lambda: orc.scd1_events(truncate="value > 480"))(flows.scd1_truncate_incremental)
register("scd2_tie_across_batches", "SELECT user_id, CAST(0 AS BIGINT) AS differing FROM events GROUP BY user_id")(
    flows.scd2_tie_across_batches)
register("pipeline_full_refresh", orc.pipeline_full_refresh)(flows.pipeline_full_refresh)
register("suppliers_pipeline", orc.dim_supplier)(flows.suppliers_pipeline)
register("franchises_pipeline", orc.dim_franchise)(flows.franchises_pipeline)
register("pipeline_quality", orc.pipeline_quality)(flows.pipeline_quality)
register("quarantine_stream", orc.quarantine_stream)(flows.quarantine_stream)
register("sql_catalog_parameter", orc.franchises_by_country)(flows.sql_catalog_parameter)
register("gold_refresh_chart", lambda: orc.revenue_by("product_name"))(flows.gold_refresh_chart)
register("gold_refresh_quality", orc.gold_refresh_quality)(flows.gold_refresh_quality)
