"""Query builders that exercise ingest, streaming tables and incremental CDC end to end.

Each builder writes its inputs from the test tables (CSV / JSON files, Parquet stand-ins
for database tables) into a fresh run folder under the shared directory, runs the real
incremental machinery (file-list streams, ``foreachBatch`` targets, ``availableNow``
triggers) and returns the resulting table as a DataFrame.
"""

from __future__ import annotations

import functools
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levain.operators.cdc import CdcSpec, apply_changes
from levain.plans import analogs, chain, sales
from levain.session import SHUFFLES_REMOVED, settings, shared_dir
from levain.sources import fs
from levain.sources.cursor import CursorIngest, table_source
from levain.sources.files import BATCH_COLUMNS, FileIngest, NewColumnsError
from levain.sources.tables import Lakehouse
from levain.streaming.cdc_target import CdcTarget

# The reader options of the reference's CSV streams.
REFERENCE_CSV_OPTIONS = {
    "header": "true", "delimiter": ",", "quote": '"', "escape": "\\", "encoding": "UTF-8", "lineSep": "\n",
    "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd HH:mm:ss", "nullValue": "",
    "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
}
# Writing keeps padding so the reader's trimming is exercised.
WRITE_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "timestampFormat": "yyyy-MM-dd HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def run_dir(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, "runs", name, unique=True)


def write_csv(df: DataFrame, path: str, **options) -> None:
    """Write input files with the DataFrame's own parallelism (one file per partition)."""
    opts = {**WRITE_OPTIONS, **options}
    w = df.write.mode("overwrite").option("header", "true")
    for k, v in opts.items():
        w = w.option(k, v)
    w.csv(path)


def ingest(spark, root: str, glob: str, **kw) -> FileIngest:
    kw.setdefault("options", REFERENCE_CSV_OPTIONS)
    return FileIngest(spark, path=f"{root}/{glob}", target=f"{root}/_bronze", checkpoint=f"{root}/_checkpoint",
                      schema_location=f"{root}/_schema", **kw)


def supplier_snapshot(spark, sf, delivery: int) -> DataFrame:
    d = analogs.supplier_deliveries(spark, sf)
    return d.filter(F.col("file_name") == f"suppliers_{delivery}.csv").drop("file_name", "file_timestamp")


def _bronze(ing: FileIngest) -> DataFrame:
    return ing.read().drop(*BATCH_COLUMNS, "file_name", "file_timestamp")


# ------------------------------------------------------------------------------- S1 S2 S3
def csv_stream_ingest(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_stream_ingest")
    write_csv(supplier_snapshot(spark, sf, 1), f"{root}/sales_suppliers_1")
    write_csv(supplier_snapshot(spark, sf, 2), f"{root}/sales_suppliers_2")
    ing = ingest(spark, root, "sales_suppliers_*/*.csv", evolution_mode="addNewColumns",
                 max_files_per_trigger=1000, max_bytes_per_trigger="10g", max_file_age="365 days")
    ing.run()
    return _bronze(ing)


DIALECT = {"delimiter": ";", "quote": "'", "escape": "\\", "nullValue": "NA",
           "timestampFormat": "dd/MM/yyyy HH:mm", "dateFormat": "dd/MM/yyyy"}


def dialect_frame(spark, sf) -> DataFrame:
    f = analogs.franchises(spark, sf)
    return f.select(
        "franchiseID",
        F.when(F.col("franchiseID") % 4 == 0, F.concat(F.col("name"), F.lit("; 'Main' store"))).otherwise(
            F.col("name")).alias("name"),
        F.when(F.col("franchiseID") % 5 == 0, F.lit(None)).otherwise(F.col("district")).alias("district"),
        "country", "longitude", "latitude",
        (F.lit("2020-03-04 05:06:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.col("franchiseID").cast("int"))).alias("opened_at"),
        (F.lit("2020-03-04").cast("date") + F.col("franchiseID").cast("int")).alias("opened_on"),
    )


def csv_dialect(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_dialect")
    write_csv(dialect_frame(spark, sf), f"{root}/franchises_1", **{**DIALECT, "timestampNTZFormat": DIALECT["timestampFormat"]})
    ing = ingest(spark, root, "franchises_*/*.csv", options={**REFERENCE_CSV_OPTIONS, **DIALECT})
    ing.run()
    return _bronze(ing).drop("_rescued_data")


def csv_path_glob(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_path_glob")
    write_csv(supplier_snapshot(spark, sf, 1), f"{root}/suppliers_1")
    write_csv(analogs.franchises(spark, sf), f"{root}/franchises_1")
    # a non-CSV file inside a matching folder: dropped by pathGlobFilter
    supplier_snapshot(spark, sf, 1).select(F.to_json(F.struct("*")).alias("value")) \
        .write.mode("overwrite").text(f"{root}/suppliers_9")
    ing = ingest(spark, root, "suppliers_*", path_glob_filter="*.csv")
    ing.run()
    return _bronze(ing)


# ------------------------------------------------------------------------------- S4 S5
def csv_infer_schema(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_infer_schema")
    write_csv(analogs.customer_changes(spark, sf), f"{root}/customers_1")
    ing = ingest(spark, root, "customers_*/*.csv")
    ing.run()
    return _bronze(ing)


def csv_schema_hints(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_schema_hints")
    write_csv(analogs.franchises(spark, sf), f"{root}/franchises_1")
    ing = ingest(spark, root, "franchises_*/*.csv", schema_hints="franchiseID BIGINT, zipcode STRING")
    ing.run()
    return _bronze(ing)


# ------------------------------------------------------------------------------- S6 S7
def csv_evolve_add(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_evolve_add")
    write_csv(supplier_snapshot(spark, sf, 1).drop("ingredient"), f"{root}/suppliers_1")
    ing = ingest(spark, root, "suppliers_*/*.csv", evolution_mode="addNewColumns")
    ing.run()
    write_csv(supplier_snapshot(spark, sf, 2), f"{root}/suppliers_2")
    ing.run()
    return _bronze(ing)


def csv_evolve_fail(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_evolve_fail")
    write_csv(supplier_snapshot(spark, sf, 1).drop("ingredient"), f"{root}/suppliers_1")
    ing = ingest(spark, root, "suppliers_*/*.csv", evolution_mode="failOnNewColumns")
    ing.run()
    write_csv(supplier_snapshot(spark, sf, 2), f"{root}/suppliers_2")
    failed = False
    try:
        ing.run()
    except Exception as e:  # the stream surfaces the foreachBatch error
        failed = isinstance(e, NewColumnsError) or "NewColumnsError" in str(e) or "new columns" in str(e)
    return _bronze(ing).withColumn("second_run_failed", F.lit(failed))


def rescue_frame(spark, sf) -> DataFrame:
    s = supplier_snapshot(spark, sf, 2)
    key = F.coalesce(F.col("supplierID"), F.lit(0))
    return s.select(
        *[c for c in s.columns if c != "latitude" and c != "approved"],
        F.when(key % 9 == 0, F.lit("n/a")).otherwise(F.col("latitude").cast("string")).alias("latitude"),
        "approved",
        F.when(key % 2 == 0, F.concat(F.lit("note "), key.cast("string"))).alias("note"),
    )


def csv_rescue(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_rescue")
    write_csv(supplier_snapshot(spark, sf, 1), f"{root}/suppliers_1")
    ing = ingest(spark, root, "suppliers_*/*.csv", evolution_mode="rescue")
    ing.run()
    write_csv(rescue_frame(spark, sf), f"{root}/suppliers_2")
    ing.run()
    return _bronze(ing)


# ------------------------------------------------------------------------------- S8 S9 S10 S11
def csv_throttle(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_throttle")
    base = supplier_snapshot(spark, sf, 1)
    # five deliveries, a file each, written one after the other (ordered modification times)
    for i in range(5):
        write_csv(base.filter(F.coalesce(F.col("supplierID") % 5, F.lit(0)) == i).coalesce(1), f"{root}/part_{i}")
    ing = ingest(spark, root, "part_*/*.csv", max_files_per_trigger=2)
    ing.run()
    return ing.read().select("supplierID", "name", "__batch_id")


def csv_skip_existing(spark, sf) -> DataFrame:
    root = run_dir(spark, "csv_skip_existing")
    base = supplier_snapshot(spark, sf, 1)
    write_csv(base.filter("supplierID IS NULL OR supplierID % 2 = 0"), f"{root}/suppliers_old")
    ing = ingest(spark, root, "suppliers_*/*.csv", include_existing_files=False)
    ing.run()  # records the first start; the existing file is older and skipped
    write_csv(base.filter("supplierID % 2 = 1"), f"{root}/suppliers_new")
    ing.run()
    return _bronze(ing)


def csv_both_throttles(spark, sf) -> DataFrame:
    """Three files a batch and one byte: each batch is ingested file by file."""
    root = run_dir(spark, "csv_both_throttles")
    base = supplier_snapshot(spark, sf, 1)
    for i in range(5):
        write_csv(base.filter(F.coalesce(F.col("supplierID") % 5, F.lit(0)) == i).coalesce(1), f"{root}/part_{i}")
    ing = ingest(spark, root, "part_*/*.csv", max_files_per_trigger=3, max_bytes_per_trigger="1")
    ing.run()
    return ing.read().select("supplierID", "name", *BATCH_COLUMNS)


def csv_header_case(spark, sf) -> DataFrame:
    """A second delivery spells its header in capitals: the columns are the same."""
    root = run_dir(spark, "csv_header_case")
    write_csv(supplier_snapshot(spark, sf, 1), f"{root}/suppliers_1")
    ing = ingest(spark, root, "suppliers_*/*.csv", evolution_mode="rescue")
    ing.run()
    second = supplier_snapshot(spark, sf, 2)
    write_csv(second.toDF(*(c.upper() for c in second.columns)), f"{root}/suppliers_2")
    ing.run()
    return _bronze(ing)


RAGGED_TAIL = "CASE supplierID % 3 WHEN 0 THEN ',x1' WHEN 1 THEN ',y1,y2' ELSE '' END"


def csv_ragged_rescue(spark, sf) -> DataFrame:
    """Rows with more fields than their header: the fields beyond it are rescued."""
    root = run_dir(spark, "csv_ragged_rescue")
    line = F.expr(f"concat(coalesce(CAST(supplierID AS STRING), ''), ',', coalesce(replace(name, ',', ' '), ''), coalesce({RAGGED_TAIL}, ''))")
    write_csv(supplier_snapshot(spark, sf, 1).select(line.alias("supplierID,name")), f"{root}/suppliers_1", delimiter="|")
    ing = ingest(spark, root, "suppliers_*/*.csv", evolution_mode="rescue")
    ing.run()
    return _bronze(ing)


def csv_file_metadata(spark, sf) -> DataFrame:
    """Each row knows its file's name and time."""
    root = run_dir(spark, "csv_file_metadata")
    write_csv(supplier_snapshot(spark, sf, 1), f"{root}/suppliers_1")
    ing = ingest(spark, root, "suppliers_*/*.csv")
    ing.run()
    return ing.read().select(
        "supplierID", "name", F.col("file_name").rlike(r"/suppliers_1/part-[^/]*\.csv$").alias("file_named"),
        (F.col("file_timestamp") <= F.current_timestamp()).alias("file_dated"))


JSON_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def json_stream_ingest(spark, sf) -> DataFrame:
    root = run_dir(spark, "json_stream_ingest")
    ev = analogs.events(spark, sf).withColumn("week", F.expr(analogs.EVENT_BATCH_SQL))
    (ev.repartition(4, "week").write.mode("overwrite").option("timestampNTZFormat", JSON_TS_FORMAT)
     .partitionBy("week").json(f"{root}/events"))
    ing = FileIngest(spark, path=f"{root}/events/week=*/*.json", target=f"{root}/_bronze",
                     checkpoint=f"{root}/_checkpoint", schema_location=f"{root}/_schema", format="json",
                     max_files_per_trigger=2)
    ing.run()
    return _bronze(ing).drop("_rescued_data")


def _json_events(spark, sf, root: str, mode: str) -> FileIngest:
    return FileIngest(spark, path=f"{root}/events_*/*.json", target=f"{root}/_bronze", checkpoint=f"{root}/_checkpoint",
                      schema_location=f"{root}/_schema", format="json", evolution_mode=mode)


def _write_json(df: DataFrame, path: str) -> None:
    df.write.option("timestampNTZFormat", JSON_TS_FORMAT).json(path)


def json_evolve_add(spark, sf) -> DataFrame:
    """The field ``value`` comes with the second delivery and becomes a column."""
    root = run_dir(spark, "json_evolve_add")
    ev = analogs.events(spark, sf)
    _write_json(ev.filter("event_id % 2 = 0").drop("value"), f"{root}/events_1")
    ing = _json_events(spark, sf, root, "addNewColumns")
    ing.run()
    _write_json(ev.filter("event_id % 2 = 1"), f"{root}/events_2")
    ing.run()
    return _bronze(ing)


def json_evolve_fail(spark, sf) -> DataFrame:
    root = run_dir(spark, "json_evolve_fail")
    ev = analogs.events(spark, sf)
    _write_json(ev.filter("event_id % 2 = 0").drop("value"), f"{root}/events_1")
    ing = _json_events(spark, sf, root, "failOnNewColumns")
    ing.run()
    _write_json(ev.filter("event_id % 2 = 1"), f"{root}/events_2")
    failed = False
    try:
        ing.run()
    except Exception as e:  # the stream surfaces the foreachBatch error
        failed = "NewColumnsError" in str(e) or "new columns" in str(e)
    return _bronze(ing).withColumn("second_run_failed", F.lit(failed))


def json_rescue(spark, sf) -> DataFrame:
    """The second delivery has text for some user ids, and a field that the schema lacks."""
    root = run_dir(spark, "json_rescue")
    ev = analogs.events(spark, sf)
    _write_json(ev.filter("event_id % 2 = 0"), f"{root}/events_1")
    ing = _json_events(spark, sf, root, "rescue")
    ing.run()
    odd = ev.filter("event_id % 2 = 1")
    user = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("u-"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    _write_json(odd.withColumn("user_id", user).withColumn("note", F.expr("CASE WHEN event_id % 5 = 0 THEN 'n' END")), f"{root}/events_2")
    ing.run()
    return _bronze(ing)


def _columnar_stream_ingest(spark, sf, fmt: str) -> DataFrame:
    """Orders in two deliveries; the second has prices as text, some of them no numbers, and a new column."""
    root = run_dir(spark, f"{fmt}_stream_ingest")
    orders = analogs.load_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    orders.filter("o_orderkey % 2 = 0").write.format(fmt).save(f"{root}/orders_1")
    ing = FileIngest(spark, path=f"{root}/orders_*/*.{fmt}", target=f"{root}/_bronze", checkpoint=f"{root}/_checkpoint",
                     schema_location=f"{root}/_schema", format=fmt)
    ing.run()
    price = F.expr("CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS STRING) END")
    second = orders.filter("o_orderkey % 2 = 1").withColumn("o_totalprice", price).withColumn("o_note", F.col("o_orderkey") % 10)
    second.write.format(fmt).save(f"{root}/orders_2")
    ing.run()
    return _bronze(ing)


def parquet_stream_ingest(spark, sf) -> DataFrame:
    return _columnar_stream_ingest(spark, sf, "parquet")


def orc_stream_ingest(spark, sf) -> DataFrame:
    return _columnar_stream_ingest(spark, sf, "orc")


# ------------------------------------------------------------------------------- K1 K3 K6 K7 K9 S14-S16
def _lakehouse(spark, name: str) -> Lakehouse:
    lh = Lakehouse(spark, catalog=f"q_{name}_{int(time.time() * 1000) % 10**9}", root=run_dir(spark, name))
    lh.setup()
    return lh


def _source_table(lh: Lakehouse, sf: str, table: str) -> str:
    """A directory-backed copy of a test table (a stream needs a folder, the inputs are single files)."""
    lh.materialized_view("bronze", f"{table}_src", lh.spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet"))
    return lh.name("bronze", f"{table}_src")


def streaming_table_append(spark, sf) -> DataFrame:
    lh = _lakehouse(spark, "stream_append")
    src = _source_table(lh, sf, "events")
    lh.streaming_table("bronze", "events_raw", spark.readStream.table(src), properties={"quality": "Bronze"})
    return spark.read.table(lh.name("bronze", "events_raw"))


def incremental_second_run(spark, sf) -> DataFrame:
    """Run the same streaming table twice on one checkpoint: the second run adds nothing."""
    lh = _lakehouse(spark, "second_run")
    src = _source_table(lh, sf, "orders")
    ckpt = f"{lh.root}/_ckpt_orders"
    for _ in range(2):
        lh.streaming_table("bronze", "orders_raw", spark.readStream.table(src), checkpoint=ckpt)
    return spark.read.table(lh.name("bronze", "orders_raw"))


def scan_table(spark, sf) -> DataFrame:
    lh = _lakehouse(spark, "scan_table")
    return spark.read.table(lh.register_parquet("bronze", "orders", f"{sf.rstrip('/')}/orders.parquet"))


def scan_stream_table(spark, sf) -> DataFrame:
    lh = _lakehouse(spark, "scan_stream")
    src = _source_table(lh, sf, "customer")
    lh.streaming_table("silver", "customer_copy", spark.readStream.table(src))
    return spark.read.table(lh.name("silver", "customer_copy"))


def materialized_view_refresh(spark, sf) -> DataFrame:
    lh = _lakehouse(spark, "mv")
    lh.materialized_view("gold", "fact_transactions_sales_gold", chain.fact_sales(spark, sf),
                         comment="Daily sales per customer, franchise and product", properties={"quality": "Gold"})
    # a refresh recomputes and replaces the stored rows
    return lh.materialized_view("gold", "fact_transactions_sales_gold", chain.fact_sales(spark, sf))


def table_properties(spark, sf) -> DataFrame:
    """A gold table's comment and quality property beside its number of rows."""
    lh = _lakehouse(spark, "props")
    stored = lh.materialized_view("gold", "dim_franchise_gold", chain.dim_franchise(spark, sf),
                                  comment="Franchise dimension with valid records only", properties={"quality": "Gold"})
    quality = lh.properties("gold", "dim_franchise_gold").filter(F.col("key") == "quality").first()
    comment = spark.catalog.getTable(lh.name("gold", "dim_franchise_gold")).description
    return stored.agg(F.count("*").alias("rows")).select(
        F.lit(quality["key"]).alias("key"), F.lit(quality["value"]).alias("value"), F.lit(comment).alias("comment"), "rows")


def layer_setup(spark, sf) -> DataFrame:
    """The layers of an environment with the rows of their supplier tables; a second environment is torn down again."""
    lh, gone = _lakehouse(spark, "layers"), _lakehouse(spark, "layers_gone")
    gone.teardown()
    left = {r["namespace"] for r in spark.sql("SHOW DATABASES").collect()}  # catalog entries
    made = {"bronze": supplier_snapshot(spark, sf, 1), "silver": chain.silver_suppliers(spark, sf), "gold": chain.dim_supplier(spark, sf)}
    counted = [lh.materialized_view(layer, "suppliers", df).agg(F.count("*").alias("rows")).select(
        F.lit(layer).alias("layer"), "rows", F.lit(lh.database(layer) in left).alias("present"),
        F.lit(gone.database(layer) in left).alias("torn_down_present")) for layer, df in made.items()]
    return functools.reduce(DataFrame.unionByName, counted)


def list_tables(spark, sf) -> DataFrame:
    """The tables of a layer with their row counts."""
    lh = _lakehouse(spark, "list")
    for t in ("customer", "orders", "supplier"):
        lh.register_parquet("bronze", t, f"{sf.rstrip('/')}/{t}.parquet")
    names = [r["tableName"] for r in lh.list_tables("bronze").filter("not isTemporary").collect()]  # catalog entries
    counted = [spark.read.table(lh.name("bronze", t)).agg(F.count("*").alias("rows"))
               .select(F.lit(t).alias("tableName"), "rows") for t in names]
    return functools.reduce(DataFrame.unionByName, counted)


# ------------------------------------------------------------------------------- C2 C7 S12 S13
EVENTS_SPEC = CdcSpec(keys=("user_id",), sequence_by="ts", columns=("event_type", "value"),
                      apply_as_deletes="event_type = 'error'")


def scd2_incremental(spark, sf) -> DataFrame:
    """Four in-order weekly batches through the bucketed target equal the one-shot result."""
    root = run_dir(spark, "scd2_incremental")
    target = CdcTarget(spark, f"{root}/target", EVENTS_SPEC)
    ev = analogs.events(spark, sf).withColumn("__week", F.expr(analogs.EVENT_BATCH_SQL))
    for week in range(4):
        target.apply(ev.filter(F.col("__week") == week).drop("__week"), week)
    target.apply(ev.filter(F.col("__week") == 3).drop("__week"), 3)  # a replayed batch id is a no-op
    return target.read()


def scd_late_events(spark, sf) -> DataFrame:
    """Every fourth event arrives one batch late; late='ignore' drops those older than the key's newest."""
    root = run_dir(spark, "scd_late_events")
    target = CdcTarget(spark, f"{root}/target", EVENTS_SPEC)
    ev = analogs.events(spark, sf)
    target.apply(ev.filter(F.col("event_id") % 4 != 0), 0)
    target.apply(ev.filter(F.col("event_id") % 4 == 0), 1)
    return target.read()


def scd_late_merge(spark, sf) -> DataFrame:
    """late='merge': the late events are inserted into history (equals the one-shot result)."""
    root = run_dir(spark, "scd_late_merge")
    spec = CdcSpec(keys=EVENTS_SPEC.keys, sequence_by="ts", columns=EVENTS_SPEC.columns,
                   apply_as_deletes=EVENTS_SPEC.apply_as_deletes, late="merge")
    target = CdcTarget(spark, f"{root}/target", spec)
    ev = analogs.events(spark, sf)
    target.apply(ev.filter(F.col("event_id") % 4 != 0), 0)
    target.apply(ev.filter(F.col("event_id") % 4 == 0), 1)
    return target.read()


def cursor_incremental_scd2(spark, sf) -> DataFrame:
    """The customers table read twice by cursor (first load, then its latest state) into SCD2."""
    root = run_dir(spark, "cursor_scd2")
    changes = analogs.customer_changes(spark, sf)
    first = changes.filter(F.col("updated_at") == F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    latest = changes.withColumn("__rk", F.row_number().over(
        Window.partitionBy("customerid").orderBy(F.desc("updated_at")))).filter("__rk = 1").drop("__rk")
    target = CdcTarget(spark, f"{root}/target", chain.CUSTOMER_CDC)
    for i, snap in enumerate((first, latest)):
        snap.write.mode("overwrite").parquet(f"{root}/db_customers")  # the database table at time i
        ing = CursorIngest(spark, table_source(lambda: spark.read.parquet(f"{root}/db_customers")),
                           "updated_at", target, f"{root}/_cursor")
        ing.run()
    return target.read()


def cursor_incremental_scd1(spark, sf) -> DataFrame:
    """Orders keyed by transactionid: an early snapshot, then the full table, as SCD1."""
    root = run_dir(spark, "cursor_scd1")
    tx = analogs.order_transactions(spark, sf)
    spec = CdcSpec(keys=("transactionid",), sequence_by="updated_at", stored_as_scd_type=1)
    target = CdcTarget(spark, f"{root}/target", spec)
    snaps = (tx.filter(F.col("updated_at") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")), tx)
    for snap in snaps:
        snap.write.mode("overwrite").parquet(f"{root}/db_transactions")
        CursorIngest(spark, table_source(lambda: spark.read.parquet(f"{root}/db_transactions")), "updated_at",
                     target, f"{root}/_cursor").run()
    return target.read()


def cursor_resume(spark, sf) -> DataFrame:
    """A load breaks off between apply and mark while rows arrive: nothing is lost and nothing applied twice."""
    root = run_dir(spark, "cursor_resume")
    tx = analogs.order_transactions(spark, sf)
    spec = CdcSpec(keys=("transactionid",), sequence_by="updated_at", stored_as_scd_type=1)
    target = CdcTarget(spark, f"{root}/target", spec)

    class BreaksOff(CursorIngest):
        def _record(self, run, low, high, kind, done):
            if done:
                raise ConnectionError("lost between apply and mark")
            super()._record(run, low, high, kind, done)

    def load(kind):
        return kind(spark, table_source(lambda: spark.read.parquet(f"{root}/db")), "updated_at", target, f"{root}/_cursor").run()

    early = F.col("updated_at") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    tx.filter(early).write.parquet(f"{root}/db")
    try:
        load(BreaksOff)
    except ConnectionError:
        pass
    tx.filter(~early).write.mode("append").parquet(f"{root}/db")
    load(CursorIngest)  # the broken window again
    load(CursorIngest)  # what arrived meanwhile
    return target.read()


def sales_updates(spark, sf, root: str | None = None) -> list[DataFrame]:
    """The transaction lines in three updates: a first one with wrong quantities, wrong days, lines held back and lines too many;
    one that corrects quantities and deletes what was too many; one that corrects days and brings the rest.
    The lines are joined and numbered once, into a folder below ``root``."""
    tx = analogs.transaction_lines(spark, sf)
    again = Window.partitionBy("cardnumber").orderBy(F.xxhash64(*tx.columns))  # the test table repeats line numbers
    tx = tx.withColumn("line", F.col("cardnumber") * 1000 + F.row_number().over(again))
    lines = f"{root or run_dir(spark, 'sales_updates')}/lines"
    with settings(spark, SHUFFLES_REMOVED):
        tx.write.parquet(lines)
    tx = spark.read.schema(tx.schema).parquet(lines)
    wrong = {"quantity": F.when(F.col("line") % 7 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")),
             "totalprice": F.when(F.col("line") % 7 == 0, F.col("totalprice") + F.col("unitprice")).otherwise(F.col("totalprice")).cast("decimal(18,2)"),
             "datetime": F.when(F.col("line") % 13 == 0, F.col("datetime") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("datetime"))}
    extra = F.col("extra")

    def part(lines: str, op: str) -> DataFrame:
        """``lines`` and those that are too many (under negative numbers, with ``op``), from one scan."""
        kinds = F.array_compact(F.array(F.when(F.expr(lines), False), F.when(F.expr("line % 17 = 0"), True)))
        return tx.filter(f"{lines} OR line % 17 = 0").withColumn("extra", F.explode(kinds)).withColumn("op", F.when(extra, op).otherwise("U"))

    def numbered(df: DataFrame) -> DataFrame:
        return df.withColumn("line", F.when(extra, -F.col("line")).otherwise(F.col("line"))).drop("extra")

    first = part("line % 11 <> 0", "U").withColumns({c: F.when(extra, F.col(c)).otherwise(v) for c, v in wrong.items()})
    parts = [numbered(first), numbered(part("line % 7 = 0 AND line % 11 <> 0", "D")), tx.filter("line % 13 = 0 OR line % 11 = 0").withColumn("op", F.lit("U"))]
    return [p.withColumn("update", F.lit(n)) for n, p in enumerate(parts)]


SALES_CDC = CdcSpec(keys=("line",), sequence_by="update", except_columns=("op", "update"), stored_as_scd_type=1, apply_as_deletes="op = 'D'")


def fact_sales_incremental(spark, sf) -> DataFrame:
    """The daily fact kept up to date from the changes of three updates with corrections, late lines and deletes."""
    root = run_dir(spark, "fact_sales_incremental")
    bronze = CdcTarget(spark, f"{root}/transactions", SALES_CDC)
    view = sales.fact_sales_view(spark, f"{root}/fact", bronze)
    for n, update in enumerate(sales_updates(spark, sf, root)):
        bronze.apply(update, n)
        view.refresh()
    fs.remove(spark, f"{root}/lines")
    return sales.fact_sales_of(view)


def cursor_late_commit(spark, sf) -> DataFrame:
    """Every ninth order of the last 60 days before the first load is committed after it: the look-back finds it, once."""
    root = run_dir(spark, "cursor_late_commit")
    tx = analogs.order_transactions(spark, sf)
    target = CdcTarget(spark, f"{root}/target", CdcSpec(keys=("transactionid",), sequence_by="updated_at"))
    mark = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    late = (F.col("transactionid") % 9 == 0) & (F.col("updated_at") >= mark - F.expr("INTERVAL 60 DAYS"))
    for part in (tx.filter((F.col("updated_at") < mark) & ~late), tx.filter(F.col("updated_at") < mark), tx):
        part.write.mode("overwrite").parquet(f"{root}/db")
        CursorIngest(spark, table_source(lambda: spark.read.parquet(f"{root}/db")), "updated_at", target, f"{root}/_cursor", look_back="90 days").run()
    return target.read().drop("__START_AT", "__END_AT")


def cursor_null(spark, sf) -> DataFrame:
    """Every fiftieth order has no cursor value in the first two loads: quarantined, not lost; half of them get one in the third."""
    root = run_dir(spark, "cursor_null")
    tx = analogs.order_transactions(spark, sf)
    target = CdcTarget(spark, f"{root}/target", CdcSpec(keys=("transactionid",), sequence_by="updated_at", stored_as_scd_type=1))
    nulled = lambda every: tx.withColumn("updated_at", F.when(F.col("transactionid") % every != 0, F.col("updated_at")))
    first = F.col("datetime") < F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    for part in (nulled(50).filter(first), nulled(50), nulled(100).withColumn("updated_at", F.when(F.col("transactionid") % 100 == 50, F.lit("2031-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("updated_at")))):
        part.write.mode("overwrite").parquet(f"{root}/db")
        load = CursorIngest(spark, table_source(lambda: spark.read.parquet(f"{root}/db")), "updated_at", target, f"{root}/_cursor", null_cursor="quarantine", quarantine=f"{root}/quarantine")
        load.run()
    return target.read().withColumn("quarantine_reason", F.lit(None).cast("string")).unionByName(load.quarantined())


def json_array_ingest(spark, sf) -> DataFrame:
    """Files that are one JSON array each, over many lines: a row for each element."""
    root = run_dir(spark, "json_array_ingest")
    ev = analogs.events(spark, sf)
    files = ev.groupBy(F.floor(F.col("event_id") / 1000).alias("file")).agg(F.collect_list(F.struct(*ev.columns)).alias("rows"))  # 1,000 events a file
    text = F.regexp_replace(F.to_json("rows", {"timestampNTZFormat": JSON_TS_FORMAT}), r"\},\{", "},\n {")
    files.select("file", text.alias("value")).repartition("file").write.option("maxRecordsPerFile", 1).partitionBy("file").text(f"{root}/events")
    ing = FileIngest(spark, path=f"{root}/events/file=*/*.txt", target=f"{root}/_bronze", checkpoint=f"{root}/_checkpoint",
                     schema_location=f"{root}/_schema", format="json", options={"multiLine": "true"})
    ing.run()
    return _bronze(ing).drop("_rescued_data")


NULLED_REGION = "CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id % 2 END"


def scd2_composite_key(spark, sf) -> DataFrame:
    """A key of two columns, one of them NULL in part of the rows: in one go and in weekly batches."""
    root = run_dir(spark, "scd2_composite_key")
    spec = CdcSpec(keys=("user_id", "region"), sequence_by="ts", columns=("event_type", "value"),
                   apply_as_deletes="event_type = 'error'")
    ev = analogs.events(spark, sf).withColumn("region", F.expr(NULLED_REGION))
    target = CdcTarget(spark, f"{root}/target", spec)
    week = F.expr(analogs.EVENT_BATCH_SQL)
    for i in range(4):
        target.apply(ev.filter(week == i), i)
    return (apply_changes(ev, spec).withColumn("how", F.lit("one go"))
            .unionByName(target.read().withColumn("how", F.lit("batches"))))


def scd1_truncate_incremental(spark, sf) -> DataFrame:
    """Every fourth event comes a batch late; those from before a truncate of the first batch stay out."""
    root = run_dir(spark, "scd1_truncate_incremental")
    spec = CdcSpec(keys=("user_id",), sequence_by="ts", columns=("ts", "event_type", "value"), stored_as_scd_type=1,
                   apply_as_truncates="value > 480", late="merge")
    target = CdcTarget(spark, f"{root}/target", spec)
    ev = analogs.events(spark, sf)
    for i, part in enumerate((ev.filter("event_id % 4 <> 0"), ev.filter("event_id % 4 = 0"))):
        target.apply(part, i)
    return target.read()


def scd2_tie_across_batches(spark, sf) -> DataFrame:
    """Each user's newest event comes again in a second batch with another value: rows by user in which
    the batches differ from one go."""
    root = run_dir(spark, "scd2_tie_across_batches")
    ev = analogs.events(spark, sf).select("user_id", "ts", "event_type", "value")
    again = ev.groupBy("user_id").agg(F.max_by(F.struct("ts", "event_type", (F.col("value") + 1).alias("value")), "ts").alias("e")).select("user_id", "e.*")
    target = CdcTarget(spark, f"{root}/target", EVENTS_SPEC)
    for i, part in enumerate((ev, again)):
        target.apply(part, i)
    both = apply_changes(ev.unionByName(again), EVENTS_SPEC).withColumn("n", F.lit(1)).unionByName(target.read().withColumn("n", F.lit(-1)))
    odd = both.groupBy("user_id", "event_type", "value", "__START_AT", "__END_AT").agg(F.sum("n").alias("n")).filter("n <> 0")
    return ev.select("user_id").distinct().join(odd, "user_id", "left").groupBy("user_id").agg(F.count("n").alias("differing"))


# ------------------------------------------------------------------------------- end-to-end flows
def _supplier_flow(spark, sf):
    from levain.plans.eventlog import EventLog
    from levain.plans.pipelines import supplier_pipeline
    root = run_dir(spark, "suppliers_pipeline")
    vol = f"{root}/volume/input_files"
    log = EventLog(spark, f"{root}/event_log", "sales_pipeline")
    p = supplier_pipeline(spark, root, f"{vol}/sales_suppliers_*/*.csv", log)
    write_csv(supplier_snapshot(spark, sf, 1), f"{vol}/sales_suppliers_1")
    p.run("update_1")
    write_csv(supplier_snapshot(spark, sf, 2), f"{vol}/sales_suppliers_2")
    p.run("update_2")
    return p, log


def suppliers_pipeline(spark, sf) -> DataFrame:
    """Two file deliveries, two pipeline updates: bronze -> clean -> SCD2 silver -> gold dimension."""
    from levain.plans import sales
    p, _ = _supplier_flow(spark, sf)
    return sales.dim_supplier(p.silver_table())


def pipeline_quality(spark, sf) -> DataFrame:
    """The event-log quality report of the latest update, fed by the observed expectation counts."""
    from levain.plans.eventlog import quality_report
    _, log = _supplier_flow(spark, sf)
    return quality_report(log.read())


def pipeline_full_refresh(spark, sf) -> DataFrame:
    """Two updates, a full refresh and one more update: number of versions of each supplier, and of open ones."""
    p, _ = _supplier_flow(spark, sf)
    p.full_refresh()
    p.run()
    return p.silver_table().groupBy("supplierID").agg(F.count("*").alias("versions"), F.count_if(F.col("__END_AT").isNull()).alias("open"))


def quarantine_stream(spark, sf) -> DataFrame:
    p, _ = _supplier_flow(spark, sf)
    return p.quarantine_table().drop("quarantine_timestamp", "file_name", "file_timestamp", "_rescued_data",
                                     *BATCH_COLUMNS)


def franchises_pipeline(spark, sf) -> DataFrame:
    from levain.plans import sales
    from levain.plans.pipelines import franchise_pipeline
    root = run_dir(spark, "franchises_pipeline")
    vol = f"{root}/volume/input_files"
    write_csv(analogs.franchises(spark, sf), f"{vol}/sales_franchises_1")
    p = franchise_pipeline(spark, root, f"{vol}/sales_franchises_*/*.csv")
    p.run()
    return sales.dim_franchise(p.silver_table())


# SQL text with an environment parameter, as a dataset definition.
FRANCHISES_BY_COUNTRY_SQL = """
    SELECT country, count(*) AS franchises, count(DISTINCT city) AS cities, max(name) AS last_name
    FROM ${catalog}_silver.franchises_silver
    WHERE __END_AT IS NULL AND franchiseID IS NOT NULL
    GROUP BY country"""


def sql_catalog_parameter(spark, sf) -> DataFrame:
    """K8: the silver table is stored in the environment's layer, the gold view is SQL text with
    ``${catalog}`` substituted for that environment."""
    from levain.sources.tables import substitute
    lh = _lakehouse(spark, "param")
    lh.materialized_view("silver", "franchises_silver", chain.silver_franchises(spark, sf), properties={"quality": "Silver"})
    return lh.materialized_view("gold", "franchises_by_country", spark.sql(substitute(FRANCHISES_BY_COUNTRY_SQL, {"catalog": lh.catalog})))


def _gold_refresh(spark, sf):
    from levain.plans.eventlog import EventLog
    from levain.plans.pipelines import refresh_gold
    lh = _lakehouse(spark, "gold_refresh")
    log = EventLog(spark, f"{lh.root}/event_log", "sales_pipeline")
    tables = refresh_gold(spark, sf, lh, log, update_id="refresh_1")
    return tables, log


def gold_refresh_chart(spark, sf) -> DataFrame:
    """The chart query over the stored denormalized gold table after one pipeline update."""
    from levain.plans import sales
    tables, _ = _gold_refresh(spark, sf)
    return sales.revenue_by_product(spark.read.table(tables["fact_transactions_sales_denormalized_gold"]))


def gold_refresh_quality(spark, sf) -> DataFrame:
    from levain.plans.eventlog import quality_report
    _, log = _gold_refresh(spark, sf)
    return quality_report(log.read())
