"""Pipeline event log: writer and the two reports (quality of the latest update, flow lineage).

Columns: ``timestamp``, ``event_type``, ``origin struct<pipeline_id, update_id>`` and
``details`` (a JSON string).  Three kinds of rows matter: ``create_update`` (one per
run), ``flow_progress`` with ``details.flow_progress.data_quality.expectations`` and
``flow_definition`` rows describing each flow.

The reports find the newest ``create_update`` with a top-1 (``TakeOrderedAndProject``),
broadcast that single row (a proven one-row bound) and join the log to it.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levain.functions.json import json_path

EXPECTATION_DDL = "struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>"
EVENT_LOG_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("origin", T.StructType([T.StructField("pipeline_id", T.StringType()),
                                          T.StructField("update_id", T.StringType())])),
    T.StructField("details", T.StringType()),
])


# --------------------------------------------------------------------------------- writer
class EventLog:
    """Append-only event log table at ``path`` (Parquet)."""

    def __init__(self, spark: SparkSession, path: str, pipeline_id: str):
        self.spark, self.path, self.pipeline_id = spark, path, pipeline_id

    def _append(self, update_id: str, event_type: str, details: dict) -> None:
        row = (_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), event_type,
               (self.pipeline_id, update_id), json.dumps(details, separators=(",", ":")))
        self.spark.createDataFrame([row], EVENT_LOG_SCHEMA).write.mode("append").parquet(self.path)

    def create_update(self, update_id: str, cause: str = "USER_ACTION") -> None:
        self._append(update_id, "create_update", {"create_update": {"cause": cause}})

    def flow_definition(self, update_id: str, output_dataset: str, input_datasets: list[str], flow_type: str,
                        schema: T.StructType) -> None:
        fields = [{"name": f.name, "data_type": f.dataType.simpleString()} for f in schema.fields]
        self._append(update_id, "flow_definition", {"flow_definition": {
            "output_dataset": output_dataset, "input_datasets": input_datasets, "flow_type": flow_type,
            "schema": fields}})

    def flow_progress(self, update_id: str, expectations: list[dict], status: str = "COMPLETED", target: str | None = None, version: int | None = None) -> None:
        """The counts of one write; with ``target`` and ``version``, of that version of a target table."""
        of = {} if target is None else {"target": target, "version": version}
        self._append(update_id, "flow_progress", {"flow_progress": {
            "status": status, "data_quality": {"expectations": expectations}, **of}})

    def logged_version(self, target: str) -> int:
        """The newest version of ``target`` whose counts are in the log; 0 if none."""
        part = lambda name: F.get_json_object("details", f"$.flow_progress.{name}")
        done = self.read().filter((F.col("event_type") == "flow_progress") & (part("target") == target))
        return done.agg(F.max(part("version").cast("int"))).first()[0] or 0

    def read(self) -> DataFrame:
        return self.spark.read.schema(EVENT_LOG_SCHEMA).parquet(self.path)


# --------------------------------------------------------------------------------- reports
def recent(log: DataFrame) -> DataFrame:
    return log.orderBy(F.desc("timestamp"))


def latest_update(log: DataFrame) -> DataFrame:
    """The newest create_update event: one row (pipeline_id, latest_update_id)."""
    return (log.filter(F.col("event_type") == "create_update").orderBy(F.desc("timestamp")).limit(1)
            .select(F.col("origin.pipeline_id").alias("pipeline_id"),
                    F.col("origin.update_id").alias("latest_update_id")))


def _rows_of_latest_update(log: DataFrame) -> DataFrame:
    lu = F.broadcast(latest_update(log).select("latest_update_id"))  # exactly one row
    return log.join(lu, F.col("origin.update_id") == F.col("latest_update_id"), "inner")


def expectation_rows(log: DataFrame) -> DataFrame:
    """One row per reported expectation (empty or missing arrays give no row)."""
    arr = F.from_json(json_path("details", "flow_progress:data_quality:expectations"), f"array<{EXPECTATION_DDL}>")
    return log.select("timestamp", F.col("origin.update_id").alias("update_id"),
                      F.explode(arr).alias("row_expectations"))


def quality_report(log: DataFrame) -> DataFrame:
    ex = expectation_rows(_rows_of_latest_update(log))
    return ex.groupBy(F.col("row_expectations.dataset").alias("dataset"),
                      F.col("row_expectations.name").alias("expectation")).agg(
        F.sum("row_expectations.passed_records").alias("passing_records"),
        F.sum("row_expectations.failed_records").alias("failing_records"))


#: Parts of a flow definition by their report column; texts as they are, objects and arrays as JSON.
FLOW_PARTS = {"flow_name": "output_dataset", "input_flow_names": "input_datasets", "flow_type": "flow_type", "schema": "schema"}


def flow_report(log: DataFrame) -> DataFrame:
    """Flow definitions of the newest update.  Each event is parsed once, and the definition in it once (not a path at a time;
    a VARIANT would sort the fields of the texts that are given back)."""
    rows = _rows_of_latest_update(log).filter(F.col("event_type") == "flow_definition")
    rows = rows.select("timestamp", F.from_json("details", "flow_definition STRING").flow_definition.alias("flow_definition")).filter("flow_definition IS NOT NULL")
    rows = rows.withColumn("parts", F.from_json("flow_definition", ", ".join(f"{part} STRING" for part in FLOW_PARTS.values())))
    return rows.select(*(F.col(f"parts.{part}").alias(name) for name, part in FLOW_PARTS.items()), "flow_definition", "timestamp").orderBy("timestamp").drop("timestamp")


# ------------------------------------------------------------------- analog log from events
def log_from_events(events: DataFrame) -> DataFrame:
    """An event log built from the ``events`` table (FIXTURES.md): update id from the user id."""
    k = F.get_json_object("props", "$.k").cast("int")
    ds = F.concat(F.lit("ds_"), (F.col("user_id") % 5).cast("string"))
    exp_t = F.struct(F.lit("x").alias("name"), F.lit("x").alias("dataset"), F.lit(0).cast("long").alias("passed_records"),
                     F.lit(0).alias("failed_records"))
    expectations = F.array(
        F.struct(F.lit("valid_value").alias("name"), ds.alias("dataset"),
                 (F.floor("value").cast("long") * 100_000_000).alias("passed_records"), (k % 7).alias("failed_records")),
        F.struct(F.lit("valid_type").alias("name"), ds.alias("dataset"),
                 (F.col("event_id") % 100).cast("long").alias("passed_records"), (k % 3).alias("failed_records")))
    empty = F.slice(F.array(exp_t), 1, 0)
    progress = F.to_json(F.struct(F.struct(
        F.lit("COMPLETED").alias("status"),
        F.struct(k.alias("dropped_records"),
                 F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 7 == 0), empty)
                 .otherwise(expectations).alias("expectations")).alias("data_quality")).alias("flow_progress")))
    failed = F.to_json(F.struct(F.struct(F.lit("FAILED").alias("status")).alias("flow_progress")))
    definition = F.to_json(F.struct(F.struct(
        ds.alias("output_dataset"),
        F.array(F.concat(F.lit("src_"), (F.col("event_id") % 3).cast("string")), F.lit("src_common"))
        .alias("input_datasets"),
        F.when(F.col("event_id") % 2 == 0, F.lit("merge")).otherwise(F.lit("append")).alias("flow_type"),
        F.array(F.struct(F.lit("value").alias("name"), F.lit("DOUBLE").alias("data_type")),
                F.struct(F.lit("event_type").alias("name"), F.lit("STRING").alias("data_type"))).alias("schema"),
    ).alias("flow_definition")))
    create = F.to_json(F.struct(F.struct(F.lit("USER_ACTION").alias("cause")).alias("create_update")))
    et = F.col("event_type")
    return events.select(
        F.col("ts").alias("timestamp"),
        F.when(et == "signup", "create_update").when(et == "view", "flow_definition")
        .otherwise("flow_progress").alias("event_type"),
        F.struct(F.concat(F.lit("pipe_"), (F.col("user_id") % 3).cast("string")).alias("pipeline_id"),
                 F.concat(F.lit("upd_"), (F.col("user_id") % 20).cast("string")).alias("update_id")).alias("origin"),
        F.when(et == "signup", create).when(et == "view", definition).when(et == "error", failed)
        .otherwise(progress).alias("details"),
    )


def log_from_events_sql() -> str:
    """The same log in DuckDB SQL (oracle side)."""
    k = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
    ds = "('ds_' || CAST(user_id % 5 AS VARCHAR))"
    exps = (f"json_array(json_object('name', 'valid_value', 'dataset', {ds}, 'passed_records', "
            f"CAST(floor(value) AS BIGINT) * 100000000, 'failed_records', {k} % 7), "
            f"json_object('name', 'valid_type', 'dataset', {ds}, 'passed_records', CAST(event_id % 100 AS INTEGER), "
            f"'failed_records', {k} % 3))")
    progress = (f"json_object('flow_progress', json_object('status', 'COMPLETED', 'data_quality', "
                f"json_object('dropped_records', {k}, 'expectations', "
                f"CASE WHEN event_type = 'purchase' AND event_id % 7 = 0 THEN json_array() ELSE {exps} END)))")
    failed = "json_object('flow_progress', json_object('status', 'FAILED'))"
    definition = (f"json_object('flow_definition', json_object('output_dataset', {ds}, 'input_datasets', "
                  f"json_array('src_' || CAST(event_id % 3 AS VARCHAR), 'src_common'), 'flow_type', "
                  f"CASE WHEN event_id % 2 = 0 THEN 'merge' ELSE 'append' END, 'schema', "
                  f"json_array(json_object('name', 'value', 'data_type', 'DOUBLE'), "
                  f"json_object('name', 'event_type', 'data_type', 'STRING'))))")
    create = "json_object('create_update', json_object('cause', 'USER_ACTION'))"
    return f"""SELECT ts AS "timestamp",
  CASE WHEN event_type = 'signup' THEN 'create_update' WHEN event_type = 'view' THEN 'flow_definition'
       ELSE 'flow_progress' END AS event_type,
  'pipe_' || CAST(user_id % 3 AS VARCHAR) AS pipeline_id,
  'upd_' || CAST(user_id % 20 AS VARCHAR) AS update_id,
  CAST(CASE WHEN event_type = 'signup' THEN {create} WHEN event_type = 'view' THEN {definition}
       WHEN event_type = 'error' THEN {failed} ELSE {progress} END AS VARCHAR) AS details
FROM events"""
