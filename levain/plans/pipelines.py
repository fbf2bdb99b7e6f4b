"""The reference's two file-driven flows, end to end on Structured Streaming.

suppliers: CSV files -> bronze (file stream, addNewColumns) -> cleaned (trim) ->
           quarantine (NULL ids, append) and silver (drop rule, SCD2 by foreachBatch) -> gold dim
franchises: CSV files -> bronze (file stream, rescue) -> silver (drop / warn / fail rules, SCD2)
            -> gold dim

Every stream runs with ``availableNow``: it processes what is new and stops, so a run is
one pipeline update.  Each update writes ``create_update``, one ``flow_definition`` per
flow and a ``flow_progress`` row per committed micro-batch with its expectation counts to
the event log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.operators.cdc import CdcSpec
from levain.operators.expectations import Expectations
from levain.plans import sales
from levain.plans.eventlog import EventLog
from levain.sources import fs
from levain.sources.files import BATCH_COLUMNS, FileIngest
from levain.streaming.cdc_target import CdcTarget

# Reader options of the reference's CSV streams.
CSV_OPTIONS = {
    "header": "true", "delimiter": ",", "quote": '"', "escape": "\\", "encoding": "UTF-8", "lineSep": "\n",
    "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd HH:mm:ss", "nullValue": "",
    "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
}

#: A target with more folders than this is compacted at the end of an update.
COMPACT_FOLDERS = 64


class FilePipeline:
    """bronze file ingest -> streamed bronze -> (clean) -> expectations -> SCD2 silver -> gold."""

    def __init__(self, spark: SparkSession, root: str, name: str, source_glob: str, spec: CdcSpec,
                 rules: Expectations, evolution_mode: str, schema_hints: str | None = None,
                 clean=None, quarantine_rule: str | None = None, max_files_per_trigger: int | None = None,
                 max_bytes_per_trigger: str | None = None, max_file_age: str | None = None,
                 event_log: EventLog | None = None):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.rules, self.clean, self.quarantine_rule = rules, clean, quarantine_rule
        self.log, self.spec = event_log, spec
        self.ingest_args = dict(path=source_glob, options=CSV_OPTIONS, evolution_mode=evolution_mode, schema_hints=schema_hints,
                                max_files_per_trigger=max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger,
                                max_file_age=max_file_age)
        self._use(self._version())
        self._update = None

    def _version(self) -> int:
        """How often the pipeline was fully refreshed: each refresh leaves a marker when it is complete."""
        n = 0
        while fs.exists(self.spark, f"{self.root}/_refreshed/{self.name}/{n + 1}"):
            n += 1
        return n

    def _use(self, version: int) -> None:
        """Tables, schema and checkpoints of one version of the pipeline."""
        self.version = version
        self.base = f"{self.root}/_refreshed/{self.name}_v{version}" if version else self.root
        self.bronze = FileIngest(
            self.spark, target=f"{self.base}/bronze/{self.name}_raw", checkpoint=f"{self.base}/_checkpoints/{self.name}_raw",
            schema_location=f"{self.base}/_schemas/{self.name}", **self.ingest_args)
        self.silver = CdcTarget(self.spark, f"{self.base}/silver/{self.name}", self.spec,
                                expectations=self.rules)

    def full_refresh(self, update_id: str | None = None) -> str:
        """Rebuild everything from the files: a new version with a new schema, new checkpoints and new tables.  Readers
        of a new pipeline object see it once it is complete; a refresh that breaks off leaves the version before."""
        before = self.version
        if fs.exists(self.spark, f"{self.root}/_refreshed/{self.name}_v{before + 1}"):  # of a refresh that broke off
            fs.remove(self.spark, f"{self.root}/_refreshed/{self.name}_v{before + 1}")
        try:
            self._use(before + 1)
            done = self.run(update_id)
        except Exception:
            self._use(before)
            raise
        fs.touch(self.spark, f"{self.root}/_refreshed/{self.name}/{before + 1}")
        return done

    def _log_counts(self) -> None:
        """Append the counts of every committed batch that the log lacks: they come from the commits themselves, so a batch that
        broke off has none, and one whose update broke off before this line is logged by the next."""
        if self.log is not None:
            for version, _, records in self.silver.batch_metrics(self.log.logged_version(self.silver.path)):
                self.log.flow_progress(self._update, records, target=self.silver.path, version=version)

    def _bronze_stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.bronze.bronze_schema()).parquet(self.bronze.target)

    def run(self, update_id: str | None = None) -> str:
        """One pipeline update: every flow processes what is new, then stops."""
        self._update = update_id or uuid.uuid4().hex[:12]
        if self.log is not None:
            self.log.create_update(self._update)
        self.bronze.run()
        stream = self._bronze_stream()
        cleaned = self.clean(stream) if self.clean else stream
        if self.quarantine_rule:
            q = (stream.filter(self.quarantine_rule)
                 .withColumn("quarantine_reason", F.lit(self.quarantine_rule))
                 .withColumn("quarantine_timestamp", F.current_timestamp())
                 .writeStream.format("parquet").option("checkpointLocation",
                                                       f"{self.base}/_checkpoints/{self.name}_quarantine")
                 .trigger(availableNow=True).start(f"{self.base}/bronze/{self.name}_invalid"))
            q.awaitTermination()
        self.silver.stream_into(cleaned, f"{self.base}/_checkpoints/{self.name}_cdc").awaitTermination()
        self._log_counts()
        if self.silver.folders() > COMPACT_FOLDERS:
            self.silver.compact()
            self.silver.versions.vacuum()
        if self.log is not None:
            self.log.flow_definition(self._update, f"silver.{self.name}", [f"bronze.{self.name}_raw"], "cdc",
                                     self.silver.read().schema)
        return self._update

    def silver_table(self) -> DataFrame:
        return self.silver.read()

    def quarantine_table(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/bronze/{self.name}_invalid")


def supplier_pipeline(spark: SparkSession, root: str, source_glob: str, event_log: EventLog | None = None) -> FilePipeline:
    spec = CdcSpec(keys=("supplierID",), sequence_by="file_timestamp",
                   except_columns=("file_timestamp", "_rescued_data", *BATCH_COLUMNS))
    return FilePipeline(spark, root, "suppliers", source_glob, spec, sales.SUPPLIER_RULES, "addNewColumns",
                        schema_hints="supplierID BIGINT", clean=sales.clean_suppliers,
                        quarantine_rule="supplierID IS NULL", max_files_per_trigger=1000,
                        max_bytes_per_trigger="10g", max_file_age="365 days", event_log=event_log)


def franchise_pipeline(spark: SparkSession, root: str, source_glob: str, event_log: EventLog | None = None) -> FilePipeline:
    spec = CdcSpec(keys=("franchiseID",), sequence_by="file_timestamp",
                   except_columns=("file_timestamp", "_rescued_data", *BATCH_COLUMNS))
    return FilePipeline(spark, root, "franchises", source_glob, spec, sales.FRANCHISE_RULES, "rescue",
                        schema_hints="franchiseID BIGINT, zipcode STRING", event_log=event_log)


# ---------------------------------------------------------------------------------------
# the batch side: database bronze -> silver views -> gold views, one pipeline update
# ---------------------------------------------------------------------------------------
def refresh_gold(spark: SparkSession, sf_dir: str, lakehouse, event_log: EventLog | None = None,
                 update_id: str | None = None) -> dict[str, str]:
    """Materialize the silver and gold datasets in dependency order (one update).

    Each dataset is a full-recompute view whose expectations are enforced and counted in
    the same write; later datasets read the stored tables, as the reference's views do.
    Returns dataset -> table name.
    """
    from levain.plans import analogs, chain

    update = update_id or uuid.uuid4().hex[:12]
    if event_log is not None:
        event_log.create_update(update)
    lh = lakehouse
    done: dict[str, str] = {}

    def mv(layer, table, df, rules=None, inputs=()):
        out = lh.materialized_view(layer, table, df, properties={"quality": layer.capitalize()},
                                   expectations=rules, event_log=event_log, update_id=update)
        if event_log is not None:
            event_log.flow_definition(update, f"{layer}.{table}", list(inputs), "materialized_view", out.schema)
        done[table] = lh.name(layer, table)
        return out

    # silver customers: the projection first, the (warn) rules on its output columns
    cust = sales.silver_customers(chain.bronze_customers(spark, sf_dir), Expectations([], "c"))
    cust = mv("silver", "sales_customers_silver", cust, sales.CUSTOMER_RULES, ["bronze.sales_customers"])
    tx = mv("silver", "sales_transactions_silver",
            sales.silver_transactions_projection(analogs.transaction_lines(spark, sf_dir)),
            sales.TRANSACTION_RULES, ["bronze.sales_transactions"])
    dim_c = mv("gold", "dim_customer_gold", sales.dim_customer(cust), inputs=["silver.sales_customers_silver"])
    dim_f = mv("gold", "dim_franchise_gold", chain.dim_franchise(spark, sf_dir), inputs=["silver.franchises_silver"])
    fact = mv("gold", "fact_transactions_sales_gold", sales.fact_sales(tx), inputs=["silver.sales_transactions_silver"])
    mv("gold", "fact_transactions_sales_denormalized_gold", sales.denormalized_sales(fact, dim_c, dim_f),
       inputs=["gold.fact_transactions_sales_gold", "gold.dim_customer_gold", "gold.dim_franchise_gold"])
    return done
