"""Table scans, listings and the lakehouse layout (layers, external tables, properties).

Tables are external Parquet tables whose files live under the lakehouse root (a folder
on the shared file system, by default below ``spark.checkpoint.dir``), registered in
Spark's catalog so they can be read by name, by SQL, or as a stream.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from levain.session import shared_dir
from levain.sources.versions import Versions

LAYERS = ("bronze", "silver", "gold")
_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _check(name: str) -> str:
    for part in name.split("."):
        if not _NAME.match(part):
            raise ValueError(f"invalid identifier {name!r}")
    return name


def substitute(sql: str, params: dict[str, str]) -> str:
    """Replace ``${name}`` placeholders (environment catalog, paths) in SQL text."""
    def rep(m):
        key = m.group(1)
        if key not in params:
            raise KeyError(f"no value for ${{{key}}}")
        return params[key]
    return re.sub(r"\$\{([A-Za-z_][A-Za-z0-9_]*)\}", rep, sql)


class Lakehouse:
    """Databases per layer, with a prefix per environment (``dev_bronze``, ``prod_gold``)."""

    def __init__(self, spark: SparkSession, catalog: str = "dev", root: str | None = None):
        self.spark = spark
        self.catalog = _check(catalog)
        self.root = (root or shared_dir(spark, "lakehouse", catalog)).rstrip("/")

    def database(self, layer: str) -> str:
        return f"{self.catalog}_{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{_check(table)}"

    def location(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def setup(self) -> list[str]:
        """CREATE DATABASE IF NOT EXISTS for every layer; a volume is a folder under the root."""
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} "
                           f"LOCATION '{self.root}/{layer}'")
        return [self.database(layer) for layer in LAYERS]

    def volume(self, name: str) -> str:
        return shared_dir(self.spark, "lakehouse", self.catalog, "volumes", name)

    def drop(self, layer: str, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")

    def teardown(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    # ------------------------------------------------------------------ datasets
    def materialized_view(self, layer: str, table: str, df: DataFrame, comment: str | None = None,
                          properties: dict | None = None, expectations=None, event_log=None,
                          update_id: str | None = None) -> DataFrame:
        """Full recompute into a new folder; then the table is switched to it, and comment / properties are set.

        Until the switch (one change of the table's location) readers see the old rows, and a refresh that breaks off leaves
        them; the folder before is kept for readers that are under way, older ones are removed.  Where the
        columns changed, the table is registered anew.

        With ``expectations``, drop / fail rules are enforced inside the write and every rule's
        counts are observed on that same write (no extra pass); with ``event_log`` they are
        appended as a ``flow_progress`` event of ``update_id``.
        """
        name = self.name(layer, table)
        obs = None
        if expectations is not None:
            df, obs = expectations.observe(df)
            df = expectations.apply(df)
        versions = Versions(self.spark, self.location(layer, table))
        folder = versions.new_folder()
        df.write.parquet(folder)
        versions.commit({"version": versions.current()["version"] + 1, "tables": {"rows": [folder]}})
        self._switch(name, folder, df)
        versions.vacuum(keep=2)
        self.set_properties(layer, table, comment, properties)
        if obs is not None and event_log is not None:
            event_log.flow_progress(update_id or "manual", expectations.observed_metrics(obs))
        return self.spark.read.table(name)

    def _switch(self, name: str, folder: str, df: DataFrame) -> None:
        """Let the table's name stand for the files in ``folder``."""
        same = self.spark.catalog.tableExists(name) and [(f.name, f.dataType) for f in self.spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema]
        if same:
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.catalog.createTable(name, folder, "parquet")

    def register_parquet(self, layer: str, table: str, path: str) -> str:
        """Expose existing Parquet files as a table (no copy)."""
        name = self.name(layer, table)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        return name

    def streaming_table(self, layer: str, table: str, stream: DataFrame, checkpoint: str | None = None,
                        comment: str | None = None, properties: dict | None = None) -> StreamingQuery:
        """Append-only streaming table: process what is new, then stop (availableNow)."""
        name = self.name(layer, table)
        ckpt = checkpoint or shared_dir(self.spark, "checkpoints", self.catalog, layer, table)
        q = (stream.writeStream.format("parquet").option("checkpointLocation", ckpt)
             .option("path", self.location(layer, table)).trigger(availableNow=True).toTable(name))
        q.awaitTermination()
        self.set_properties(layer, table, comment, properties)
        return q

    def set_properties(self, layer: str, table: str, comment: str | None = None,
                       properties: dict | None = None) -> None:
        name = self.name(layer, table)
        if comment is not None:
            self.spark.sql(f"COMMENT ON TABLE {name} IS '{comment.replace(chr(39), chr(39) * 2)}'")
        if properties:
            kv = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
            self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({kv})")

    def properties(self, layer: str, table: str) -> DataFrame:
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}")

    def list_tables(self, layer: str) -> DataFrame:
        return self.spark.sql(f"SHOW TABLES IN {self.database(layer)}")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(_check(name))


def scan_stream_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(_check(name))


def preview(spark: SparkSession, name: str, n: int = 20) -> DataFrame:
    """``SELECT * FROM t`` for a look at the data (the limit is the feature here)."""
    return spark.read.table(_check(name)).limit(n)
