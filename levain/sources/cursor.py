"""Cursor-based incremental ingest of a database table into an SCD1 / SCD2 target.

Each run reads the rows whose cursor column (``updated_at``) is at or after the stored
high-water mark — the predicate is pushed down to the source (a JDBC ``WHERE``) — and
applies them to a :class:`~levain.streaming.cdc_target.CdcTarget` keyed on the table's
primary key.  ``>=`` instead of ``>`` keeps rows that share the high-water timestamp but
arrived after the previous read; rows already applied are dropped by the target (their
sequence is not newer than the key's last one), so re-reading them is harmless.

For JDBC, the read is split into ``num_partitions`` ranges of a numeric column, with the
bounds taken from one pushed-down ``min/max`` query — no single-connection full scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from levain.sources.versions import Versions
from levain.streaming.cdc_target import CdcTarget


def jdbc_source(spark: SparkSession, url: str, table: str, properties: dict | None = None,
                partition_column: str | None = None, num_partitions: int = 8) -> Callable[[str, object], DataFrame]:
    """A source function ``(cursor, high_water) -> DataFrame`` reading ``table`` over JDBC."""
    props = dict(properties or {})

    def base() -> DataFrame:
        return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**props).load()

    def read(cursor: str, high_water) -> DataFrame:
        if partition_column is None:
            df = base()
            return df if high_water is None else df.filter(F.col(cursor) >= F.lit(high_water))
        rows = base() if high_water is None else base().filter(F.col(cursor) >= F.lit(high_water))
        bounds = rows.agg(F.min(partition_column), F.max(partition_column)).first()  # pushed down
        if bounds is None or bounds[0] is None:
            return base().limit(0)
        df = (spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**props)
              .option("partitionColumn", partition_column).option("lowerBound", str(bounds[0]))
              .option("upperBound", str(bounds[1])).option("numPartitions", str(num_partitions)).load())
        return df if high_water is None else df.filter(F.col(cursor) >= F.lit(high_water))
    return read


def table_source(read_table: Callable[[], DataFrame]) -> Callable[[str, object], DataFrame]:
    """Same contract over any DataFrame source (a catalog or Parquet table)."""
    def read(cursor: str, high_water) -> DataFrame:
        df = read_table()
        return df if high_water is None else df.filter(F.col(cursor) >= F.lit(high_water))
    return read


class CursorIngest:
    """Incremental loads of ``source`` into ``target`` by the column ``cursor``.

    ``look_back`` (an interval such as ``"2 hours"``; for numeric cursors a number) widens each window below the last mark, for
    rows that a longer transaction committed after a load had passed their cursor value.  Rows in the overlap that were
    applied before are told apart by the target's state: not newer than their key's last sequence.

    A row without a cursor value belongs to no window.  Every load looks for such rows: ``null_cursor="fail"`` refuses the load
    by name, ``"quarantine"`` keeps them in ``quarantine`` (the table as of the newest load, so a row that got a value leaves it).
    """

    def __init__(self, spark: SparkSession, source: Callable[[str, object], DataFrame], cursor: str, target: CdcTarget, state_path: str,
                 look_back: str | float | None = None, null_cursor: str = "fail", quarantine: str | None = None):
        if null_cursor not in ("fail", "quarantine") or (null_cursor == "quarantine") != (quarantine is not None):
            raise ValueError("null_cursor is 'fail', or 'quarantine' with a quarantine path")
        self.spark, self.source, self.cursor, self.target = spark, source, cursor, target
        self.state_path = state_path.rstrip("/")
        self.look_back, self.quarantine = look_back, quarantine

    def _below(self, low, kind):
        """The window's lower end: the last mark, less the look-back."""
        if low is None or self.look_back is None:
            return low
        back = F.lit(low).cast(kind) - (F.expr(f"INTERVAL {self.look_back}") if isinstance(self.look_back, str) else F.lit(self.look_back))
        return self.spark.range(1).select(back.cast(kind)).first()[0]

    def _set_aside(self) -> None:
        """Refuse or keep the rows without a cursor value (a pushed-down IS NULL)."""
        missing = self.source(self.cursor, None).filter(F.col(self.cursor).isNull())
        if self.quarantine is not None:
            missing = missing.withColumn("quarantine_reason", F.lit(f"{self.cursor} IS NULL"))
            versions = Versions(self.spark, self.quarantine)
            folder = versions.new_folder()
            missing.write.parquet(folder)
            versions.commit({"version": versions.current()["version"] + 1, "tables": {"rows": [folder]}})
            versions.vacuum()
        elif missing.limit(1).count():
            raise ValueError(f"rows with a NULL cursor value {self.cursor!r}: they belong to no load")

    def quarantined(self) -> DataFrame:
        """The rows without a cursor value, as of the newest load."""
        return self.spark.read.parquet(*Versions(self.spark, self.quarantine).current()["tables"]["rows"])

    def _state(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.state_path)
        except AnalysisException:
            return None

    def high_water(self):
        """(newest mark, last run) of the finished loads."""
        state = self._state()
        if state is None:
            return None, -1
        done = state.filter("done").agg(F.max("high_water"), F.max("run")).first()
        return done[0], -1 if done[1] is None else done[1]

    def _record(self, run: int, low, high, kind, done: bool) -> None:
        row = self.spark.range(1).select(F.lit(run).alias("run"), F.lit(low).cast(kind).alias("low_water"),
                                         F.lit(high).cast(kind).alias("high_water"), F.lit(done).alias("done"))
        row.coalesce(1).write.mode("append").parquet(self.state_path)

    def run(self) -> int:
        """One incremental load; returns the run number.

        The window [last mark, newest cursor value] is fixed and recorded before any row is read, so rows
        that arrive meanwhile belong to the next run, and a run that broke off is repeated over its own window."""
        low, last_run = self.high_water()
        run, state = last_run + 1, self._state()
        open_ = None if state is None else state.filter((F.col("run") == run) & ~F.col("done")).first()
        self._set_aside()
        kind = self.source(self.cursor, None).schema[self.cursor].dataType
        rows = self.source(self.cursor, self._below(low, kind))
        if open_ is not None:
            high = open_["high_water"]
        else:
            high = rows.agg(F.max(self.cursor)).first()[0]  # one value, pushed down
            high = low if high is None else high
            self._record(run, low, high, kind, False)
        within = F.col(self.cursor) <= F.lit(high).cast(kind) if high is not None else F.lit(False)
        self.target.apply(rows.filter(within), run)
        self._record(run, low, high, kind, True)
        return run
