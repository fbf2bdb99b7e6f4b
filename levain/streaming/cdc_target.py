"""An updatable SCD1 / SCD2 target on plain Parquet, log-structured: a batch of k keys writes rows for those keys only.

Every batch writes one new folder and commits a manifest that names it (see ``sources.versions``): readers see whole
batches, a replayed batch is a no-op, one that breaks off leaves the version before.  Nothing is
rewritten in place.  What a batch writes:

* SCD1 — the newest event of each of its keys.  Reading takes each key's newest by (sequence, tie hash); a delete hides
  the key, and so does a remembered truncate at or after it.
* SCD2, ``late="ignore"`` — *closed* versions (appended, never touched again) and the *state* of its keys: the open version,
  one that ended at the key's newest sequence (an event of that sequence with a larger tie hash can still change it), and
  a row with the newest (sequence, tie hash) applied.  The newest state of a key stands.
* SCD2, ``late="merge"`` — its events go to a *log*; then each key's history is respliced where the events fall: from
  the last change before the first of them to the second change after the last of them, which bounds every version they can cut,
  merge or extend.  The versions that started in that interval are *removed* (by key and start), their successors written.

``compact`` merges the folders of a table into one; it is maintenance, never part of a batch.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levain.operators.cdc import (DEL, END_AT, KEY, SEQ, START_AT, TIE, TRUNC, CdcSpec, check_target_schema, prepare_changes,
                                  scd2_from_changes)
from levain.operators.expectations import Expectations
from levain.session import SHUFFLES_REMOVED, settings
from levain.sources import fs
from levain.sources.versions import Versions, has_batch, with_batch

LAST = "__last_seq"
LAST_TIE = "__last_tie"
HEAD = "__head"
GEN = "__gen"
KIND = "__kind"
SIGN = "__sign"
#: Events that one task of a splice takes: so its sorts stay as small as they are when the table grows.
TASK_ROWS = 100_000
#: Up to so many tasks Spark merges shuffle partitions by their bytes.
MERGED_TASKS = 8
CLOSED, STATE, REMOVED, LOG, TRUNCATES = "closed", "state", "removed", "log", "truncates"


class CdcTarget:
    """SCD target at ``path``; ``apply(batch_df, batch_id)`` is the ``foreachBatch`` function."""

    def __init__(self, spark: SparkSession, path: str, spec: CdcSpec, expectations: Expectations | None = None, on_metrics=None, target_schema=None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.spec = spec
        self.expectations = expectations
        self.on_metrics = on_metrics  # callback(batch_id, [expectation records]), after the commit
        self.target_schema = target_schema  # an explicit schema (StructType) that each batch is checked against
        self.versions = Versions(spark, self.path)

    # ------------------------------------------------------------------ public
    def read(self, version: int | None = None, among: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
        """The target as users see it, of the current version or of an earlier one that was not vacuumed; SCD1 keys only
        those in the ``__k`` (struct of the keys) of ``among``, if given; keys and those of ``columns`` that it has, if given."""
        m = self.versions.current() if version is None else self.versions.manifest(version)
        if not m["version"]:
            raise RuntimeError(f"target {self.path} has no committed batch yet")
        if self.spec.stored_as_scd_type == 1:
            return self._scd1(m, among, columns)
        live = self._live(m)
        if self.spec.late == "ignore":
            state = self._state(m).filter(~F.col(HEAD))
            live = live.unionByName(state.select(*live.columns))
        live = live.drop(GEN)
        return live if columns is None else live.select(*self._with_keys(columns, live))

    def stream_into(self, stream_df: DataFrame, checkpoint: str, trigger_available_now: bool = True):
        w = stream_df.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if trigger_available_now else w
        return w.start()

    def apply(self, batch: DataFrame, batch_id: int, one_each: bool = False) -> None:
        """``one_each`` says that the batch has one row for each of its keys (as an aggregate by the keys has): SCD1 then stores
        it as it is, with no search for each key's newest."""
        m = self.versions.current()
        if has_batch(m["batches"], batch_id):
            return  # replayed batch: already published
        if self.target_schema is not None:
            check_target_schema(self.target_schema, self.spec, batch.schema)
        batch, data_cols = self._conform(batch, m)
        obs = None
        if self.expectations is not None:
            batch, obs = self.expectations.observe(batch)
            batch = self.expectations.apply(batch)
        folder = self.versions.new_folder()
        prepared = prepare_changes(batch, self.spec)
        if self.spec.stored_as_scd_type == 1 and self.spec.apply_as_truncates is None and obs is None:
            changes = prepared  # one step reads it, once
        else:  # written once: the counts are observed on that write, and every step below reads the same rows
            _write(prepared, f"{folder}/{LOG}")
            changes = self.spark.read.schema(prepared.schema).parquet(f"{folder}/{LOG}")
        new = {"version": m["version"] + 1, "batches": with_batch(m["batches"], batch_id), "tables": {k: list(v) for k, v in m["tables"].items()},
               "schemas": dict(m["schemas"]), "columns": data_cols, "added": []}
        if obs is not None:
            new["metrics"] = {"batch": batch_id, "expectations": self.expectations.observed_metrics(obs)}
        keep_log, tasks = False, 0
        if self.spec.stored_as_scd_type == 1:
            rows = self._scd1_rows(changes, data_cols, one_each)
        elif self.spec.late == "merge":
            self._name(new, LOG, f"{folder}/{LOG}", prepared.schema)
            tasks = self._tasks(self._table(new, LOG))
            keep_log, rows = True, self._spliced(changes, m, new, data_cols)
        else:
            feed = self._feed(changes, m, data_cols)
            _write(feed, f"{folder}/feed")
            feed = self.spark.read.schema(feed.schema).parquet(f"{folder}/feed")
            tasks = self._tasks(feed)
            rows = self._advanced(feed, data_cols)
        rows = rows.withColumn(GEN, F.lit(new["version"]))
        _write(rows, f"{folder}/rows", KIND, tasks=tasks)
        for kind in (CLOSED, STATE, REMOVED, TRUNCATES):
            found = f"{folder}/rows/{KIND}={kind}"
            there = fs.exists(self.spark, found)
            self._name(new, kind, found if there else None, rows.drop(KIND).schema)
            new["added"] += [found] if there and kind != TRUNCATES else []
        self.versions.commit(new)
        for part in ["feed"] if keep_log else ["feed", LOG]:
            fs.remove(self.spark, f"{folder}/{part}")
        if obs is not None and self.on_metrics is not None:
            self.on_metrics(batch_id, new["metrics"]["expectations"])

    def batch_metrics(self, since: int = 0) -> list[tuple[int, int, list[dict]]]:
        """(version, batch, expectation records) of the batches committed after version ``since``, as their manifests hold them."""
        return [(m["version"], m["metrics"]["batch"], m["metrics"]["expectations"]) for m in self.versions.since(since) if "metrics" in m]

    def changes(self, since: int, upto: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """What changed between two versions, as signed rows (``SIGN`` is how often a row was added, or taken away if negative),
        over ``columns`` (all by default).  Only keys that batches between the two wrote are looked at; both versions must not be vacuumed."""
        now = self.versions.current() if upto is None else self.versions.manifest(upto)
        new = self.read(now["version"], columns=columns)
        columns = columns or new.columns
        if not since:
            return new.select(*columns).withColumn(SIGN, F.lit(1).cast("long"))
        between = [f for m in self.versions.since(since) if m["version"] <= now["version"] for f in m.get("added", [])]
        cut = [f for f in now["tables"].get(TRUNCATES, []) if f not in self.versions.manifest(since)["tables"].get(TRUNCATES, [])]
        if not between and not cut:
            return new.select(*columns).withColumn(SIGN, F.lit(1).cast("long")).limit(0)
        before = self.versions.manifest(since)["tables"].get(STATE, [])
        if self.spec.stored_as_scd_type == 1 and not cut and not now["tables"].get(TRUNCATES) and set(before) <= set(now["tables"][STATE]) and {*self.spec.keys} <= {*columns}:
            return self._scd1_changes(now, before, columns)
        old = self.read(since, columns=columns)
        if not cut:  # else any key may have changed
            schema = new.select(*self.spec.keys).schema
            touched = self.spark.read.schema(schema).parquet(*between).select(self._key().alias("__k")).distinct()
            old, new = (df.join(touched, self._key() == F.col("__k"), "left_semi") for df in (old, new))
        gained = {c: F.lit(None).cast(new.schema[c].dataType) for c in columns if c not in old.columns}
        both = new.select(*columns, F.lit(1).cast("long").alias(SIGN)).unionByName(old.withColumns(gained).select(*columns, F.lit(-1).cast("long").alias(SIGN)))
        return both.groupBy(*columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)

    def _scd1_changes(self, now: dict, before: list[str], columns: list[str]) -> DataFrame:
        """The signed rows in one shuffle of the stored rows: each key's newest row in the folders ``before`` and now, where they differ."""
        keys, at, row = list(self.spec.keys), F.struct(SEQ, TIE), F.struct(DEL, *(c for c in columns if c not in self.spec.keys))
        since = [f for f in now["tables"][STATE] if f not in before]
        if len(since) == 1:  # its keys are what changed: rows of other keys are dropped before the newest are taken
            both = self._beside(self._table(now, STATE, since).select(*keys, at.alias("__at"), row.alias("__r")), now, before, [c for c in columns if c not in keys])
            both = both.filter(F.col("__at").isNull() | (F.col("__new.__at") > F.col("__at"))).select("__k.*", F.col("__new.__r").alias("__new"), "__old")
        else:
            parts = [self._table(now, STATE, folders).select(*keys, at.alias("__at"), row.alias("__r"), F.lit(late).alias("__late")) for folders, late in ((before, False), (since, True))]
            rows, early = parts[0].unionByName(parts[1]).repartition(*keys), F.when(~F.col("__late"), F.col("__at"))
            both = rows.groupBy(*keys).agg(F.max_by("__r", "__at").alias("__new"), F.max_by("__r", early).alias("__old"), F.max("__late").alias("__late")).filter("__late")
        both = both.filter(~F.col("__new").eqNullSafe(F.col("__old")))
        signed = F.array(*(F.struct(F.col(c).alias("__r"), F.lit(n).cast("long").alias(SIGN)) for c, n in (("__new", 1), ("__old", -1))))
        signed = both.select(*keys, F.inline(signed)).filter(~F.col(f"__r.{DEL}"))
        return signed.select(*(F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in columns), SIGN)

    def stored(self, version: int, columns: list[str] | None = None) -> DataFrame:
        """Every row that an SCD1 target holds, newest of its key or not, deletes too: its keys and ``columns`` (all by default)."""
        m = self.versions.manifest(version)
        rows = self._table(m, STATE)
        return rows.select(*self._with_keys(columns or m["columns"], rows))

    def beside(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """``rows``, one for each key, each with the stored ``columns`` of its key in a struct ``__old``: NULL where SCD1 has no such
        key, and a column where the target lacks it."""
        m = self.versions.current()
        both = self._beside(rows, m, m["tables"].get(STATE, []), columns)
        return both.select("__k.*", "__new.*", F.when(~F.col(f"__old.{DEL}"), F.col("__old")).alias("__old"))

    def _beside(self, rows: DataFrame, m: dict, folders: list[str], columns: list[str]) -> DataFrame:
        """``rows``, one for each key (``__k``; the rest is in ``__new``), with the key's newest row of ``folders`` (``__at``, ``__old``).
        Rows and stored rows are dealt out once; stored rows of other keys go before the newest are taken."""
        new = rows.select(self._key().alias("__k"), F.struct(*(c for c in rows.columns if c not in self.spec.keys)).alias("__new"))
        old = self._table(m, STATE, folders)
        old = old.select(self._key().alias("__j"), F.struct(SEQ, TIE).alias("__at"), F.struct(DEL, *(F.col(c) if c in old.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in columns)).alias("__old"))
        both = new.join(old, F.col("__k") == F.col("__j"), "left")
        if len(folders) > 1:  # a folder has a key once
            both = both.groupBy("__k").agg(F.first("__new").alias("__new"), F.max_by("__old", "__at").alias("__old"), F.max("__at").alias("__at"))
        return both

    def folders(self) -> int:
        """The most folders that any table has."""
        return max((len(x) for x in self.versions.current()["tables"].values()), default=0)

    def compact(self) -> None:
        """Merge the folders of each table into one, as a new version."""
        m = self.versions.current()
        if not m["version"]:
            return
        folder = self.versions.new_folder()
        new = {**m, "version": m["version"] + 1, "tables": {}, "schemas": dict(m["schemas"])}
        for once in ("metrics", "added"):
            new.pop(once, None)
        if self.spec.stored_as_scd_type == 1:
            tables = {STATE: self._newest_rows(m), TRUNCATES: self._table(m, TRUNCATES)}
        elif self.spec.late == "merge":
            log = self._table(m, LOG)
            tables = {CLOSED: self._live(m), LOG: None if log is None else log.dropDuplicates([*self.spec.keys, SEQ, TIE])}
        else:
            tables = {CLOSED: self._table(m, CLOSED), STATE: self._state(m)}
        for name, df in tables.items():
            if df is not None:
                _write(df, f"{folder}/{name}")
                self._name(new, name, f"{folder}/{name}", df.schema)
        self.versions.commit(new)

    def _tasks(self, events: DataFrame) -> int:
        """Tasks for stored events, by their number (from the files' footers)."""
        return -(-events.count() // TASK_ROWS)

    # ------------------------------------------------------------------ tables
    def _name(self, m: dict, table: str, folder: str | None, schema: T.StructType) -> None:
        """List ``folder``, if there is one, in a manifest; the table's schema gains its columns."""
        if folder:
            m["tables"].setdefault(table, []).append(folder)
        old = T.StructType.fromJson(_json(m["schemas"][table])) if table in m["schemas"] else T.StructType([])
        have = {f.name.lower() for f in old.fields}
        m["schemas"][table] = T.StructType([*old.fields, *(f for f in _nullable(schema) if f.name.lower() not in have)]).json()

    def _table(self, m: dict, table: str, folders: list[str] | None = None) -> DataFrame | None:
        """The rows of all of a table's folders, or of ``folders`` alone; None where it has no schema yet."""
        if table not in m["schemas"]:
            return None
        schema = T.StructType.fromJson(_json(m["schemas"][table]))
        folders = m["tables"].get(table, []) if folders is None else folders
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _key(self) -> Column:
        """The keys as one value that equals itself where parts are NULL."""
        return F.struct(*self.spec.keys)

    def _with_keys(self, columns: list[str], df: DataFrame) -> list[str]:
        """The keys and those of ``columns`` that ``df`` has."""
        keys, have = {k.lower() for k in self.spec.keys}, {c.lower() for c in df.columns}
        return [*self.spec.keys, *(c for c in columns if c.lower() in have - keys)]

    def _conform(self, batch: DataFrame, m: dict) -> tuple[DataFrame, list[str]]:
        """The batch with every data column that the target has (NULL where the batch lacks it), and their names."""
        now = self.spec.data_columns(batch.columns)
        low = {c.lower() for c in now}
        known = {f.name: f.dataType for f in T.StructType.fromJson(_json(m["schemas"][STATE])).fields} if STATE in m["schemas"] else {}
        for c in now:
            stored = next((t for k, t in known.items() if k.lower() == c.lower()), None)
            if stored is not None and stored.simpleString() != batch.schema[c].dataType.simpleString():
                raise ValueError(f"column {c} is {batch.schema[c].dataType.simpleString()} in this batch, {stored.simpleString()} in the target {self.path}")
        gone = [c for c in m.get("columns", []) if c.lower() not in low]
        return batch.withColumns({c: F.lit(None).cast(known[c]) for c in gone}) if gone else batch, [*(c for c in m.get("columns", []) if c in gone), *now] if gone else now

    # ------------------------------------------------------------------ SCD1
    def _scd1_rows(self, changes: DataFrame, data_cols: list[str], one_each: bool) -> DataFrame:
        payload = [*data_cols, DEL, SEQ, TIE]
        latest = changes.filter(~F.col(TRUNC))
        if not one_each:
            latest = latest.groupBy(*self.spec.keys).agg(F.max_by(F.struct(*payload), F.struct(SEQ, TIE)).alias("__r")).select(*self.spec.keys, "__r.*")
        rows = latest.select(*self.spec.keys, *payload).withColumn(KIND, F.lit(STATE))
        if self.spec.apply_as_truncates is None:
            return rows
        cut = changes.filter(TRUNC).agg(F.max(SEQ).alias(SEQ)).filter(F.col(SEQ).isNotNull()).withColumn(KIND, F.lit(TRUNCATES))
        return rows.unionByName(cut, allowMissingColumns=True)

    def _newest_rows(self, m: dict, among: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
        rows = self._table(m, STATE)
        if columns is not None:
            rows = rows.select(*self._with_keys(columns, rows), DEL, SEQ, TIE)
        if among is not None:  # before the newest are taken, so that only these keys' rows are dealt again
            rows = rows.join(among.select("__k"), self._key() == F.col("__k"), "left_semi")
        if len(m["tables"].get(STATE, [])) < 2:
            return rows
        rest = [c for c in rows.columns if c not in self.spec.keys]
        # a folder has a key once: to find the newest before the shuffle would only sort the rows once more
        return rows.repartition(*self.spec.keys).groupBy(*self.spec.keys).agg(F.max_by(F.struct(*rest), F.struct(SEQ, TIE)).alias("__r")).select(*self.spec.keys, "__r.*")

    def _scd1(self, m: dict, among: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
        rows = self._newest_rows(m, among, columns).filter(~F.col(DEL))
        if m["tables"].get(TRUNCATES):
            last = self._table(m, TRUNCATES).agg(F.max(SEQ)).scalar()
            rows = rows.filter(F.col(SEQ) > last)
        return rows.drop(DEL, SEQ, TIE, GEN)

    # ------------------------------------------------------------------ SCD2, late events ignored
    def _state(self, m: dict) -> DataFrame | None:
        """The newest state rows of each key."""
        rows = self._table(m, STATE)
        if rows is None or len(m["tables"].get(STATE, [])) < 2:
            return rows
        return rows.withColumn("__newest", F.max(GEN).over(Window.partitionBy(self._key()))).filter(F.col(GEN) == F.col("__newest")).drop("__newest")

    def _feed(self, changes: DataFrame, m: dict, data_cols: list[str]) -> DataFrame:
        """The batch's events that are newer than what was applied to their keys, and the stored state of these keys as events of
        its own: each pending version as a start and an end, each head as a row with ``LAST`` alone."""
        keys, cols = list(self.spec.keys), [*self.spec.keys, *data_cols]
        nothing = [F.lit(None).cast(t).alias(c) for c, t in ((LAST, changes.schema[SEQ].dataType), (LAST_TIE, T.LongType()))]
        state = self._state(m)
        if state is None:
            return changes.select(*cols, SEQ, DEL, TRUNC, TIE, *nothing)
        new = changes.withColumn(KEY, self._key())
        gained = {c: F.lit(None).cast(changes.schema[c].dataType) for c in data_cols if c not in state.columns}
        touched = state.withColumns({**gained, KEY: self._key()}).join(new.select(KEY).distinct(), KEY, "left_semi")
        heads = touched.filter(HEAD).select(F.col(KEY).alias("__k"), LAST, LAST_TIE)
        later = F.col(LAST).isNull() | (F.col(SEQ) > F.col(LAST)) | ((F.col(SEQ) == F.col(LAST)) & (F.col(TIE) > F.col(LAST_TIE)))
        new = new.join(heads, F.col(KEY) == F.col("__k"), "left").filter(later).select(*cols, SEQ, DEL, TRUNC, TIE, *nothing)

        def event(at: Column, deleted: bool, tie: int) -> Column:
            return F.struct(at.alias(SEQ), F.lit(deleted).alias(DEL), F.lit(False).alias(TRUNC), F.lit(tie).cast("long").alias(TIE))

        # stored rows lose ties against events that came later; of an end and a start at one place the start stands
        parts = F.filter(F.array(event(F.col(START_AT), False, -2**63 + 1), event(F.col(END_AT), True, -2**63)), lambda e: F.col(HEAD) | e[SEQ].isNotNull())
        parts = F.when(F.col(HEAD), F.slice(parts, 1, 1)).otherwise(parts)
        return new.unionByName(touched.select(*keys, *data_cols, LAST, LAST_TIE, HEAD, F.inline(parts)).select(
            *cols, SEQ, DEL, TRUNC, TIE, *(F.when(F.col(HEAD), F.col(c)).alias(c) for c in (LAST, LAST_TIE))))

    def _advanced(self, feed: DataFrame, data_cols: list[str]) -> DataFrame:
        """Closed versions and state of the keys in ``feed``."""
        stored = F.col(TIE) <= -2**63 + 1
        applied = F.when(F.col(LAST).isNotNull(), F.struct(F.col(LAST), F.col(LAST_TIE))).when(~stored, F.struct(F.col(SEQ).alias(LAST), F.col(TIE).alias(LAST_TIE)))
        last = feed.groupBy(self._key().alias("__k")).agg(F.max(applied).alias("__m")).select("__k", "__m.*")
        versions = scd2_from_changes(feed.filter(F.col(SEQ).isNotNull()), self.spec, data_cols)
        versions = versions.join(last, self._key() == F.col("__k"))
        settled = F.col(END_AT).isNotNull() & (F.col(END_AT) < F.col(LAST))
        versions = versions.select(*self.spec.keys, *data_cols, START_AT, END_AT, LAST, LAST_TIE, F.lit(False).alias(HEAD), F.when(settled, CLOSED).otherwise(STATE).alias(KIND))
        tops = last.select(*[F.col(f"__k.{k}").alias(k) for k in self.spec.keys], LAST, LAST_TIE, F.lit(True).alias(HEAD), F.lit(STATE).alias(KIND))
        return versions.unionByName(tops, allowMissingColumns=True)

    # ------------------------------------------------------------------ SCD2, late events spliced in
    def _live(self, m: dict) -> DataFrame:
        """Closed versions (with ``late="merge"`` all versions) that no later batch removed."""
        cols = [*self.spec.keys, *m["columns"], START_AT, END_AT, GEN]
        rows = self._table(m, CLOSED).select(*cols)
        if not m["tables"].get(REMOVED):
            return rows
        gone = self._table(m, REMOVED).select(self._key().alias("__k"), F.col(START_AT).alias("__s"), F.col(GEN).alias("__g"))
        same = (self._key() == F.col("__k")) & (F.col(START_AT) == F.col("__s")) & (F.col("__g") > F.col(GEN))
        return rows.join(gone, same, "left_anti")

    def _spliced(self, changes: DataFrame, m: dict, new: dict, data_cols: list[str]) -> DataFrame:
        """The versions of the intervals that the batch's events fall into, and the starts they replace."""
        keys = list(self.spec.keys)
        touched = changes.groupBy(self._key().alias("__k")).agg(F.min(SEQ).alias("__first"), F.max(SEQ).alias("__final"))
        if CLOSED in m["schemas"]:
            old = self._live(m).select(*keys, START_AT, END_AT).withColumn(KEY, self._key()).join(touched, F.col(KEY) == F.col("__k")).drop("__k")
            edges = old.select(KEY, "__first", "__final", F.explode(F.array(START_AT, END_AT)).alias("__at")).filter("__at IS NOT NULL").distinct()
            edges = edges.withColumn("__then", F.lead("__at").over(Window.partitionBy(KEY).orderBy("__at")))
            edges = edges.groupBy(KEY).agg(F.max(F.when(F.col("__at") < F.col("__first"), F.col("__at"))).alias("__low"),
                                           F.min_by("__then", F.when(F.col("__at") > F.col("__final"), F.col("__at"))).alias("__high"))
            cut = touched.join(edges, F.col("__k") == F.col(KEY), "left").select("__k", "__low", "__high")
        else:
            kind = changes.schema[SEQ].dataType
            old, cut = None, touched.select("__k", F.lit(None).cast(kind).alias("__low"), F.lit(None).cast(kind).alias("__high"))

        def within(at: str) -> Column:
            return (F.col("__low").isNull() | (F.col(at) >= F.col("__low"))) & (F.col("__high").isNull() | (F.col(at) < F.col("__high")))

        log = self._table(new, LOG).withColumn(KEY, self._key())
        feed = log.join(cut, F.col(KEY) == F.col("__k")).filter(within(SEQ)).select(*keys, *data_cols, SEQ, DEL, TRUNC, TIE)
        versions = scd2_from_changes(feed, self.spec, data_cols).withColumn(KEY, self._key()).join(cut, F.col(KEY) == F.col("__k"))
        versions = versions.withColumn(END_AT, F.coalesce(END_AT, "__high")).select(*keys, *data_cols, START_AT, END_AT).withColumn(KIND, F.lit(CLOSED))
        if old is None:
            return versions
        gone = old.join(cut, F.col(KEY) == F.col("__k")).filter(within(START_AT)).select(*keys, START_AT).withColumn(KIND, F.lit(REMOVED))
        return versions.unionByName(gone, allowMissingColumns=True)


def _write(df: DataFrame, path: str, *parts: str, tasks: int = 0) -> None:
    """Write ``df``; its shuffles have ``tasks`` partitions, if that is more than MERGED_TASKS."""
    dealt = {"spark.sql.shuffle.partitions": str(tasks), "spark.sql.adaptive.coalescePartitions.enabled": "false"} if tasks > MERGED_TASKS else {}
    with settings(df.sparkSession, {**SHUFFLES_REMOVED, **dealt}):
        (df.write.partitionBy(*parts) if parts else df.write).parquet(path)


def _nullable(schema: T.StructType) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType, True) for f in schema.fields]


def _json(text: str) -> dict:
    return json.loads(text)
