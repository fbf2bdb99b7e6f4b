"""Change data capture into SCD type 1 and type 2 tables, as pure DataFrame functions.

``apply_changes(changes, spec)`` turns a change feed (one row per event: keys, values,
a sequence, optionally a delete / truncate marker) into the target table:

* SCD type 1 — one row per key holding the newest values; deletes remove the key.
* SCD type 2 — one row per version with ``__START_AT`` / ``__END_AT`` (NULL = current);
  a delete closes the open version; only changes of the tracked columns open a new
  version, the other columns are updated in place (newest value within the version).

Plan shape (SCD2): a two-level scan.  Events are dealt by (key, slice of the sequence), one hash exchange and
one sort, so that a hot key is spread over all slices; dedupe, change flags, version values and end times are windows with
that partitioning and ordering.  What a slice must know of its neighbours (the state before it, the next change after it)
comes from one summary row for each (key, slice): windows over the summaries, joined back.  Slices are
equal steps of the sequence between two quantiles of a bounded hash sample, a function of the event alone, so any
task that is run again deals alike; nothing runs while the plan is built.  SCD1 is a single
``groupBy(keys).agg(max_by(...))`` — partial aggregation on the map side, so a key that
holds a third of all rows is pre-combined in every task before the shuffle.

Decisions where the reference is silent:
* ties (same key and sequence) keep the row with the largest 64-bit hash of its values;
* the sequence column never counts as tracked — it orders the events;
* ``ignore_null_updates`` skips events whose non-key columns are all NULL.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQ = "__seq"
DEL = "__del"
TRUNC = "__trunc"
TIE = "__tb"
START_AT = "__START_AT"
END_AT = "__END_AT"

# key and slice of the sequence, by which SCD2 events are dealt; events sampled for the slices' bounds
KEY = "__key"
SLICE = "__slice"
BOUND_SAMPLE = 4096


def _expr(x: str | Column) -> Column:
    return F.expr(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class CdcSpec:
    """What a CDC flow declares: keys, sequence, columns, SCD type and options."""

    keys: tuple
    sequence_by: object  # column name, SQL expression string, or Column (e.g. F.struct("ts", "id"))
    stored_as_scd_type: int = 2
    columns: tuple | None = None
    except_columns: tuple = ()
    track_history: tuple | None = None
    track_history_except: tuple | None = None
    apply_as_deletes: object = None
    apply_as_truncates: object = None
    ignore_null_updates: bool = False
    late: str = "ignore"  # "ignore": older sequence values arriving late are dropped; "merge": inserted into history
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple([self.keys] if isinstance(self.keys, str) else self.keys))
        if not self.keys:
            raise ValueError("at least one key column is required")
        if self.stored_as_scd_type not in (1, 2):
            raise ValueError("stored_as_scd_type must be 1 or 2")
        if self.stored_as_scd_type == 2 and self.apply_as_truncates is not None:
            raise ValueError("APPLY AS TRUNCATE WHEN is only supported for SCD type 1")
        if self.late not in ("ignore", "merge"):
            raise ValueError("late must be 'ignore' or 'merge'")
        if self.track_history is not None and self.stored_as_scd_type != 2:
            raise ValueError("TRACK HISTORY applies to SCD type 2 only")

    # -- column bookkeeping ---------------------------------------------------
    def sequence_column(self) -> Column:
        s = self.sequence_by
        if isinstance(s, Column):
            return s
        return F.col(s) if s.isidentifier() else F.expr(s)

    def sequence_name(self) -> str | None:
        s = self.sequence_by
        return s if isinstance(s, str) and s.isidentifier() else None

    def data_columns(self, source_columns: list[str]) -> list[str]:
        """Non-key columns stored in the target, in source order."""
        low = {c.lower() for c in self.except_columns}
        keys = {k.lower() for k in self.keys}
        chosen = list(self.columns) if self.columns is not None else list(source_columns)
        return [c for c in chosen if c.lower() not in low and c.lower() not in keys]

    def tracked_columns(self, data_cols: list[str]) -> list[str]:
        seq = (self.sequence_name() or "").lower()
        if self.track_history is not None:
            wanted = {c.lower() for c in self.track_history}
            cols = [c for c in data_cols if c.lower() in wanted]
        elif self.track_history_except is not None:
            drop = {c.lower() for c in self.track_history_except}
            cols = [c for c in data_cols if c.lower() not in drop]
        else:
            cols = list(data_cols)
        return [c for c in cols if c.lower() != seq]


def join_keys(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on ``keys`` where NULL equals NULL (a key may have NULL parts); the left side's keys are kept."""
    other = {k: f"__right_{k}" for k in keys}
    same = functools.reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(o)) for k, o in other.items()])
    return left.join(right.withColumnsRenamed(other), same, how).drop(*other.values())


def prepare_changes(source: DataFrame, spec: CdcSpec) -> DataFrame:
    """Project the source to keys + data columns + internal (sequence, delete, truncate, tie) columns.

    A change with a NULL sequence has no place in the history of its key: the update fails with an error
    that names it."""
    data_cols = spec.data_columns(source.columns)
    del_c = F.coalesce(_expr(spec.apply_as_deletes), F.lit(False)) if spec.apply_as_deletes is not None else F.lit(False)
    trunc_c = (F.coalesce(_expr(spec.apply_as_truncates), F.lit(False))
               if spec.apply_as_truncates is not None else F.lit(False))
    out = source.select(*[F.col(k) for k in spec.keys], *[F.col(c) for c in data_cols],
                        spec.sequence_column().alias(SEQ), del_c.alias(DEL), trunc_c.alias(TRUNC))
    if spec.ignore_null_updates:
        seq = (spec.sequence_name() or "").lower()
        nullable = [c for c in data_cols if c.lower() != seq]
        if nullable:
            all_null = F.lit(True)
            for c in nullable:
                all_null = all_null & F.col(c).isNull()
            out = out.filter(~all_null | F.col(DEL) | F.col(TRUNC))
    missing = F.raise_error(F.lit("CDC change with a NULL sequence value"))
    out = out.withColumn(SEQ, F.when(F.col(SEQ).isNull(), missing.cast(out.schema[SEQ].dataType)).otherwise(F.col(SEQ)))
    tie_inputs = [F.col(c) for c in data_cols] + [F.col(DEL), F.col(TRUNC)]
    return out.withColumn(TIE, F.xxhash64(*tie_inputs))


def _distinct_from(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def _rank_code(seq: Column, kind: T.DataType) -> Column:
    """A double that never falls as the sequence rises (equal codes for different values are fine)."""
    if isinstance(kind, T.StructType):
        first = kind.fields[0]
        return _rank_code(seq.getField(first.name), first.dataType)
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return seq.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(seq).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(seq).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(seq.cast("date")) * 86400.0 + F.hour(seq) * 3600 + F.minute(seq) * 60 + F.second(seq)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(seq, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.lit(0.0)


def _sliced(prepared: DataFrame, slices: int) -> DataFrame:
    """``prepared`` with ``SLICE`` from 0: equal steps between the 5 % and the 95 % quantile of the sequence, the rest in the
    first and the last.  The quantiles come from the events with the smallest hashes, so a repeated task finds the same."""
    kind = prepared.schema[SEQ].dataType
    code = F.coalesce(_rank_code(F.col(SEQ), kind), F.lit(float("-inf")))
    if slices < 2:
        return prepared.withColumn(SLICE, F.lit(0))
    some = prepared.select(code.alias("c"), F.xxhash64(KEY, SEQ).alias("h")).filter(~F.isnan("c") & (F.abs("c") < float("inf"))).orderBy("h", "c").limit(BOUND_SAMPLE)
    bounds = some.agg(F.percentile("c", F.array(F.lit(0.05), F.lit(0.95)))).scalar()
    low, high = bounds[0], bounds[1]
    step = F.floor((F.least(code, high) - low) / F.when(high > low, high - low) * (slices - 2)) + 1
    return prepared.withColumn(SLICE, F.when(F.isnan(code) | (code > high), slices - 1).when(code > low, F.least(F.coalesce(step, F.lit(1)), F.lit(slices - 2))).otherwise(0).cast("int"))


def scd2_from_changes(prepared: DataFrame, spec: CdcSpec, data_cols: list[str], slices: int | None = None) -> DataFrame:
    """The SCD2 kernel over prepared change rows (all history for the keys present), as one lazy plan.

    ``slices`` (else ``spec.extra["slices"]``, else the session's shuffle partitions) is the number of tasks a hot key is dealt to.
    """
    slices = slices or spec.extra.get("slices") or int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = spec.tracked_columns(data_cols)
    untracked = [c for c in data_cols if c not in tracked]
    def changed(now_del, now_trk, was_del, was_trk):
        return (was_del != now_del) | (~now_del & _distinct_from(now_trk, was_trk))

    # keys as one struct: equal where their parts are, NULL parts too, and join and windows ask for one partitioning
    x = prepared.select(F.struct(*spec.keys).alias(KEY), SEQ, DEL, TIE, F.struct(*tracked, F.lit(0).alias("__")).alias("__trk"), F.struct(*untracked, F.lit(0).alias("__")).alias("__u"))
    x = _sliced(x, int(slices))

    # 1. one row per (key, sequence), the first by (sequence, falling tie hash); equal sequences share a slice
    own = Window.partitionBy(KEY, SLICE).orderBy(F.col(SEQ).asc(), F.col(TIE).desc())
    x = x.withColumn("__pseq", F.lag(SEQ).over(own)).filter(F.col("__pseq").isNull() | _distinct_from(F.col("__pseq"), F.col(SEQ)))

    # 2. changes within the slice: delete <-> upsert, or a tracked value changed
    own = Window.partitionBy(KEY, SLICE).orderBy(F.col(SEQ).asc())
    x = x.select(KEY, SLICE, SEQ, DEL, "__trk", "__u", F.lag(DEL).over(own).alias("__wasdel"), F.lag("__trk").over(own).alias("__wastrk"))
    inner = F.col("__wasdel").isNotNull() & changed(F.col(DEL), F.col("__trk"), F.col("__wasdel"), F.col("__wastrk"))
    x = x.select(KEY, SLICE, SEQ, DEL, "__trk", "__u", F.col("__wasdel").isNull().alias("__first"), inner.alias("__inner"))
    if untracked:
        x = x.withColumn("__before", F.sum(F.col("__inner").cast("int")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) == 0)

    # 3. one summary row for each slice, and windows over those of a key, forwards and backwards
    aggs = [F.min_by(F.struct(SEQ, DEL, "__trk"), SEQ).alias("f"), F.max_by(F.struct(DEL, "__trk", "__u"), SEQ).alias("l"), F.min(F.when(F.col("__inner"), F.col(SEQ))).alias("inner")]
    if untracked:
        aggs.append(F.max_by("__u", F.when(F.col("__before"), F.col(SEQ))).alias("pre"))
    up, down = Window.partitionBy(KEY).orderBy(SLICE), Window.partitionBy(KEY).orderBy(F.col(SLICE).desc())
    later = down.rowsBetween(Window.unboundedPreceding, -1)
    part = x.groupBy(KEY, SLICE).agg(*aggs).withColumn("was", F.lag("l").over(up))
    opens = F.col("was").isNull() | changed(F.col(f"f.{DEL}"), F.col("f.__trk"), F.col(f"was.{DEL}"), F.col("was.__trk"))
    change = F.when(opens, F.col(f"f.{SEQ}")).otherwise(F.col("inner"))
    found = [F.col(KEY).alias("__k"), F.col(SLICE).alias("__s"), opens.alias("__opens"), F.min(change).over(later).alias("__next")]
    if untracked:  # the last untracked values before the first change of a slice; those that this slice's last version ends with
        ends = F.when(change.isNotNull(), F.when(opens, F.col("was.__u")).otherwise(F.col("pre")))
        found.append(F.coalesce(F.last(ends, ignorenulls=True).over(later), F.first("l.__u").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("__ucont"))
    x = x.join(part.select(*found), (F.col(KEY) == F.col("__k")) & (F.col(SLICE) == F.col("__s")))
    x = x.withColumn("__chg", F.when(F.col("__first"), F.col("__opens")).otherwise(F.col("__inner")))

    # 4. untracked columns take the value of the last event of their version
    if untracked:
        nxt = F.lead("__chg").over(own)
        x = x.withColumn("__nxt", nxt).withColumn("__last", F.col("__nxt").isNull() | F.col("__nxt"))
        x = x.filter(F.col("__chg") | F.col("__last")).withColumn("__u", F.when(F.col("__nxt").isNull(), F.col("__ucont")).otherwise(F.col("__u")))
        x = x.withColumn("__u", F.when(F.col("__last"), F.col("__u")).otherwise(F.lead("__u").over(own)))

    # 5. versions: change rows; a version ends where the next change (insert or delete) starts
    v = x.filter(F.col("__chg")).withColumn(END_AT, F.coalesce(F.lead(SEQ).over(own), F.col("__next"))).filter(~F.col(DEL))
    return v.select(*[F.col(f"{KEY}.{k}").alias(k) for k in spec.keys], *[F.col(f"{'__trk' if c in tracked else '__u'}.{c}").alias(c) for c in data_cols], F.col(SEQ).alias(START_AT), F.col(END_AT))


def scd1_from_changes(prepared: DataFrame, spec: CdcSpec, data_cols: list[str]) -> DataFrame:
    """The SCD1 kernel: newest event per key after truncates; a newest delete removes the key."""
    x = prepared
    if spec.apply_as_truncates is not None:
        last_trunc = prepared.filter(F.col(TRUNC)).agg(F.max(SEQ)).scalar()  # scalar subquery
        x = x.filter(~F.col(TRUNC) & (last_trunc.isNull() | (F.col(SEQ) > last_trunc)))
    payload = F.struct(*[F.col(c) for c in data_cols], F.col(DEL).alias(DEL), F.col(SEQ).alias(SEQ))
    latest = x.groupBy(*spec.keys).agg(F.max_by(payload, F.struct(F.col(SEQ), F.col(TIE))).alias("__r"))
    latest = latest.filter(~F.col(f"__r.{DEL}"))
    return latest.select(*[F.col(k) for k in spec.keys], *[F.col(f"__r.{c}").alias(c) for c in data_cols])


def apply_changes(source: DataFrame, spec: CdcSpec, slices: int | None = None) -> DataFrame:
    """One-shot CDC apply of a whole change feed (batch); ``slices`` as for :func:`scd2_from_changes`."""
    data_cols = spec.data_columns(source.columns)
    prepared = prepare_changes(source, spec)
    if spec.stored_as_scd_type == 2:
        return scd2_from_changes(prepared, spec, data_cols, slices)
    return scd1_from_changes(prepared, spec, data_cols)


def scd2(source: DataFrame, keys, sequence_by, **options) -> DataFrame:
    return apply_changes(source, CdcSpec(keys=keys, sequence_by=sequence_by, stored_as_scd_type=2, **options))


def scd1(source: DataFrame, keys, sequence_by, **options) -> DataFrame:
    return apply_changes(source, CdcSpec(keys=keys, sequence_by=sequence_by, stored_as_scd_type=1, **options))


def current(versions: DataFrame) -> DataFrame:
    """Current rows of an SCD2 table."""
    return versions.filter(F.col(END_AT).isNull())


def check_target_schema(target_schema, spec: CdcSpec, source_schema) -> None:
    """An explicit SCD2 target schema must carry __START_AT/__END_AT typed like the sequence."""
    if spec.stored_as_scd_type != 2:
        return
    names = {f.name: f.dataType for f in target_schema.fields}
    seq_name = spec.sequence_name()
    seq_type = source_schema[seq_name].dataType if seq_name else None
    for sys_col in (START_AT, END_AT):
        if sys_col not in names:
            raise ValueError(f"explicit SCD2 target schema lacks {sys_col}")
        if seq_type is not None and names[sys_col] != seq_type:
            raise ValueError(f"{sys_col} must have the sequence type {seq_type.simpleString()}, "
                             f"got {names[sys_col].simpleString()}")

