"""A grouped aggregate of a :class:`CdcTarget`, kept up to date from the target's changes alone.

``refresh`` reads the signed rows between the source version that was last taken in and the current one (an added row
counts +1, one taken away -1), and merges them into the groups they belong to:

* counts and sums are additive: the groups' stored values plus the signed sums;
* minima and maxima take in added values; where a row was taken away that held the extreme, and none was added that does, they
  are found again from the source's rows of those groups only (but for groups whose values are all one, or all gone);
* a group whose rows are all gone is deleted.

Groups are stored in a CdcTarget of their own (SCD1 by group): a refresh writes the groups that changed and nothing else,
commits in one step, and doing it again is a no-op, since the source's version is the batch number.

Cases.  NULL group values form groups of their own; a sum over NULLs alone is NULL, as are its extremes.  The source's rows pass ``project``
(a row-wise DataFrame function: filters and derived columns, that keeps ``SIGN`` as it is) with either sign, so a correction may move a row from one group to another.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levain.operators.cdc import CdcSpec
from levain.session import SHUFFLES_REMOVED, settings, shared_dir
from levain.sources import fs
from levain.sources.versions import has_batch
from levain.streaming.cdc_target import SIGN, CdcTarget

ROWS, VERSION = "__rows", "__version"


class AggregateView:
    def __init__(self, spark: SparkSession, path: str, source: CdcTarget, group: list[str], project: Callable[[DataFrame], DataFrame],
                 counts: dict[str, str] | None = None, sums: dict[str, str] | None = None, mins: dict[str, str] | None = None, maxs: dict[str, str] | None = None,
                 columns: list[str] | None = None):
        """``counts`` (of non-NULL values), ``sums``, ``mins`` and ``maxs`` map output names to columns of the projected rows.
        ``columns`` names the source's columns that the projected rows and its filters are made of (else all are read): ``project``
        finds the others NULL."""
        self.source, self.group, self.columns = source, list(group), columns
        self.project = project
        self.counts, self.sums, self.mins, self.maxs = (dict(x or {}) for x in (counts, sums, mins, maxs))
        self.target = CdcTarget(spark, path, CdcSpec(keys=tuple(group), sequence_by=VERSION, stored_as_scd_type=1, apply_as_deletes=f"{ROWS} = 0"))

    def read(self) -> DataFrame:
        """The groups with their values; a sum is NULL where no value was."""
        out = self.target.read(columns=[*self.counts, *self.sums, *(f"__n_{s}" for s in self.sums), *self.mins, *self.maxs])
        return out.select(*self.group, *self.counts, *(F.when(F.col(f"__n_{s}") > 0, F.col(s)).alias(s) for s in self.sums), *self.mins, *self.maxs)

    def taken_in(self) -> int:
        """The source version up to which changes were taken in."""
        done = self.target.versions.current()["batches"]
        return done[-1][1] if done else 0

    def refresh(self) -> int:
        """Take in what changed since the last refresh; returns the source's version."""
        since, now = self.taken_in(), self.source.versions.current()["version"]
        if now == since or has_batch(self.target.versions.current()["batches"], now):
            return now
        delta = self._projected(self.source.changes(since, now, self._columns()), now)
        work = shared_dir(self.target.spark, "views", unique=True)
        try:
            self.target.apply(self._merged(delta, now, since, work), now, one_each=True)
        finally:
            fs.remove(self.target.spark, work)
        return now

    # ------------------------------------------------------------------ internals
    def _key(self):
        return F.struct(*self.group)

    def _extreme_of(self) -> list[str]:
        """The columns that have a minimum or maximum: ``__v_`` counts their values, ``__gone_v_`` those taken away (below 0)."""
        return [*dict.fromkeys([*self.mins.values(), *self.maxs.values()])]

    def _columns(self) -> list[str] | None:
        return self.columns and [*self.source.spec.keys, *(c for c in self.columns if c not in self.source.spec.keys)]

    def _projected(self, rows: DataFrame, version: int) -> DataFrame:
        """Source rows of ``version`` with their SIGN through the projection."""
        have = {c.lower() for c in rows.columns}
        absent = {f.name: F.lit(None).cast(f.dataType) for f in self.source.read(version).schema.fields if f.name.lower() not in have} if self.columns else {}
        return self.project(rows.withColumns(absent) if absent else rows)

    def _rows_of(self, groups: DataFrame, now: int, work: str) -> DataFrame:
        """The projected source rows of ``groups`` (``__k``); of an SCD1 source only keys that had a row in them at any time are looked at."""
        among = None
        if self.source.spec.stored_as_scd_type == 1:
            ever = self.source.stored(now, self._columns())
            ever = self._projected(ever.withColumn(SIGN, F.struct(*self.source.spec.keys)), now)
            among = self._step(ever.join(groups, self._key() == F.col("__k"), "left_semi").select(F.col(SIGN).alias("__k")).distinct(), f"{work}/keys")
        rows = self.source.read(now, among=among, columns=self._columns())
        return self._projected(rows.withColumn(SIGN, F.lit(1).cast("long")), now).join(groups, self._key() == F.col("__k"), "left_semi")

    def _signed(self, delta: DataFrame) -> DataFrame:
        """One row for each group that changed: additive parts, extremes of added rows and of rows taken away."""
        s = F.col(SIGN)
        def some(c):
            return F.col(c).isNotNull().cast("long") * s

        def of(c, sign):
            return F.when(s * sign > 0, F.col(c))

        aggs = [F.sum(s).alias(ROWS)]
        aggs += [F.sum(some(c)).alias(o) for o, c in self.counts.items()]
        for o, c in self.sums.items():
            aggs += [F.sum(F.col(c) * s).alias(o), F.sum(some(c)).alias(f"__n_{o}")]
        for o, c in self.mins.items():
            aggs += [F.min(of(c, 1)).alias(o), F.min(of(c, -1)).alias(f"__gone_{o}")]
        for o, c in self.maxs.items():
            aggs += [F.max(of(c, 1)).alias(o), F.max(of(c, -1)).alias(f"__gone_{o}")]
        for c in self._extreme_of():
            aggs += [F.sum(some(c)).alias(f"__v_{c}"), F.sum(F.when(s < 0, some(c))).alias(f"__gone_v_{c}")]
        return delta.groupBy(*self.group).agg(*aggs)

    @staticmethod
    def _step(df: DataFrame, path: str) -> DataFrame:
        """``df`` written and read back, so that its shuffle files are gone before the next step writes its own."""
        with settings(df.sparkSession, SHUFFLES_REMOVED):
            df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _merged(self, delta: DataFrame, now: int, since: int, work: str) -> DataFrame:
        signed = self._signed(delta)
        additive, extremes, values = [ROWS, *self.counts, *(x for o in self.sums for x in (o, f"__n_{o}"))], [*self.mins, *self.maxs], [f"__v_{c}" for c in self._extreme_of()]
        kept = [*self.group, *additive, *extremes, *values]
        if not since:
            return signed.select(*kept, F.lit(now).alias(VERSION))
        signed = self._step(signed, f"{work}/signed")
        both = self.target.beside(signed, kept[len(self.group):])
        both = both.select(*signed.columns, *(F.col(f"__old.{c}").alias(f"__old_{c}") for c in (*additive, *extremes, *values)))
        # sums keep the type of the aggregate, as adding decimals would widen them with every refresh
        merged = both.withColumns({c: (F.coalesce(f"__old_{c}", F.lit(0)) + F.coalesce(c, F.lit(0))).cast(signed.schema[c].dataType) for c in additive})
        merged = merged.withColumns({c: F.when(F.col(f"__old_{ROWS}").isNull(), F.col(c)).otherwise(F.col(f"__old_{c}") + F.col(c)) for c in values})
        lost, found = F.lit(False), {}
        for outputs, among, beyond in ((self.mins, F.least, Column.__le__), (self.maxs, F.greatest, Column.__ge__)):
            for o, c in outputs.items():
                new, old, gone, left = F.col(o), F.col(f"__old_{o}"), F.col(f"__gone_{o}"), F.col(f"__old___v_{c}") + F.coalesce(f"__gone_v_{c}", F.lit(0))
                # values that were all one stay what they were while one is left; where none is, those that were added are all
                one = [F.col(f"__old_{a}").eqNullSafe(F.col(f"__old_{b}")) for a in self.mins for b in self.maxs if self.mins[a] == self.maxs[b] == c][:1]
                held = functools.reduce(Column.__or__, [F.coalesce(beyond(new, gone), F.lit(False)), F.coalesce(left == 0, F.lit(False)), *(x & F.coalesce(left > 0, F.lit(False)) for x in one)])
                lost = lost | (F.coalesce(beyond(gone, old), F.lit(False)) & ~held)
                found[o] = F.when(left == 0, new).otherwise(among(new, old))
        merged = merged.withColumns({"__lost": lost & (F.col(ROWS) > 0), **found})
        if extremes:
            merged = self._step(merged.select(*kept, "__lost"), f"{work}/merged")
            again = self._step(merged.filter("__lost").select(self._key().alias("__k")), f"{work}/lost")
            if not again.isEmpty():
                rows = self._rows_of(again, now, work).groupBy(self._key().alias("__k")).agg(
                    *(F.min(c).alias(f"__new_{o}") for o, c in self.mins.items()), *(F.max(c).alias(f"__new_{o}") for o, c in self.maxs.items()))
                again = merged.filter("__lost").join(rows, self._key() == F.col("__k"), "left").withColumns({o: F.col(f"__new_{o}") for o in extremes})
                merged = merged.filter("NOT __lost").unionByName(again.select(*merged.columns))
        return merged.select(*kept, F.lit(now).alias(VERSION))
