"""Data-quality expectations: named row predicates with a violation policy.

* ``warn`` keeps every row and only counts violations,
* ``drop`` removes violating rows,
* ``fail`` aborts the job that writes the dataset (``raise_error`` inside the plan,
  so nothing of that batch is published).

Counts come from ``DataFrame.observe`` on the write path (no extra pass over the data)
or from :meth:`Expectations.metrics`, one aggregate for all rules.

A predicate that evaluates to NULL is a violation by default (``null_is_violation``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

POLICIES = ("warn", "drop", "fail")


def _expr(p: str | Column) -> Column:
    return F.expr(p) if isinstance(p, str) else p


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str | Column
    on_violation: str = "warn"

    def __post_init__(self):
        if self.on_violation not in POLICIES:
            raise ValueError(f"on_violation must be one of {POLICIES}, got {self.on_violation!r}")


@dataclass
class Expectations:
    rules: list[Expectation]
    dataset: str = "dataset"
    null_is_violation: bool = True
    _names: set = field(default_factory=set, init=False, repr=False)

    def __post_init__(self):
        names = [r.name for r in self.rules]
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate expectation names in {names}")

    @classmethod
    def from_dicts(cls, dataset: str = "dataset", expect_all: dict | None = None,
                   expect_all_or_drop: dict | None = None, expect_all_or_fail: dict | None = None,
                   null_is_violation: bool = True) -> "Expectations":
        """Build from ``{name: sql}`` dictionaries, one per policy."""
        rules = []
        for policy, rules_dict in (("warn", expect_all), ("drop", expect_all_or_drop), ("fail", expect_all_or_fail)):
            for name, pred in (rules_dict or {}).items():
                rules.append(Expectation(name, pred, policy))
        return cls(rules, dataset, null_is_violation)

    # -- predicates ---------------------------------------------------------
    def passed(self, rule: Expectation) -> Column:
        """TRUE when the row satisfies the rule (NULL resolved by ``null_is_violation``)."""
        return F.coalesce(_expr(rule.predicate), F.lit(not self.null_is_violation))

    def _of(self, policy: str) -> list[Expectation]:
        return [r for r in self.rules if r.on_violation == policy]

    # -- application --------------------------------------------------------
    def apply(self, df: DataFrame) -> DataFrame:
        """Enforce fail and drop rules; warn rules leave the rows untouched."""
        out = df
        for rule in self._of("fail"):
            msg = f"expectation '{rule.name}' on dataset '{self.dataset}' failed (ON VIOLATION FAIL UPDATE)"
            # The predicate sits in a filter, so it is evaluated for every row and cannot be pruned.
            out = out.filter(F.when(self.passed(rule), F.lit(True)).otherwise(F.raise_error(F.lit(msg))))
        drops = self._of("drop")
        if drops:
            keep = drops[0]
            cond = self.passed(keep)
            for rule in drops[1:]:
                cond = cond & self.passed(rule)
            out = out.filter(cond)
        return out

    def violations(self, df: DataFrame) -> DataFrame:
        """Rows that violate at least one drop rule (the complement of :meth:`apply`'s filter)."""
        drops = self._of("drop")
        if not drops:
            return df.limit(0)
        bad = ~self.passed(drops[0])
        for rule in drops[1:]:
            bad = bad | ~self.passed(rule)
        return df.filter(bad)

    # -- metrics ------------------------------------------------------------
    def _count_columns(self) -> list[Column]:
        cols = [F.count(F.lit(1)).alias("__rows")]
        for i, rule in enumerate(self.rules):
            cols.append(F.count_if(~self.passed(rule)).alias(f"__f{i}"))
        return cols

    def metrics(self, df: DataFrame) -> DataFrame:
        """One row per rule: dataset, expectation, policy, passed_records, failed_records.

        A single global aggregate (partial per task, one tiny final merge) then an unpivot.
        """
        if not self.rules:
            raise ValueError("no expectations to measure")
        agg = df.agg(*self._count_columns())
        stack_args = ", ".join(
            f"'{r.name}', '{r.on_violation}', `__f{i}`" for i, r in enumerate(self.rules))
        long = agg.selectExpr("__rows", f"stack({len(self.rules)}, {stack_args}) AS (expectation, policy, failed)")
        return long.select(
            F.lit(self.dataset).alias("dataset"),
            F.col("expectation"),
            F.col("policy"),
            (F.col("__rows") - F.col("failed")).alias("passed_records"),
            F.col("failed").alias("failed_records"),
        )

    def observe(self, df: DataFrame, observation: Observation | None = None) -> tuple[DataFrame, Observation]:
        """Attach the counts to ``df`` as observed metrics; read them after the write action."""
        obs = observation or Observation(f"expectations_{self.dataset}")
        return df.observe(obs, *self._count_columns()), obs

    def observed_metrics(self, obs: Observation) -> list[dict]:
        """Turn an Observation's values into the event-log expectation records."""
        vals = obs.get
        rows = int(vals.get("__rows", 0) or 0)
        out = []
        for i, rule in enumerate(self.rules):
            failed = int(vals.get(f"__f{i}", 0) or 0)
            out.append({"name": rule.name, "dataset": self.dataset, "passed_records": rows - failed,
                        "failed_records": failed})
        return out


def quarantine(df: DataFrame, bad_rows: str | Column, reason: str, with_timestamp: bool = True) -> DataFrame:
    """Rows matching ``bad_rows`` plus a constant reason and (optionally) the time they were quarantined."""
    out = df.filter(_expr(bad_rows)).withColumn("quarantine_reason", F.lit(reason))
    if with_timestamp:
        out = out.withColumn("quarantine_timestamp", F.current_timestamp())
    return out
