"""A grouped aggregate maintained from changes equals a full recompute, and writes the groups that changed."""

import glob
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from conftest import SF_SMALL, rows
from levain.operators.cdc import CdcSpec
from levain.plans import analogs, flows, sales
from levain.session import settings
from levain.streaming.aggregate_view import AggregateView
from levain.streaming.cdc_target import SIGN, CdcTarget

SCHEMA = "k long, g string, x long, price decimal(10,2), seq int, op string"
SPEC = CdcSpec(keys=("k",), sequence_by="seq", except_columns=("op",), stored_as_scd_type=1, apply_as_deletes="op = 'D'")


def view_of(spark, path, source):
    return AggregateView(spark, path, source, ["g"], lambda df: df.filter("x IS NULL OR x >= 0"), counts={"n": "k", "n_x": "x"}, sums={"sum_x": "x", "sum_p": "price"},
                         mins={"least": "x"}, maxs={"most": "x"})


def recomputed(source):
    return rows(source.read().filter("x IS NULL OR x >= 0").groupBy("g").agg(
        F.count("k").alias("n"), F.count("x").alias("n_x"), F.sum("x").alias("sum_x"), F.sum("price").alias("sum_p"), F.min("x").alias("least"), F.max("x").alias("most")))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_updates_equal_a_full_recompute(spark, workdir, seed):
    r = random.Random(seed)
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = view_of(spark, f"{workdir}/v", source)
    for n in range(5):
        keys = r.sample(range(40), 25 if n == 0 else 7)
        data = [(k, r.choice(["a", "b", "c", None]), r.choice([None, -1, 0, 5, 9]), None if r.random() < .2 else r.randint(0, 999) / 4, n, "D" if n and r.random() < .4 else None) for k in keys]
        source.apply(spark.createDataFrame([(k, g, x, None if p is None else __import__("decimal").Decimal(str(p)), s, o) for k, g, x, p, s, o in data], SCHEMA), n)
        if n != 2:  # a refresh may take in several batches
            view.refresh()
            view.refresh()
            assert rows(view.read()) == recomputed(source)
        if n == 3:
            source.compact()
    assert view.taken_in() == source.versions.current()["version"]


def test_extremes_are_found_again_and_empty_groups_go(spark, workdir):
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = view_of(spark, f"{workdir}/v", source)
    source.apply(spark.createDataFrame([(1, "a", 1, None, 0, None), (2, "a", 5, None, 0, None), (3, "a", 9, None, 0, None), (4, "b", 7, None, 0, None)], SCHEMA), 0)
    view.refresh()
    source.apply(spark.createDataFrame([(3, None, None, None, 1, "D"), (4, "a", 2, None, 1, None)], SCHEMA), 1)
    view.refresh()
    assert rows(view.read(), "g", "n", "sum_x", "least", "most", "sum_p") == [("a", 3, 8, 1, 5, None)]


def test_only_groups_that_changed_are_written(spark, workdir):
    """2,000 groups; a correction of one line writes its two groups."""
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = view_of(spark, f"{workdir}/v", source)
    source.apply(spark.range(4000).selectExpr("id AS k", "concat('g', id % 2000) AS g", "id AS x", "CAST(1 AS DECIMAL(10,2)) AS price", "0 AS seq", "CAST(NULL AS STRING) AS op"), 0)
    view.refresh()

    def stored():
        return {f: spark.read.parquet(f).count() for f in glob.glob(f"{workdir.removeprefix('file:')}/v/data/**/*.parquet", recursive=True)}

    before = stored()
    source.apply(spark.createDataFrame([(7, "g8", 7, None, 1, None)], SCHEMA), 1)
    assert rows(source.changes(1), "k", "g", SIGN) == [(7, "g7", -1), (7, "g8", 1)]
    view.refresh()
    after = stored()
    assert sum(after.values()) - sum(before.values()) == 2 and before.items() <= after.items()
    assert rows(view.read()) == recomputed(source)


def test_changes_of_an_scd2_target(spark, workdir):
    source = CdcTarget(spark, f"{workdir}/s", CdcSpec(keys=("k",), sequence_by="seq", columns=("g",)))
    source.apply(spark.createDataFrame([(1, "a", 0, None, 0, None), (2, "b", 0, None, 0, None)], SCHEMA), 0)
    source.apply(spark.createDataFrame([(1, "c", 0, None, 5, None)], SCHEMA), 1)
    assert rows(source.changes(1), "k", "g", "__START_AT", "__END_AT", SIGN) == [(1, "a", 0, 5, 1), (1, "a", 0, None, -1), (1, "c", 5, None, 1)]
    assert source.changes(2).count() == 0


def test_untouched_days_of_the_fact_stay(spark, workdir):
    bronze = CdcTarget(spark, f"{workdir}/tx", flows.SALES_CDC)
    view = sales.fact_sales_view(spark, f"{workdir}/fact", bronze)
    first, second, third = flows.sales_updates(spark, SF_SMALL)
    bronze.apply(first, 0)
    view.refresh()
    files = set(glob.glob(f"{workdir.removeprefix('file:')}/fact/data/**/*.parquet", recursive=True))
    bronze.apply(second, 1)
    touched = {(r["customer_ID"], r["franchise_ID"], r["product_name"], r["sale_date"]) for r in view.project(bronze.changes(1)).collect()}
    view.refresh()
    new = [f for f in glob.glob(f"{workdir.removeprefix('file:')}/fact/data/**/*.parquet", recursive=True) if f not in files]
    wrote = {(r["customer_ID"], r["franchise_ID"], r["product_name"], r["sale_date"]) for r in spark.read.parquet(*new).collect()}
    assert wrote == touched and len(files) > 0
    bronze.apply(third, 2)
    view.refresh()
    assert rows(sales.fact_sales_of(view)) == rows(sales.fact_sales(sales.silver_transactions(analogs.transaction_lines(spark, SF_SMALL))))


def test_changes_shuffle_the_stored_rows_once_and_a_refresh_leaves_no_shuffle_files(spark, workdir):
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = view_of(spark, f"{workdir}/v", source)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        found = disk.getAllFiles()
        return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))

    before = shuffle_files()
    for n in range(3):
        source.apply(spark.createDataFrame([(k, None if k % 5 == 0 else f"g{k % 3}", k + n, None, n, "D" if n == 2 and k % 7 == 0 else None) for k in range(n, 60, n + 1)], SCHEMA), n)
        view.refresh()
    assert shuffle_files() <= before  # older queries' files may go meanwhile
    assert rows(view.read()) == recomputed(source)
    changed = source.changes(1, 3)
    assert changed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    old, new = rows(source.read(1)), rows(source.read(3))
    assert rows(changed.filter(f"{SIGN} = 1").drop(SIGN)) == [r for r in new if r not in old] and rows(changed.filter(f"{SIGN} = -1").drop(SIGN)) == [r for r in old if r not in new]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_late_rows_null_keys_and_a_subset_of_columns(spark, workdir, seed):
    """Batches with sequences older than what is stored, a NULL key, few values; refreshed after each batch or after several."""
    r = random.Random(seed)
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = AggregateView(spark, f"{workdir}/v", source, ["g"], lambda df: df.filter("x IS NULL OR x >= 0"), counts={"n": "k", "n_x": "x"}, sums={"sum_x": "x", "sum_p": "price"},
                         mins={"least": "x"}, maxs={"most": "x"}, columns=["k", "g", "x", "price"])
    whole = view_of(spark, f"{workdir}/w", source)
    newest = {}
    for n in range(6):
        data = []
        for k in r.sample([None, *range(30)], 20 if n == 0 else 8):
            row = (k, r.choice(["a", "b", "c", None]), r.choice([None, -1, 3, 3, 4]), None, r.choice([n * 10, n * 10, r.randrange(60)]) * 100 + n, "D" if n and r.random() < .3 else None)
            data.append(row)
            if k not in newest or row[4] > newest[k][4]:
                newest[k] = row
        source.apply(spark.createDataFrame(data, SCHEMA), n)
        if n not in (2, 4):
            view.refresh()
            whole.refresh()
            assert rows(source.read(), "k", "g", "x") == sorted(((k, g, x) for k, g, x, _, _, o in newest.values() if o is None), key=lambda t: tuple((v is None, str(v)) for v in t))
            assert rows(view.read()) == rows(whole.read()) == recomputed(source)


def test_extremes_of_equal_values_need_no_lookup(spark, workdir, monkeypatch):
    """Groups whose values are all one, or all gone, keep right extremes with no look at the source's rows."""
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = view_of(spark, f"{workdir}/v", source)
    source.apply(spark.createDataFrame([(1, "a", 5, None, 0, None), (2, "a", 5, None, 0, None), (3, "b", 1, None, 0, None), (4, "b", None, None, 0, None),
                                        (5, "c", 1, None, 0, None), (6, "c", 9, None, 0, None), (7, "d", 2, None, 0, None), (8, "d", 8, None, 0, None)], SCHEMA), 0)
    view.refresh()
    looked = []
    found = AggregateView._rows_of
    monkeypatch.setattr(AggregateView, "_rows_of", lambda self, groups, *a: looked.extend(x["__k"]["g"] for x in groups.collect()) or found(self, groups, *a))
    # a: one of two equal values goes; b: its only value goes, a NULL stays; c: all values go, another comes
    source.apply(spark.createDataFrame([(2, None, None, None, 1, "D"), (3, None, None, None, 1, "D"), (5, None, None, None, 1, "D"), (6, "c", 4, None, 1, None)], SCHEMA), 1)
    view.refresh()
    assert looked == [] and rows(view.read(), "g", "least", "most", "n") == [("a", 5, 5, 1), ("b", None, None, 1), ("c", 4, 4, 1), ("d", 2, 8, 2)]
    source.apply(spark.createDataFrame([(8, None, None, None, 2, "D")], SCHEMA), 2)  # d: one of two different values goes
    view.refresh()
    assert looked == ["d"] and rows(view.read()) == recomputed(source)


def test_a_view_stored_without_counts_of_its_values(spark, workdir):
    """Groups written before the counts were kept: their extremes are looked up."""
    source = CdcTarget(spark, f"{workdir}/s", SPEC)
    view = view_of(spark, f"{workdir}/v", source)
    source.apply(spark.createDataFrame([(1, "a", 5, None, 0, None), (2, "a", 5, None, 0, None), (3, "b", 1, None, 0, None), (4, "b", 6, None, 0, None)], SCHEMA), 0)
    merged = AggregateView._merged
    try:
        AggregateView._merged = lambda self, *a: merged(self, *a).drop("__v_x")
        view.refresh()
    finally:
        AggregateView._merged = merged
    for n, change in enumerate([(2, None, None, None, 1, "D"), (4, "a", 2, None, 2, None), (1, "b", 3, None, 3, None)], 1):
        source.apply(spark.createDataFrame([change], SCHEMA), n)
        view.refresh()
        assert rows(view.read()) == recomputed(source)


def test_steps_of_the_fact_deal_rows_out_once(spark, workdir, monkeypatch):
    """Lines are joined and numbered once for three updates; a batch and a view's groups are written with no copy before them,
    groups with no further shuffle; the stored rows of a change are dealt out once."""
    written = []

    def write(self, path, *a, _write=DataFrameWriter.parquet, **b):
        written.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        _write(self, path, *a, **b)

    updates = flows.sales_updates(spark, SF_SMALL, workdir)
    for u in updates:
        assert not [x for x in ("Join", "Window", "Exchange") if x in u._jdf.queryExecution().executedPlan().toString()]
    bronze = CdcTarget(spark, f"{workdir}/tx", flows.SALES_CDC)
    view = sales.fact_sales_view(spark, f"{workdir}/fact", bronze)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for n, u in enumerate(updates):
            bronze.apply(u, n)
            monkeypatch.setattr(DataFrameWriter, "parquet", write)
            view.refresh()
            monkeypatch.undo()
            assert not [p for p, _ in written if p.endswith("/log")]
            shuffles = {p.rsplit("/", 1)[-1]: plan.count("Exchange") for p, plan in written}
            assert shuffles == ({"rows": 1} if n == 0 else {"signed": 3, "merged": 2, "lost": 0, "rows": 0})
            written.clear()
    assert rows(sales.fact_sales_of(view)) == rows(sales.fact_sales(sales.silver_transactions(analogs.transaction_lines(spark, SF_SMALL))))
