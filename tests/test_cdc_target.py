"""The log-structured target: what a batch writes and reads, versions, broken batches, compaction, metrics."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from levain.operators.cdc import CdcSpec, apply_changes
from levain.operators.expectations import Expectations
from levain.sources import fs
from levain.sources.versions import Versions, has_batch, with_batch
from levain.streaming import cdc_target
from levain.streaming.cdc_target import CdcTarget

SCHEMA = "k long, v string, u long, ts timestamp_ntz, op string"
START = dt.datetime(2024, 1, 1)


def at(minute):
    return START + dt.timedelta(minutes=minute)


def feed(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def spec(**kw):
    return CdcSpec(keys=("k",), sequence_by="ts", columns=("v", "u"), apply_as_deletes="op = 'D'", **kw)


def written(spark, path):
    """Rows and data files below a target, of all versions and folders."""
    files = [f for f in glob.glob(f"{path.removeprefix('file:')}/data/**/*.parquet", recursive=True)]
    return sum(spark.read.parquet(f).count() for f in files), len(files)


@pytest.mark.parametrize("kw", [{"stored_as_scd_type": 1}, {"late": "ignore"}, {"late": "merge"}], ids=str)
def test_a_batch_writes_rows_for_its_keys_only(spark, workdir, kw):
    """5,000 keys are stored; a batch of 3 keys adds a handful of rows and files, and rewrites nothing."""
    path = f"{workdir}/t"
    target = CdcTarget(spark, path, spec(**kw))
    target.apply(feed(spark, [(k, "A", 0, at(0), None) for k in range(5000)]), 0)
    before, files = written(spark, path)
    names = set(glob.glob(f"{path.removeprefix('file:')}/data/**/*.parquet", recursive=True))
    target.apply(feed(spark, [(k, "B", 0, at(1), None) for k in (7, 8, 5001)]), 1)
    after, more = written(spark, path)
    assert before >= 5000 and 3 <= after - before <= 15 and more - files <= 16
    assert names <= set(glob.glob(f"{path.removeprefix('file:')}/data/**/*.parquet", recursive=True))
    assert target.read().count() == (5001 if kw.get("stored_as_scd_type") == 1 else 5003)


def test_a_reader_of_an_old_version_sees_the_old_state(spark, workdir):
    target = CdcTarget(spark, f"{workdir}/t", spec())
    target.apply(feed(spark, [(1, "A", 0, at(0), None)]), 0)
    old = target.read()
    target.apply(feed(spark, [(1, "B", 0, at(5), None), (2, "C", 0, at(5), None)]), 1)
    assert rows(old) == [(1, "A", 0, at(0), None)] == rows(target.read(version=1))
    assert rows(target.read()) == [(1, "A", 0, at(0), at(5)), (1, "B", 0, at(5), None), (2, "C", 0, at(5), None)]


def test_a_batch_that_breaks_before_its_commit_leaves_the_version_before(spark, workdir, monkeypatch):
    rules = Expectations.from_dicts("t", expect_all_or_drop={"v_not_null": "v IS NOT NULL"})
    seen = []
    target = CdcTarget(spark, f"{workdir}/t", spec(), expectations=rules, on_metrics=lambda b, r: seen.append((b, r[0]["passed_records"], r[0]["failed_records"])))
    target.apply(feed(spark, [(1, "A", 0, at(0), None)]), 0)
    batch = feed(spark, [(1, "B", 0, at(1), None), (2, None, 0, at(1), None)])

    def lost(*_):
        raise ConnectionError("lost before the commit")

    with monkeypatch.context() as broken:
        broken.setattr(Versions, "commit", lost)
        with pytest.raises(ConnectionError):
            target.apply(batch, 1)
    assert rows(target.read()) == [(1, "A", 0, at(0), None)] and seen == [(0, 1, 0)]
    target.apply(batch, 1)
    target.apply(batch, 1)  # replayed
    assert target.read().count() == 2 and seen == [(0, 1, 0), (1, 1, 1)]
    assert [(b, r[0]["passed_records"], r[0]["failed_records"]) for _, b, r in target.batch_metrics()] == [(0, 1, 0), (1, 1, 1)]
    assert len(target.batch_metrics(since=1)) == 1
    gone = target.versions.vacuum(keep=1)
    assert len(gone) == 1 and target.read().count() == 2  # the broken attempt's folder


def test_a_second_writer_is_refused(spark, workdir):
    v = Versions(spark, f"{workdir}/v")
    v.commit({"version": 1, "tables": {}})
    with pytest.raises(RuntimeError):
        v.commit({"version": 1, "tables": {}})
    assert v.current()["version"] == 1 and fs.read_text(spark, f"{workdir}/v/_none") is None


def test_batch_ranges():
    r = random.Random(1)
    for _ in range(50):
        took, out = r.sample(range(30), 12), []
        for b in took:
            out = with_batch(out, b)
        assert [b for b in range(30) if has_batch(out, b)] == sorted(took) and out == sorted(out)
        assert all(a[1] + 1 < b[0] for a, b in zip(out, out[1:]))


def _random_feed(seed, n, keys=6, ties=0.0):
    r = random.Random(seed)
    data = []
    for i in range(n):
        op = "D" if r.random() < 0.15 else None
        data.append((r.randint(1, keys), None if op else r.choice("ABC"), r.randint(0, 2), at(i if r.random() >= ties else max(0, i - 1)), op))
    return data


@pytest.mark.parametrize("late", ["ignore", "merge"])
@pytest.mark.parametrize("track", [None, ("v",)], ids=["all", "v"])
def test_batches_with_ties_and_compaction_equal_one_go(spark, workdir, late, track):
    """In order but for ties across the cuts: an event of the newest sequence with a larger hash still changes what was applied."""
    data = _random_feed(3, 160, ties=0.4)
    data.sort(key=lambda e: e[3])
    s = spec(late=late, track_history=track)
    target = CdcTarget(spark, f"{workdir}/t", s)
    for b, lo in enumerate(range(0, 160, 32)):
        target.apply(feed(spark, data[lo:lo + 32]), b)
        if b == 2:
            before = rows(target.read())
            target.compact()
            assert rows(target.read()) == before and target.folders() == 1
    assert rows(target.read()) == rows(apply_changes(feed(spark, data), s))


@pytest.mark.parametrize("track", [None, ("v",)], ids=["all", "v"])
def test_late_events_in_any_order_equal_one_go(spark, workdir, track):
    data = _random_feed(9, 150, keys=4, ties=0.2)
    random.Random(4).shuffle(data)
    s = spec(late="merge", track_history=track)
    target = CdcTarget(spark, f"{workdir}/t", s)
    for b, (lo, hi) in enumerate([(0, 60), (60, 61), (61, 110), (110, 150)]):
        target.apply(feed(spark, data[lo:hi]), b)
    assert rows(target.read()) == rows(apply_changes(feed(spark, data), s))


def test_a_late_event_reads_the_versions_it_cuts(spark, workdir, monkeypatch):
    """Keys with 400 versions of 2 events each: a late event brings a few events to the kernel, not the key's history."""
    data = [(k, f"v{i // 2}", 0, at(2 * i), None) for k in (1, 2) for i in range(800)]
    s = spec(late="merge")
    target = CdcTarget(spark, f"{workdir}/t", s)
    target.apply(feed(spark, data), 0)
    read, plain = [], cdc_target.scd2_from_changes
    monkeypatch.setattr(cdc_target, "scd2_from_changes", lambda df, *a: read.append(df.count()) or plain(df, *a))
    late = (1, "late", 0, at(801), None)
    target.apply(feed(spark, [late]), 1)
    assert read[0] <= 8
    assert rows(target.read()) == rows(apply_changes(feed(spark, [*data, late]), s))
    assert target._table(target.versions.current(), cdc_target.CLOSED).count() <= 800 + 6


def test_truncates_hide_rows_without_rewriting_them(spark, workdir):
    s = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",), stored_as_scd_type=1, apply_as_truncates="op = 'T'")
    target = CdcTarget(spark, f"{workdir}/t", s)
    target.apply(feed(spark, [(k, "A", 0, at(0), None) for k in range(2000)]), 0)
    before, _ = written(spark, f"{workdir}/t")
    target.apply(feed(spark, [(0, None, 0, at(5), "T"), (3, "B", 0, at(6), None)]), 1)
    assert rows(target.read()) == [(3, "B")] and written(spark, f"{workdir}/t")[0] - before <= 3
    target.apply(feed(spark, [(4, "late", 0, at(4), None), (5, "C", 0, at(7), None)]), 2)
    target.compact()
    assert rows(target.read()) == [(3, "B"), (5, "C")]


def test_a_column_of_another_type_is_refused_and_a_lost_one_is_null(spark, workdir):
    target = CdcTarget(spark, f"{workdir}/t", spec())
    target.apply(feed(spark, [(1, "A", 1, at(0), None)]), 0)
    with pytest.raises(ValueError, match="column u"):
        target.apply(feed(spark, [(1, "B", 1, at(1), None)]).withColumn("u", F.col("u").cast("string")), 1)
    s = CdcSpec(keys=("k",), sequence_by="ts", except_columns=("op", "ts"), apply_as_deletes="op = 'D'")
    target = CdcTarget(spark, f"{workdir}/u", s)
    target.apply(feed(spark, [(1, "A", 1, at(0), None)]), 0)
    target.apply(feed(spark, [(1, "B", 1, at(1), None)]).drop("u"), 1)
    assert rows(target.read(), "k", "v", "u", "__END_AT") == [(1, "A", 1, at(1)), (1, "B", None, None)]


@pytest.mark.parametrize("late", ["ignore", "merge"])
def test_tasks_of_a_batch_follow_its_events(spark, workdir, monkeypatch, late):
    """1,200 events, 60 for a task: as many tasks, however small their bytes, and the same versions as in one go."""
    monkeypatch.setattr(cdc_target, "TASK_ROWS", 60)
    spec = CdcSpec(keys=("k",), sequence_by="s", columns=("v",), late=late)
    data = [(None if n % 40 == 0 else n % 40, n, n * 7 % 3) for n in range(1200)]
    target = CdcTarget(spark, f"{workdir}/t", spec)
    before = [spark.conf.get(x) for x in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")]
    for n, part in enumerate((data[:900], data[900:]) if late == "ignore" else (data[::2], data[1::2])):
        target.apply(spark.createDataFrame(part, "k long, s long, v long"), n)
    assert before == [spark.conf.get(x) for x in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")]
    assert max(len(glob.glob(f"{x}/*.parquet")) for x in glob.glob(f"{workdir}/t/**/*__kind=closed", recursive=True)) > 8
    assert rows(target.read()) == rows(apply_changes(spark.createDataFrame(data, "k long, s long, v long"), spec))
