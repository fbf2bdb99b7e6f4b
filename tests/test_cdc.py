"""SCD1 / SCD2 semantics on hand-made change feeds (FIXTURES.md §3)."""

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from levain.operators.cdc import CdcSpec, apply_changes, scd1, scd2
from levain.streaming.cdc_target import CdcTarget

T = [dt.datetime(2024, 1, d) for d in range(1, 10)]
SCHEMA = "k long, v string, u long, ts timestamp_ntz, op string"


def feed(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def versions(df):
    return rows(df, "k", "v", "__START_AT", "__END_AT")


def test_scd2_coalesces_equal_values(spark):
    df = feed(spark, [(1, "A", 0, T[1], None), (1, "A", 0, T[2], None), (1, "B", 0, T[3], None),
                      (1, "A", 0, T[4], None)])
    out = scd2(df, "k", "ts", columns=("v",))
    assert versions(out) == [(1, "A", T[1], T[3]), (1, "A", T[4], None), (1, "B", T[3], T[4])]


def test_scd2_delete_then_reinsert_opens_new_version(spark):
    df = feed(spark, [(1, "A", 0, T[1], None), (1, None, 0, T[2], "D"), (1, "A", 0, T[3], None)])
    out = scd2(df, "k", "ts", columns=("v",), apply_as_deletes="op = 'D'")
    assert versions(out) == [(1, "A", T[1], T[2]), (1, "A", T[3], None)]


def test_scd2_delete_first_leaves_nothing(spark):
    df = feed(spark, [(1, None, 0, T[1], "D"), (2, "X", 0, T[1], None)])
    out = scd2(df, "k", "ts", columns=("v",), apply_as_deletes="op = 'D'")
    assert versions(out) == [(2, "X", T[1], None)]


def test_scd2_track_history_subset(spark):
    df = feed(spark, [(1, "A", 1, T[1], None), (1, "A", 2, T[2], None), (1, "A", 3, T[3], None)])
    out = scd2(df, "k", "ts", columns=("v", "u"), track_history=("v",))
    assert rows(out, "k", "v", "u", "__START_AT", "__END_AT") == [(1, "A", 3, T[1], None)]


def test_scd2_tie_is_deterministic(spark):
    a = feed(spark, [(1, "A", 0, T[1], None), (1, "B", 0, T[1], None)])
    b = feed(spark, [(1, "B", 0, T[1], None), (1, "A", 0, T[1], None)]).repartition(3)
    ra, rb = versions(scd2(a, "k", "ts", columns=("v",))), versions(scd2(b, "k", "ts", columns=("v",)))
    assert ra == rb and len(ra) == 1


def test_scd2_struct_sequence_breaks_tie(spark):
    df = spark.createDataFrame([(1, "A", T[1], 2), (1, "B", T[1], 1)], "k long, v string, ts timestamp_ntz, id long")
    out = scd2(df, "k", F.struct("ts", "id"), columns=("v",))
    got = rows(out.select("k", "v", F.col("__START_AT.id").alias("s"), F.col("__END_AT.id").alias("e")))
    assert got == [(1, "A", 2, None), (1, "B", 1, 2)]


def test_scd2_file_name_is_tracked(spark):
    df = spark.createDataFrame([(1, "A", "f1.csv", T[1]), (1, "A", "f2.csv", T[2])],
                               "k long, v string, file_name string, ts timestamp_ntz")
    assert scd2(df, "k", "ts", except_columns=("ts",)).count() == 2
    assert scd2(df, "k", "ts", except_columns=("ts",), track_history_except=("file_name",)).count() == 1


def test_ignore_null_updates(spark):
    df = feed(spark, [(1, "A", 1, T[1], None), (1, None, None, T[2], None)])
    assert scd2(df, "k", "ts", columns=("v", "u")).count() == 2
    assert scd2(df, "k", "ts", columns=("v", "u"), ignore_null_updates=True).count() == 1


def test_scd1_upsert_delete_truncate(spark):
    df = feed(spark, [(1, "A", 0, T[1], None), (1, "B", 0, T[3], None), (1, "Z", 0, T[2], None),
                      (2, "C", 0, T[1], None), (2, None, 0, T[4], "D")])
    out = scd1(df, "k", "ts", columns=("v",), apply_as_deletes="op = 'D'")
    assert rows(out, "k", "v") == [(1, "B")]
    tr = feed(spark, [(1, "A", 0, T[1], None), (9, None, 0, T[2], "T"), (2, "B", 0, T[3], None)])
    out = scd1(tr, "k", "ts", columns=("v",), apply_as_truncates="op = 'T'")
    assert rows(out, "k", "v") == [(2, "B")]


def test_truncate_on_scd2_is_an_error():
    with pytest.raises(ValueError):
        CdcSpec(keys=("k",), sequence_by="ts", stored_as_scd_type=2, apply_as_truncates="op = 'T'")


def _random_feed(spark, seed, n=300):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        k = rnd.randint(1, 12)
        op = "D" if rnd.random() < 0.15 else None
        data.append((k, None if op else rnd.choice("ABC"), rnd.randint(0, 3),
                     dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), op))
    return data


@pytest.mark.parametrize("late", ["ignore", "merge"])
def test_incremental_target_equals_one_shot(spark, workdir, late):
    """Any in-order batch split gives the one-shot table; a replayed batch changes nothing."""
    data = _random_feed(spark, 7)
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v", "u"), track_history=("v",),
                   apply_as_deletes="op = 'D'", late=late)
    expected = rows(apply_changes(feed(spark, data), spec))
    target = CdcTarget(spark, f"{workdir}/t_{late}", spec)
    cuts = [0, 40, 41, 150, 300]
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        target.apply(feed(spark, data[lo:hi]), b)
    target.apply(feed(spark, data[150:300]), 3)  # replay
    assert rows(target.read()) == expected
    assert target.read().filter("__END_AT IS NULL").groupBy("k").count().filter("count > 1").count() == 0


def test_late_events_ignore_vs_merge(spark, workdir):
    early = [(1, "A", 0, T[1], None), (1, "C", 0, T[3], None)]
    late = [(1, "B", 0, T[2], None)]
    for mode, expect in (("ignore", [(1, "A", T[1], T[3]), (1, "C", T[3], None)]),
                         ("merge", [(1, "A", T[1], T[2]), (1, "B", T[2], T[3]), (1, "C", T[3], None)])):
        spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",), late=mode)
        t = CdcTarget(spark, f"{workdir}/late_{mode}", spec)
        t.apply(feed(spark, early), 0)
        t.apply(feed(spark, late), 1)
        assert versions(t.read()) == expect


def test_scd1_target_tombstones_and_truncate(spark, workdir):
    spec = CdcSpec(keys=("k",), sequence_by="ts", stored_as_scd_type=1, columns=("v",),
                   apply_as_deletes="op = 'D'", apply_as_truncates="op = 'T'")
    t = CdcTarget(spark, f"{workdir}/scd1", spec)
    t.apply(feed(spark, [(1, "A", 0, T[1], None), (2, "B", 0, T[1], None)]), 0)
    t.apply(feed(spark, [(1, None, 0, T[2], "D")]), 1)
    assert rows(t.read(), "k", "v") == [(2, "B")]
    t.apply(feed(spark, [(1, "late", 0, T[1], None)]), 2)  # older than the delete: ignored
    assert rows(t.read(), "k", "v") == [(2, "B")]
    t.apply(feed(spark, [(0, None, 0, T[5], "T"), (3, "C", 0, T[6], None)]), 3)
    assert rows(t.read(), "k", "v") == [(3, "C")]


def plain_versions(events, tracked):
    """SCD2 by key, event by event: (k, v, u, seq, deleted) with distinct sequences -> (k, v, u, start, end)."""
    out, of = [], {}
    for e in events:
        of.setdefault(e[0], []).append(e)
    for k, mine in of.items():
        open_, was = None, None
        for _, v, u, seq, deleted in sorted(mine, key=lambda e: e[3]):
            now = (deleted, None if deleted else (v, u) if tracked == ("v", "u") else (v,))
            if now != was:
                if open_:
                    out.append((*open_, seq))
                open_ = None if deleted else [k, v, u, seq]
            elif open_:
                open_[2] = u  # an untracked column takes the newest value
            was = now
        if open_:
            out.append((*open_, None))
    return out


def in_order(found):
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("slices", [1, 2, 7, 60, None])
@pytest.mark.parametrize("tracked", [("v", "u"), ("v",)])
def test_hot_null_and_plain_keys_in_any_number_of_slices(spark, slices, tracked):
    data = _random_feed(spark, 11, n=400)
    data += [(99, "A" if i % 7 else "B", i % 5, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), None) for i in range(300)]
    data += [(98, "A", i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), "D" if i in (40, 41, 290) else None) for i in range(300)]  # long unchanged runs
    data += [(None, "AB"[i // 50 % 2], i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), None) for i in range(200)]
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v", "u"), track_history=tracked, apply_as_deletes="op = 'D'")
    got = [tuple(r) for r in apply_changes(feed(spark, data).repartition(5), spec, slices=slices).collect()]
    assert in_order(got) == in_order(plain_versions([(k, v, u, ts, op == "D") for k, v, u, ts, op in data], tracked))


@pytest.mark.parametrize("kind,of", [("long", lambda i: i * 10**12), ("double", lambda i: [float("-inf"), -1e300, 0.0, 3.5, 1e300, float("inf"), float("nan")][i // 6] if i % 6 == 0 else i + 0.5),
                                     ("date", lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)), ("string", lambda i: f"{i:03d}" + "x" * 20), ("decimal(20,2)", decimal.Decimal),
                                     ("struct<a:date,b:long>", lambda i: (dt.date(2024, 1, 1 + i // 10), i)), ("timestamp", lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)), ("binary", lambda i: bytes([i]))])
def test_slices_keep_the_order_of_any_sequence(spark, kind, of):
    data = [(k, "ABC"[(i * i + k) // 7 % 3], of(i)) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(data, f"k long, v string, s {kind}")
    spec = CdcSpec(keys=("k",), sequence_by="s", columns=("v",))
    one, many = ([tuple(map(str, r)) for r in apply_changes(df, spec, slices=n).collect()] for n in (1, 9))
    assert in_order(one) == in_order(many) and len(one) > 10


def test_scd2_runs_nothing_while_the_plan_is_built(spark):
    data = _random_feed(spark, 3)
    df = feed(spark, data)
    spark.sparkContext.setJobGroup("build", "build")
    out = apply_changes(df, CdcSpec(keys=("k",), sequence_by="ts", columns=("v", "u"), track_history=("v",)))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    out.count()
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext._jsc.clearJobGroup()


def test_target_remembers_delete_that_arrived_first(spark, workdir):
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",), apply_as_deletes="op = 'D'")
    t = CdcTarget(spark, f"{workdir}/stub", spec)
    t.apply(feed(spark, [(1, None, 0, T[3], "D"), (2, "X", 0, T[1], None)]), 0)
    assert versions(t.read()) == [(2, "X", T[1], None)]
    t.apply(feed(spark, [(1, "old", 0, T[2], None)]), 1)  # older than the delete: ignored
    assert versions(t.read()) == [(2, "X", T[1], None)]
    t.apply(feed(spark, [(1, "new", 0, T[4], None)]), 2)
    assert versions(t.read()) == [(1, "new", T[4], None), (2, "X", T[1], None)]


def test_target_fail_rule_publishes_nothing(spark, workdir):
    from levain.operators.expectations import Expectation, Expectations
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",))
    rules = Expectations([Expectation("v_not_null", "v IS NOT NULL", "fail")], "t")
    t = CdcTarget(spark, f"{workdir}/fail", spec, expectations=rules)
    t.apply(feed(spark, [(1, "A", 0, T[1], None)]), 0)
    with pytest.raises(Exception, match="v_not_null"):
        t.apply(feed(spark, [(1, "B", 0, T[2], None), (2, None, 0, T[2], None)]), 1)
    assert versions(t.read()) == [(1, "A", T[1], None)]
    t.apply(feed(spark, [(1, "B", 0, T[2], None)]), 1)  # the fixed batch is applied under the same id
    assert versions(t.read()) == [(1, "A", T[1], T[2]), (1, "B", T[2], None)]


def test_target_source_gains_a_column(spark, workdir):
    spec = CdcSpec(keys=("k",), sequence_by="ts", except_columns=("ts",))
    t = CdcTarget(spark, f"{workdir}/evolve", spec)
    t.apply(spark.createDataFrame([(1, "A", T[1])], "k long, v string, ts timestamp_ntz"), 0)
    t.apply(spark.createDataFrame([(1, "A", "x", T[2]), (2, "B", None, T[2])],
                                  "k long, v string, w string, ts timestamp_ntz"), 1)
    got = rows(t.read(), "k", "v", "w", "__START_AT", "__END_AT")
    want = [(1, "A", None, T[1], T[2]), (1, "A", "x", T[2], None), (2, "B", None, T[2], None)]
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def _assert_no_overlap(df):
    by_key = {}
    for k, _, s, e in versions(df):
        by_key.setdefault(k, []).append((s, e))
    for k, spans in by_key.items():
        spans.sort()
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 is not None and e1 <= s2, (k, spans)


@pytest.mark.parametrize("seed", [5, 6])
def test_merge_mode_is_order_independent(spark, workdir, seed):
    """late='merge': batches arriving in any order give the one-shot table; versions never overlap."""
    data = _random_feed(spark, seed, n=200)
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",), apply_as_deletes="op = 'D'", late="merge")
    expected = rows(apply_changes(feed(spark, data), spec))
    rnd = random.Random(seed)
    shuffled = data[:]
    rnd.shuffle(shuffled)
    t = CdcTarget(spark, f"{workdir}/merge_{seed}", spec)
    for b, lo in enumerate(range(0, len(shuffled), 50)):
        t.apply(feed(spark, shuffled[lo:lo + 50]), b)
    got = t.read()
    assert rows(got) == expected
    _assert_no_overlap(got)
    _assert_no_overlap(apply_changes(feed(spark, data), spec))


def test_null_sequence_fails_by_name(spark):
    df = feed(spark, [(1, "A", 0, None, None), (1, "B", 0, T[1], None)])
    with pytest.raises(Exception, match="NULL sequence"):
        scd2(df, "k", "ts", columns=("v",)).collect()


@pytest.mark.parametrize("slices", [1, 2, 5])
def test_null_key_is_a_key_like_others(spark, slices):
    data = [(k, v, 0, T[n], None) for k in (None, 1) for n, v in enumerate("AABBA", 1)]
    out = apply_changes(feed(spark, data), CdcSpec(keys=("k",), sequence_by="ts", columns=("v",)), slices=slices)
    want = [("A", T[1], T[3]), ("B", T[3], T[5]), ("A", T[5], None)]
    assert versions(out) == sorted([(k, *w) for k in (None, 1) for w in want], key=lambda r: tuple((x is None, str(x)) for x in r))


def test_truncate_is_remembered_between_batches(spark, workdir):
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",), stored_as_scd_type=1, apply_as_truncates="op = 'T'")
    target = CdcTarget(spark, f"{workdir}/t", spec)
    target.apply(feed(spark, [(None, None, 0, T[5], "T"), (1, "A", 0, T[6], None)]), 0)
    target.apply(feed(spark, [(2, "late", 0, T[3], None), (3, "new", 0, T[7], None)]), 1)
    assert rows(target.read(), "k", "v") == [(1, "A"), (3, "new")]


@pytest.mark.parametrize("kind", [1, 2])
def test_equal_sequences_in_any_order_of_batches(spark, workdir, kind):
    spec = CdcSpec(keys=("k",), sequence_by="ts", columns=("v",), stored_as_scd_type=kind)
    batches = [feed(spark, [(1, v, 0, T[1], None)]) for v in "pq"]
    want = rows(apply_changes(batches[0].union(batches[1]), spec), "k", "v")
    for n, order in enumerate((batches, batches[::-1])):
        target = CdcTarget(spark, f"{workdir}/{kind}{n}", spec)
        for i, b in enumerate(order):
            target.apply(b, i)
        assert rows(target.read(), "k", "v") == want
