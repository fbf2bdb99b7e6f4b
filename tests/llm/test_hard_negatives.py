"""Hard negatives against a plain version, and on nulls, ties, repeated rows, empty tables and clashing names."""

import numpy as np
from pyspark.sql import functions as F

from levain.llm import op13_hard_negatives as o13
from levain.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, `row` string, v string, rank string, ab string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, None, "x", "y", "z") for i, v, y in rows], SCHEMA)


def plain(rows, anchor, label, positives=5, negatives=5, low=80, high=100, scale=256):
    """Every anchor against every row, in Python integers."""
    ok = [(i, [int(np.floor(scale * x)) for x in v], label(i, y)) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v, y) in enumerate(ok):
        if not anchor(i):
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, z) for b, (j, w, z) in enumerate(ok) if b != a]
        for ps, p, _ in sorted(s for s in scored if s[2] == y)[:positives]:
            fits = sorted(s for s in scored if s[2] != y and low * -ps <= 100 * -s[0] <= high * -ps)[:negatives]
            out += [(i, p, n, j, -ps, -ns) for n, (ns, j, _) in enumerate(fits, 1)]
    return sorted(out)


def shifted(i, y):
    return (y + 1) % 10 if i % 7 == 0 else y


def shift():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def run(spark, rows, **kw):
    return sorted(map(tuple, o13.mine(table(spark, rows), F.col("vec_id") % 10 == 0, shift(), **kw).collect()))


def test_against_every_pair_in_many_blocks(spark):
    r = np.random.default_rng(0)
    centre = r.standard_normal((4, 12))
    rows = [(int(i), (centre[i % 4] + 0.6 * r.standard_normal(12)).tolist(), int(r.integers(0, 3) if i % 3 else 1)) for i in range(400)]
    want = plain(rows, lambda i: i % 10 == 0, shifted)
    assert len(want) > 200 and run(spark, rows, row_block=90, anchor_block=16) == want == run(spark, rows)
    assert run(spark, rows, positives=2, negatives=3, low=50, high=90, scale=16.0) == plain(rows, lambda i: i % 10 == 0, shifted, 2, 3, 50, 90, 16)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.25], 2), (2, [1.0, 0.25], 2), (3, [0.9, 7.0], 2), (4, [0.9], 3), (5, [0.5, 0.5], 2), (10, [-1.0, 0.0], 1),
            (20, [0.0, 0.0], 2), (30, None, 1), (40, [1.0, None], 1), (50, [nan, 1.0], 1), (60, [1.0, inf], 1), (80, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (90, [], 4), (0, [1.0, 0.0], 1), (70, [1.0, 1.0], 0)]
    got = run(spark, rows)
    assert got == plain(rows, lambda i: i % 10 == 0, shifted)
    assert got.count((0, 0, 1, 1, 65536, 65536)) == 2 and (0, 0, 2, 70, 65536, 65536) in got  # repeated rows and ids, ties; 0 and 70 have shifted labels
    assert run(spark, []) == [] and run(spark, [(0, [1.0], 1)]) == []
    big = [(0, [2.0**40, 1.0], 1), (1, [2.0**40, 3.0], 1), (2, [2.0**40, 2.0], 2), (3, [2.0**40, 4.0], 2), (4, [0.9 * 2**40, 0.0], 5)]
    assert [x[:4] for x in run(spark, big)] == [x[:4] for x in plain(big, lambda i: i % 10 == 0, shifted)]


def test_lists_stop_early_and_are_exact():
    r = np.random.default_rng(1)
    x = np.floor(r.standard_normal((4000, 3)) * 200)
    x[:20] *= 30
    lists, q = o13.SortedLists(x, np.arange(4000)), np.array([3.0, -2.0, 0.0])
    scores = x @ q
    got = lists.first(q, [(None, None), (100, 900)], 7, np.arange(4000) % 2 == 0)
    for part, fits in zip(got, (scores == scores, (scores >= 100) & (scores <= 900))):
        assert part == sorted(((int(s), n) for n, s in enumerate(scores) if n % 2 == 0 and fits[n]), key=lambda p: (-p[0], p[1]))[:7]
    lists.read = 0
    lists.first(q, [(None, None)], 3, np.ones(4000, bool))
    assert lists.read < 400  # the threshold fell below the third score


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op13_threshold_hard_negatives"](spark, sf).collect())) == plain(rows, lambda i: i % 100 == 0, shifted)
