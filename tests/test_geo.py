import math
import random

from pyspark.sql import functions as F

from levain.functions.geo import haversine_km
from levain.operators.geo_join import nearest, pairs_within


def test_haversine_edges(spark):
    df = spark.createDataFrame([(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)],
                               "a double, b double, c double, d double")
    got = [r.d for r in df.select(haversine_km("a", "b", "c", "d").alias("d")).collect()]
    assert got[0] == 0.0
    assert abs(got[1] - math.pi * 6371) < 1e-6 and abs(got[2] - math.pi * 6371) < 1e-6


def test_pairs_within_equals_brute_force(spark):
    rnd = random.Random(3)
    pts = lambda n: [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(n)]
    left = spark.createDataFrame(pts(60) + [(1000, 90.0, 0.0), (1001, -89.9, 179.9)], "lid long, la double, lo double")
    right = spark.createDataFrame(pts(80) + [(2000, 89.5, -170.0), (2001, -89.0, -179.9), (2002, 0.0, 179.99)],
                                  "rid long, ra double, ro double")
    for km in (300.0, 1500.0, 7000.0):
        fast = {(r.lid, r.rid) for r in pairs_within(left, right, km, ("la", "lo"), ("ra", "ro")).collect()}
        brute = left.crossJoin(right).withColumn("d", haversine_km("la", "lo", "ra", "ro")).filter(F.col("d") <= km)
        assert fast == {(r.lid, r.rid) for r in brute.collect()}, km


def test_distance_within_reaches_2500_km(spark, monkeypatch):
    """The registered radius join and its SQL keep pairs up to 2,500 km: 1,112, 2,446 and 2,557 km apart on the equator."""
    from levain.plans import oracle, queries

    left = spark.createDataFrame([(1, 0.0, 179.0)], "franchise_ID long, f_lat double, f_lon double")
    right = spark.createDataFrame([(1, 0.0, 169.0), (2, 0.0, -159.0), (3, 0.0, -158.0), (4, 0.0, 179.0)], "supplier_ID long, s_lat double, s_lon double")
    monkeypatch.setattr(queries, "_located", lambda spark, sf: (left, right))
    assert {r["supplier_ID"] for r in queries.q_distance_within(spark, "").collect()} == {1, 2, 4}
    assert oracle.distance_within(queries.DISTANCE_MAX_KM).endswith("WHERE distance_km <= 2500.0")


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(5)
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(40)] + [(100, 10.0, 10.0), (101, 10.0, 10.0)]
    crowd = [(i, rnd.uniform(40, 45), rnd.uniform(0, 5)) for i in range(50)] + [(200 + i, 10.0, 10.0) for i in range(9)] + [(300, -90.0, 0.0)]
    left = spark.createDataFrame(pts, "lid long, la double, lo double")
    right = spark.createDataFrame(crowd, "rid long, ra double, ro double")

    def brute(r, k):
        pairs = left.crossJoin(r).select("lid", "rid", haversine_km("la", "lo", "ra", "ro").alias("d")).collect()
        out = set()
        for lid in {p.lid for p in pairs}:
            mine = sorted((p.d, p.rid) for p in pairs if p.lid == lid)[:k]
            out |= {(lid, n, rid) for n, (_, rid) in enumerate(mine, 1)}
        return out

    for k in (1, 4, 100):
        got = {(r.lid, r.rank, r.rid) for r in nearest(left, right, k, "lid", "rid", ("la", "lo"), ("ra", "ro")).collect()}
        assert got == brute(right, k), k
    assert nearest(left, right.limit(0), 2, "lid", "rid", ("la", "lo"), ("ra", "ro")).count() == 0
    assert nearest(left.limit(0), right, 2, "lid", "rid", ("la", "lo"), ("ra", "ro")).count() == 0


def test_nearest_in_a_crowded_city_meets_few_points(spark):
    """2,000 x 2,000 points within 0.2 degrees, some far away, poles and date line: exact, and few distances are computed."""
    import math
    import random

    r = random.Random(3)
    spots = [(48 + r.random() * 0.2, 2 + r.random() * 0.2) for _ in range(4000)] + [(90.0, 0.0), (-89.99, 170.0), (10.0, 179.999), (10.0, -179.999), (0.0, 0.0), (-40.0, -120.0)] * 2
    left = spark.createDataFrame([(n, *p) for n, p in enumerate(spots[:2000] + spots[4000:4006])], "lid long, la double, lo double")
    right = spark.createDataFrame([(n, *p) for n, p in enumerate(spots[2000:4000] + spots[4006:])], "rid long, ra double, ro double")
    out = nearest(left, right, 5, "lid", "rid", ("la", "lo"), ("ra", "ro"))
    got = {}
    for x in out.collect():
        got.setdefault(x["lid"], []).append((x["rank"], x["rid"]))

    def km(a, b):
        (p, q), (s, t) = (map(math.radians, v) for v in (a, b))
        return 2 * 6371 * math.asin(math.sqrt(min(1.0, math.sin((s - p) / 2) ** 2 + math.cos(p) * math.cos(s) * math.sin((t - q) / 2) ** 2)))

    there = spots[2000:4000] + spots[4006:]
    for n, p in [*list(enumerate(spots[:2000]))[::40], *enumerate(spots[4000:4006], 2000)]:
        best = sorted((round(km(p, q), 7), m) for m, q in enumerate(there))[:5]
        assert [m for _, m in sorted(got[n])] == [m for _, m in best], (n, p)
    plan = out._jdf.queryExecution().executedPlan()
    joined = [int(line.split(":")[1].replace(",", "")) for line in _join_rows(plan)]
    assert 0 < max(joined) < 600_000  # of 4,024,036 pairs


def _join_rows(plan):
    """Output rows of every join that ran, from the executed plan's metrics."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "Adaptive" in name:
            todo.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in name:
            todo.append(node.plan())
            continue
        if "Join" in name:
            out.append(f"rows:{node.metrics().apply('numOutputRows').value()}")
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out
