import pytest
from pyspark.sql import Observation

from conftest import rows
from levain.operators.expectations import Expectation, Expectations, quarantine

SCHEMA = "id long, lat double, email string"
DATA = [(1, 10.0, "a@b"), (2, 95.0, "nope"), (3, None, "c@d"), (None, 90.0, None), (5, -90.0, "e@f")]


def test_policies_and_counts(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    ex = Expectations([Expectation("valid_lat", "abs(lat) <= 90", "drop"),
                       Expectation("valid_email", "email LIKE '%@%'", "warn")], "t")
    kept = ex.apply(df)
    assert sorted(r.id or 0 for r in kept.collect()) == [0, 1, 5]  # NULL lat is a violation; +-90 pass
    m = {r.expectation: (r.passed_records, r.failed_records) for r in ex.metrics(df).collect()}
    assert m == {"valid_lat": (3, 2), "valid_email": (3, 2)}


def test_null_can_pass_when_asked(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    ex = Expectations([Expectation("valid_lat", "abs(lat) <= 90", "drop")], "t", null_is_violation=False)
    assert ex.apply(df).count() == 4


def test_several_rules_fail_on_one_row(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    ex = Expectations.from_dicts("t", expect_all_or_drop={"a": "abs(lat) <= 90", "b": "id IS NOT NULL",
                                                          "c": "email LIKE '%@%'"})
    assert rows(ex.apply(df), "id") == [(1,), (5,)]
    assert ex.violations(df).count() == 3


def test_fail_aborts(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    ex = Expectations([Expectation("id_not_null", "id IS NOT NULL", "fail")], "t")
    with pytest.raises(Exception, match="id_not_null"):
        ex.apply(df).select("lat").collect()  # the rule fires even when its column is not selected
    assert ex.apply(df.filter("id IS NOT NULL")).count() == 4


def test_observe_counts_without_extra_pass(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    ex = Expectations([Expectation("valid_lat", "abs(lat) <= 90", "drop")], "t")
    observed, obs = ex.observe(df, Observation("t_obs"))
    ex.apply(observed).write.format("noop").mode("overwrite").save()
    assert ex.observed_metrics(obs) == [{"name": "valid_lat", "dataset": "t", "passed_records": 3,
                                         "failed_records": 2}]


def test_quarantine(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    q = quarantine(df, "id IS NULL", "id IS NULL")
    assert q.count() == 1 and set(q.columns) >= {"quarantine_reason", "quarantine_timestamp"}
