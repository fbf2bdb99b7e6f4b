import os
import time

import pytest
from pyspark.sql import types as T

from conftest import rows
from levain.operators.cdc import CdcSpec, check_target_schema
from levain.operators.semantic import SemanticModel
from levain.sources.files import FileIngest
from levain.sources.tables import substitute


def test_target_schema_needs_sequence_typed_system_columns(spark):
    spec = CdcSpec(keys=("k",), sequence_by="ts")
    src = T.StructType([T.StructField("k", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    good = T.StructType(src.fields + [T.StructField("__START_AT", T.TimestampNTZType()),
                                      T.StructField("__END_AT", T.TimestampNTZType())])
    check_target_schema(good, spec, src)
    with pytest.raises(ValueError):
        check_target_schema(T.StructType(src.fields), spec, src)
    with pytest.raises(ValueError):
        check_target_schema(T.StructType(src.fields + [T.StructField("__START_AT", T.StringType()),
                                                       T.StructField("__END_AT", T.StringType())]), spec, src)


def test_semantic_model_validates_names(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "p string, q long")
    m = SemanticModel.over_columns(df)
    assert rows(m.query(["p"], ["count"])) == [("a", 2), ("b", 1)]
    with pytest.raises(KeyError):
        m.query(["nope"], ["count"])


def test_substitute():
    assert substitute("SELECT * FROM ${catalog}.gold.t", {"catalog": "dev"}) == "SELECT * FROM dev.gold.t"
    with pytest.raises(KeyError):
        substitute("${missing}", {})


def test_byte_throttle_and_parquet_ingest(spark, workdir):
    root = workdir.replace("file:", "")
    for i in range(3):
        spark.createDataFrame([(i, f"r{i}")], "id long, v string").coalesce(1).write.parquet(f"{root}/in/p{i}")
        time.sleep(0.05)
    seen = []
    ing = FileIngest(spark, path=f"{root}/in/p*/*.parquet", target=f"{root}/bronze", checkpoint=f"{root}/ckpt",
                     schema_location=f"{root}/schema", format="parquet", max_bytes_per_trigger=1)
    ing.run(on_batch=lambda b, r: seen.append(r.count()))
    assert seen == [1, 1, 1]  # each file is larger than one byte: one file per batch
    assert rows(ing.read(), "id", "v") == [(0, "r0"), (1, "r1"), (2, "r2")]
    assert os.path.isdir(f"{root}/bronze")


def test_materialized_view_reports_expectations(spark, workdir):
    from levain.operators.expectations import Expectation, Expectations
    from levain.plans.eventlog import EventLog, quality_report
    from levain.sources.tables import Lakehouse
    lh = Lakehouse(spark, catalog=f"t{abs(hash(workdir)) % 10**6}", root=f"{workdir}/lh")
    lh.setup()
    log = EventLog(spark, f"{workdir}/log", "p")
    log.create_update("u1")
    df = spark.createDataFrame([(1, "a@b"), (2, "nope"), (3, None)], "id long, email string")
    rules = Expectations([Expectation("valid_email", "email LIKE '%@%'", "warn"),
                          Expectation("id_small", "id < 3", "drop")], "customers_silver")
    out = lh.materialized_view("silver", "customers", df, expectations=rules, event_log=log, update_id="u1")
    assert out.count() == 2
    assert rows(quality_report(log.read())) == [("customers_silver", "id_small", 2, 1),
                                                ("customers_silver", "valid_email", 1, 2)]


def test_lakehouse_layers_preview_and_teardown(spark, workdir):
    from levain.sources.tables import Lakehouse, preview, scan_table
    lh = Lakehouse(spark, catalog=f"l{abs(hash(workdir)) % 10**6}", root=f"{workdir}/lh2")
    assert lh.setup() == [lh.database(x) for x in ("bronze", "silver", "gold")]
    df = spark.range(50).withColumnRenamed("id", "k")
    lh.materialized_view("bronze", "t", df, comment="it's a test", properties={"quality": "Bronze"})
    assert preview(spark, lh.name("bronze", "t"), 5).count() == 5
    assert scan_table(spark, lh.name("bronze", "t")).count() == 50
    assert rows(lh.properties("bronze", "t").filter("key = 'quality'"), "value") == [("Bronze",)]
    lh.drop("bronze", "t")
    assert lh.list_tables("bronze").filter("NOT isTemporary").count() == 0
    lh.teardown()
    assert not [d for d in spark.catalog.listDatabases() if d.name.startswith(lh.catalog)]
    with pytest.raises(ValueError):
        Lakehouse(spark, catalog="bad name")


def test_json_paths(spark):
    from pyspark.sql import functions as F

    from levain.functions.json import json_path, parse_json_array, to_json_path
    assert to_json_path("flow_progress:data_quality:expectations") == "$.flow_progress.data_quality.expectations"
    assert to_json_path("flow_definition.output_dataset") == "$.flow_definition.output_dataset"
    assert to_json_path("$.a") == "$.a"
    df = spark.createDataFrame([('{"a": {"b": [{"n": "x", "v": 1}]}, "k": 7}',), ("{}",)], "d string")
    got = df.select(json_path("d", "k").alias("k"), F.size(parse_json_array(json_path("d", "a:b"),
                                                                             "struct<n: string, v: int>")).alias("n"))
    assert rows(got) == [("7", 1), (None, None)]  # missing path: NULL array (explode gives no row)


def test_a_refresh_that_breaks_off_leaves_the_view(spark, workdir):
    from levain.sources.tables import Lakehouse

    lh = Lakehouse(spark, catalog="broken", root=f"{workdir}/lake")
    lh.setup()
    try:
        first = lh.materialized_view("gold", "v", spark.range(3))
        with pytest.raises(Exception, match="broke off"):
            lh.materialized_view("gold", "v", spark.range(5).filter("IF(id = 4, CAST(raise_error('broke off') AS BOOLEAN), TRUE)"))
        assert spark.table("broken_gold.v").count() == 3
        lh.materialized_view("gold", "v", spark.table("broken_gold.v").selectExpr("id + 10 AS id"))  # a view may even read itself
        assert rows(spark.table("broken_gold.v"), "id") == [(10,), (11,), (12,)] and first.count() == 3
        lh.materialized_view("gold", "v", spark.range(2).selectExpr("id", "'x' AS more"))
        assert spark.table("broken_gold.v").columns == ["id", "more"]
    finally:
        lh.teardown()
