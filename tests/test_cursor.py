import datetime as dt

import pytest

from conftest import rows

from levain.operators.cdc import CdcSpec
from levain.sources.cursor import CursorIngest, table_source
from levain.streaming.cdc_target import CdcTarget

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_rows_sharing_the_high_water_mark_are_kept(spark, workdir):
    db = f"{workdir}/db"
    spec = CdcSpec(keys=("id",), sequence_by="updated_at", stored_as_scd_type=1)
    target = CdcTarget(spark, f"{workdir}/t", spec)
    schema = "id long, v string, updated_at timestamp_ntz"
    spark.createDataFrame([(1, "a", T1), (2, "b", T2)], schema).write.mode("overwrite").parquet(db)
    ing = CursorIngest(spark, table_source(lambda: spark.read.parquet(db)), "updated_at", target, f"{workdir}/c")
    ing.run()
    # a row with the same timestamp as the high-water mark arrives after the first read
    spark.createDataFrame([(1, "a", T1), (2, "b", T2), (3, "c", T2)], schema).write.mode("overwrite").parquet(db)
    ing.run()
    assert rows(target.read(), "id", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert ing.high_water() == (T2, 1)


def test_rows_without_a_cursor_value_refuse_every_load_or_are_kept_aside(spark, workdir):
    db, schema = f"{workdir}/db", "id long, v string, updated_at timestamp_ntz"
    spec = CdcSpec(keys=("id",), sequence_by="updated_at", stored_as_scd_type=1)
    target = CdcTarget(spark, f"{workdir}/t", spec)

    def load(data, **kw):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(db)
        ing = CursorIngest(spark, table_source(lambda: spark.read.parquet(db)), "updated_at", target, f"{workdir}/c", **kw)
        ing.run()
        return ing

    load([(1, "a", T1), (2, "b", T1)])
    more = [(1, "a", T1), (2, "b", T1), (3, "c", None), (4, "d", T2)]
    with pytest.raises(ValueError, match="updated_at"):
        load(more)
    assert rows(target.read(), "id") == [(1,), (2,)]
    aside = {"null_cursor": "quarantine", "quarantine": f"{workdir}/q"}
    ing = load(more, **aside)
    assert rows(target.read(), "id") == [(1,), (2,), (4,)] and rows(ing.quarantined(), "id", "quarantine_reason") == [(3, "updated_at IS NULL")]
    ing = load([*more[:2], (3, "c", T2), (4, "d", T2)], **aside)
    assert rows(target.read(), "id") == [(1,), (2,), (3,), (4,)] and ing.quarantined().count() == 0
    with pytest.raises(ValueError):
        load(more, null_cursor="quarantine")


def test_look_back_finds_late_commits_once(spark, workdir):
    db, schema = f"{workdir}/db", "id long, v string, at long"
    target = CdcTarget(spark, f"{workdir}/t", CdcSpec(keys=("id",), sequence_by="at"))
    for data in ([(1, "a", 10), (2, "b", 20)], [(1, "a", 10), (2, "b", 20), (3, "late", 15), (4, "too late", 5)]):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(db)
        CursorIngest(spark, table_source(lambda: spark.read.parquet(db)), "at", target, f"{workdir}/c", look_back=8).run()
    assert rows(target.read(), "id", "v", "__START_AT", "__END_AT") == [(1, "a", 10, None), (2, "b", 20, None), (3, "late", 15, None)]
