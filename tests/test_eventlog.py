from pyspark.sql import types as T

from conftest import rows
from levain.plans.eventlog import EventLog, flow_report, quality_report


def test_reports_use_only_the_newest_update(spark, workdir):
    log = EventLog(spark, f"{workdir}/log", "pipe")
    log.create_update("u1")
    log.flow_progress("u1", [{"name": "r", "dataset": "d", "passed_records": 100, "failed_records": 100}])
    log.create_update("u2")
    log.flow_progress("u2", [{"name": "r", "dataset": "d", "passed_records": 5, "failed_records": 1},
                             {"name": "s", "dataset": "d", "passed_records": 6, "failed_records": 0}])
    log.flow_progress("u2", [{"name": "r", "dataset": "d", "passed_records": 2, "failed_records": 2}])
    log.flow_progress("u2", [])                       # empty array: no row
    log._append("u2", "flow_progress", {"flow_progress": {"status": "RUNNING"}})  # no expectations
    log.flow_definition("u2", "silver.t", ["bronze.t"], "merge", T.StructType([T.StructField("a", T.LongType())]))
    q = rows(quality_report(log.read()))
    assert q == [("d", "r", 7, 3), ("d", "s", 6, 0)]
    f = flow_report(log.read()).collect()
    assert len(f) == 1 and f[0].flow_name == "silver.t" and f[0].input_flow_names == '["bronze.t"]'
