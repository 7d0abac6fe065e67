"""Physical plan checks: no pair explosion, no Python in the plan, pushdown."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.plans import registry
from pitwise.sources.inputs import Inputs
from tests.conftest import frame

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cross_join_and_no_python(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_censor_reaches_the_scan(spark, tmp_path):
    events = frame(
        spark,
        "account_no string, pay_time timestamp, event_code string, device_id string, city string, pay_order_no string",
        [("a" * 19, datetime(2020, 1, 1), "E", "d", "c", "p")],
    )
    path = str(tmp_path / "events")
    events.write.parquet(path)
    inputs = Inputs.from_parquet(spark, {"device_events": path})
    accounts = frame(spark, "cust_ids string, time_censor timestamp, acct_no string", [("c", datetime(2021, 1, 1), "a" * 19)])
    df = op.device_events_asof(accounts, inputs["device_events"], censor="2021-01-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(pay_time), LessThan(pay_time" in plan.replace("IsNotNull(account_no), ", "")
    assert "ReadSchema: struct<account_no:string,pay_time:timestamp" in plan
    assert df.count() == 1


def test_materialised_job_reads_back_stages(spark):
    from pitwise.plans.registry import fixture_job

    job = fixture_job(spark, SF, materialize=True)
    assert job.cohort.count() == fixture_job(spark, SF).cohort.count()
    plan = job.accounts._jdf.queryExecution().executedPlan().toString()
    assert "pitwise/" in plan  # read from the written stage


def test_job_writes_published_stages(spark, tmp_path):
    from pitwise.plans.registry import fixture_job

    job = fixture_job(spark, SF)
    out = job.write(str(tmp_path / "out"), stages=("cohort", "od_any"))
    assert spark.read.parquet(out["cohort"]).count() == job.cohort.count()
    assert set(spark.read.parquet(out["od_any"]).columns) == {"cust_ids", "overdue_record_new_dummy"}


def test_censor_reaches_the_scan_of_text_and_zoneless_times(spark, tmp_path):
    rows = [("a" * 19, "2020.03.01 10:00:00", "E", "d", "c", "p"), ("a" * 19, "2021-12-31 23:59:59", "E", "d", "c", "p"), ("a" * 19, "2022-01-02", "E", "d", "c", "p")]
    text = frame(spark, "account_no string, pay_time string, event_code string, device_id string, city string, pay_order_no string", rows)
    plain = text.withColumn("pay_time", F.to_timestamp(F.translate("pay_time", ".", "-")).cast("timestamp_ntz"))
    accounts = frame(spark, "cust_ids string, time_censor timestamp, acct_no string", [("c", datetime(2021, 6, 1), "a" * 19)])
    for name, df, pushed in (("text", text, "LessThan(pay_time,2022)"), ("plain", plain, "LessThan(pay_time,2021-06-03T00:00")):
        path = str(tmp_path / name)
        df.write.parquet(path)
        inputs = Inputs.from_parquet(spark, {"device_events": path})
        censor = "2021-06-01 00:00:00"
        out = op.device_events_asof(accounts, inputs.before("device_events", "pay_time", censor), censor=censor)
        assert pushed in out._jdf.queryExecution().executedPlan().toString()
        assert [r.pay_time for r in out.collect()] == [datetime(2020, 3, 1, 10)]


def test_job_writes_tables(spark):
    from pitwise.plans.registry import fixture_job

    job = fixture_job(spark, SF)
    out = job.write("pitwise_test_", stages=("cohort", "accounts"), fmt="table")
    try:
        assert spark.table(out["accounts"]).count() == job.accounts.count() > 0
        assert "pitwise_test_cohort" in job.cohort._jdf.queryExecution().toString()
    finally:
        for t in out.values():
            spark.sql(f"DROP TABLE {t}")
