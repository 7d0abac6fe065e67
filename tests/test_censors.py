"""Several censors per customer equal one run per censor."""

import pytest
from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.operators import censors
from pitwise.sources.fixture import AMOUNT_CAP, CENSOR, fixture_inputs

SF = "/root/testdata/sf0.001"
TIMES = ("1993-05-20 00:00:00", "1996-02-29 12:00:00", "1998-12-20 08:00:00", CENSOR)


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def setting(spark):
    """Inputs, accounts, the cohort with one to four censors a customer, and cohorts of one censor each."""
    inputs = fixture_inputs(spark, SF)
    ids = op.cohort_censor(inputs["credits"], CENSOR).select("cust_ids")
    digit = F.substring("cust_ids", 18, 1).cast("int")
    single = [ids.where(digit >= k).withColumn("time_censor", F.lit(t).cast("timestamp")) for k, t in enumerate(TIMES)]
    cohort = single[0]
    for s in single[1:]:
        cohort = cohort.unionByName(s)
    cohort = cohort.unionByName(single[0])  # a pair twice is one
    return inputs, cohort, single


def accounts_of(inputs, cohort):
    return op.account_link(cohort, inputs["members"])


def union_of(single, one):
    out = []
    for cohort in single:
        t = cohort.select("time_censor").first()[0]
        out += rows(one(cohort).withColumn("time_censor", F.lit(t)))
    return sorted(out, key=repr)


def test_events_at_censors(spark, setting):
    inputs, cohort, single = setting
    accounts = accounts_of(inputs, cohort).select("cust_ids", "acct_no").distinct()
    got = censors.event_code_rates_at(cohort, accounts, inputs["device_events"])
    one = lambda c: op.event_code_rates(op.device_events_asof(accounts_of(inputs, c), inputs["device_events"]))
    assert rows(got) == union_of(single, one) and got.count() > 0


def test_payments_at_censors(spark, setting):
    inputs, cohort, single = setting
    accounts = accounts_of(inputs, cohort).select("cust_ids", "acct_no").distinct()
    lines = censors.payment_slots(cohort, accounts, inputs["orders"], inputs["order_lines"], amount_cap=AMOUNT_CAP)
    pay = lambda c: op.order_payments_asof(accounts_of(inputs, c), inputs["orders"], inputs["order_lines"], amount_cap=AMOUNT_CAP)
    for got, one in ((censors.spend_summary_at(cohort, lines), op.spend_summary), (censors.credit_pay_ratios_at(cohort, lines), op.credit_pay_ratios)):
        want = union_of(single, lambda c, one=one: one(pay(c)))
        assert rows(got) == want and len(want) > 50


def test_repayments_at_censors(spark, setting):
    inputs, cohort, single = setting
    got = censors.repay_outcome_rates_at(cohort, inputs["loans"], inputs["repayments"])
    want = union_of(single, lambda c: op.repay_outcome_rates(c, inputs["loans"], inputs["repayments"]))
    assert rows(got) == want and len(want) > 50


def test_facts_are_read_once_and_not_multiplied(spark, setting):
    inputs, cohort, _ = setting
    accounts = accounts_of(inputs, cohort).select("cust_ids", "acct_no").distinct()
    lines = censors.payment_slots(cohort, accounts, inputs["orders"], inputs["order_lines"], amount_cap=AMOUNT_CAP)
    plan = censors.spend_summary_at(cohort, lines)._jdf.queryExecution().optimizedPlan().toString()
    scans = [x for x in plan.splitlines() if "Relation" in x and "l_orderkey" in x]
    assert len(scans) == 1
    most = op.order_payments_asof(accounts_of(inputs, cohort), inputs["orders"], inputs["order_lines"], amount_cap=AMOUNT_CAP)
    assert lines.count() < most.count()  # which has a row per censor


def test_edges_of_slots_nulls_and_an_empty_cohort(spark):
    ts = lambda c: F.col(c).cast("timestamp")
    cohort = spark.createDataFrame([("c", "2020-01-01"), ("c", "2020-03-01"), ("d", "2020-01-01"), ("c", None)], "cust_ids string, t string").select("cust_ids", ts("t").alias("time_censor"))
    accounts = spark.createDataFrame([("c", "a" * 19), ("d", "b" * 19)], "cust_ids string, acct_no string")
    events = [("a" * 19, "2019-12-31 23:59:59", "E0506", "x"), ("a" * 19, "2020-01-01", "E0506", "x"), ("a" * 19, "2020-03-01", "E0506", "x"), ("a" * 19, None, "E0506", "x"), ("b" * 19, "2020-02-01", "E0506", None)]
    df = spark.createDataFrame(events, "account_no string, t string, event_code string, device_id string").select("account_no", ts("t").alias("pay_time"), "event_code", "device_id")
    out = {(r.cust_ids, r.time_censor.month): r for r in censors.event_code_rates_at(cohort, accounts, df).collect()}
    assert set(out) == {("c", 1), ("c", 3)}  # d has nothing before its censor
    assert out["c", 3].E0506_avg == pytest.approx(2 / ((60 * 86400 + 1) / 86400))
    assert censors.event_code_rates_at(cohort.limit(0), accounts, df).count() == 0
