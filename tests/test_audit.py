"""Values that cannot be parsed are counted and can be refused."""

from dataclasses import replace
from datetime import datetime

import pytest

from pitwise import operators as op
from pitwise.plans.job import FeatureJob
from pitwise.plans.registry import FIXTURE_PARAMS
from pitwise.sources.audit import UnparsedValues, check_parsed, parse_report
from pitwise.sources.fixture import ADAPTERS, fixture_inputs
from pitwise.sources.inputs import Inputs
from tests.conftest import frame

SF = "/root/testdata/sf0.001"
EVENTS = "account_no string, pay_time string, event_code string, device_id string, city string, pay_order_no string"


def report(inputs):
    return {(r["input"], r["column"]): (r.kind, r.given, r.unparsed) for r in parse_report(inputs).collect()}


def test_a_malformed_event_is_reported(spark):
    rows = [("a" * 19, t, "E", "d", "c", "p") for t in ("2020-01-01 10:00:00", "2020.13.45", "soon", "", None)]
    inputs = Inputs.from_frames({"device_events": frame(spark, EVENTS, rows)})
    accounts = frame(spark, "cust_ids string, time_censor timestamp, acct_no string", [("c", datetime(2021, 1, 1), "a" * 19)])
    assert op.device_events_asof(accounts, inputs["device_events"]).count() == 1
    assert report(inputs) == {("device_events", "pay_time"): ("instant", 4, 3)}


def test_days_money_numbers_and_case_of_names(spark):
    overdue = frame(spark, "LOAN_NO string, Start_Date string, STAT_DATE int, overdue_days string", [("l", "2020-01-01", 20200131, "3"), ("l", "x", 20201331, "3,5"), ("l", None, None, None)])
    orders = frame(spark, "buyer_user_no string, merchant_order_id string, amount string, pay_time timestamp, pay_order_id string", [("b", "m", "1e400", None, "p"), ("b", "m", "12.50", None, "p")])
    got = report(Inputs.from_frames({"overdue": overdue, "orders": orders}))
    assert got == {
        ("overdue", "start_date"): ("instant", 2, 1),
        ("overdue", "stat_date"): ("day8", 2, 1),
        ("overdue", "overdue_days"): ("double", 2, 1),
        ("orders", "amount"): ("money", 2, 1),
    }


def test_typed_inputs_are_not_read(spark):
    assert parse_report(fixture_inputs(spark, SF)).count() == 0
    with pytest.raises(ValueError, match="no input"):
        parse_report(Inputs({}))


def test_a_write_is_refused_beyond_the_limit(spark, tmp_path):
    loaders = {n: (lambda a=a: a.spark(spark, SF)) for n, a in ADAPTERS.items()}
    loaders["credits"] = lambda: ADAPTERS["credits"].spark(spark, SF).selectExpr("card_no", "if(credit_date < '1997-01-01', 'n/a', string(credit_date)) AS credit_date")
    job = lambda limit: FeatureJob(Inputs(loaders), replace(FIXTURE_PARAMS, max_unparsed=limit))
    (row,) = job(None).parse_report.collect()
    assert (row["input"], row["column"], row.stored) == ("credits", "credit_date", "string") and 0 < row.unparsed < row.given
    with pytest.raises(UnparsedValues, match=f"credits.credit_date: {row.unparsed} of {row.given}"):
        job(row.unparsed - 1).write(str(tmp_path / "a"), stages=("cohort",))
    assert job(row.unparsed).write(str(tmp_path / "b"), stages=("cohort",))
    assert check_parsed(job(None).parse_report, row.given) == [row]
