"""Invariants on the whole (small) test tables, and a few more rules on hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.plans.registry import fixture_job
from pitwise.sources.fixture import CENSOR
from tests.conftest import frame
from tests.test_quirks import COHORT, LOANS, OVERDUE

SF = "/root/testdata/sf0.001"

ONE_ROW_PER_CUSTOMER = (
    "cohort",
    "pay_ratios",
    "spend",
    "event_rates",
    "burst",
    "device_peak",
    "history",
    "repaid",
    "xfd",
    "repay_outcomes",
    "latest_report",
    "gen1_counts",
    "gen2_counts",
    "bureau",
    "latest_report_normalised",
    "settlement",
    "card_gap",
    "od_strict",
    "od_any",
)

RATIOS = {
    "pay_ratios": ["credit_pay_ratio_all", "credit_pay_ratio_max", "credit_pay_amount_ratio_all"],
    "history": ["all_odds_ratio", "xfd_odds_ratio"],
    "repay_outcomes": ["s_f_rate"],
    "settlement": ["settled_loan_cnt_ratio_1y"],
}


@pytest.fixture(scope="module")
def job(spark):
    return fixture_job(spark, SF)


@pytest.mark.parametrize("stage", ONE_ROW_PER_CUSTOMER)
def test_one_row_per_customer(job, stage):
    df = getattr(job, stage)
    assert df.count() == df.select("cust_ids").distinct().count() > 0


def test_nothing_at_or_after_the_censor(job):
    for stage in ("device_events", "payments"):
        df = getattr(job, stage)
        assert df.filter(F.col("pay_time") >= F.col("time_censor")).count() == 0
        assert df.count() > 0


@pytest.mark.parametrize("stage", sorted(RATIOS))
def test_ratios_within_unit_interval(job, stage):
    df = getattr(job, stage)
    for c in RATIOS[stage]:
        bad = df.filter((F.col(c) < 0) | (F.col(c) > 1)).count()
        assert bad == 0, c


def test_features_row_per_cohort_customer_without_ties(job):
    ties = job.last_loan.groupBy("cust_ids").count().filter("count > 1").count()
    assert job.features.count() == job.cohort.count() + ties


# --- hand-made rows -------------------------------------------------------------


def _loan(no, cust, t, xfd=False):
    codes = ("10", "RXD", "02") if xfd else ("20", "CASH", "02")
    return (no, cust, t, Decimal("100.00"), 3.0, 0.1, *codes)


def test_overdue_flags_thresholds(spark):
    censor = datetime(2021, 1, 10, 12)
    cohort = frame(spark, COHORT, [(c, censor) for c in "abcdef"])
    loans = frame(
        spark,
        LOANS,
        [
            _loan("La", "a", datetime(2020, 1, 1)),
            _loan("Lb", "b", datetime(2020, 1, 1)),
            _loan("Lc", "c", datetime(2020, 1, 1)),
            _loan("Ld", "d", datetime(2020, 1, 1), xfd=True),
            _loan("Le", "e", datetime(2020, 1, 1)),
            _loan("Lf", "f", datetime(2020, 1, 1)),
        ],
    )
    overdue = frame(
        spark,
        OVERDUE,
        [
            ("La", datetime(2021, 1, 7, 23), date(2021, 1, 9), 4.0),  # day 7 < censor - 3 days (7th 12:00)
            ("Lb", datetime(2021, 1, 7, 13), date(2021, 1, 10), 4.0),  # day start 7th 00:00: counts; stat = censor day
            ("Lc", datetime(2021, 1, 8, 0), date(2021, 1, 11), 9.0),  # 8th is not before 7th 12:00
            ("Ld", datetime(2020, 1, 1), date(2020, 1, 5), 9.0),  # consumer loan: not in the strict flag
            ("Le", datetime(2020, 1, 1), date(2020, 1, 5), 3.0),  # 3 days is not more than 3
            ("Lf", datetime(2020, 1, 1), date(2020, 1, 5), 0.0),  # zero days: in neither flag
        ],
    )
    strict = {r.cust_ids for r in op.overdue_flag_strict(cohort, loans, overdue).collect()}
    anyf = {r.cust_ids for r in op.overdue_flag_any(cohort, loans, overdue).collect()}
    assert strict == {"a", "b"}
    # stat day must be before the censor's day: b's record is on that day
    assert anyf == {"a", "d", "e"}


def test_censor_month_ratio_uses_calendar_month(spark):
    payments = frame(
        spark,
        "cust_ids string, time_censor timestamp, pay_time timestamp, pay_order_id string, amount decimal(18,2), "
        "pay_type string",
        [
            ("c", datetime(2021, 3, 15), datetime(2021, 3, 1), "p1", Decimal("30"), "CREDIT"),
            ("c", datetime(2021, 3, 15), datetime(2021, 3, 2), "p2", Decimal("10"), "DEBIT"),
            ("c", datetime(2021, 3, 15), datetime(2021, 2, 27), "p3", Decimal("10"), "CREDIT"),
        ],
    )
    r = op.credit_pay_ratios(payments).first()
    assert r.credit_pay_amount_ratio_this_month == 0.75
    assert r.credit_pay_ratio_max == 1.0
    assert r.credit_pay_ratio_all == 2 / 3


def test_applications_have_no_time_bound(spark):
    features = frame(spark, "cust_ids string, x double", [("c", 1.0), ("d", 2.0)])
    loans = frame(
        spark,
        LOANS,
        [_loan("L1", "c", datetime(2030, 1, 1), xfd=True), _loan("L2", "c", None, xfd=True), _loan("L3", "c", datetime(2020, 1, 1))],
    )
    rows = op.attach_applications(features, loans).collect()
    assert sorted((r.cust_ids, r.loan_no) for r in rows) == [("c", "L1"), ("c", "L2"), ("d", None)]
    assert all(r.loan_apply_rate is None for r in rows)


def test_fixture_censor_is_mid_month():
    assert CENSOR.endswith("10:30:00") and not CENSOR[8:10] == "01"


# The 66 columns of the wide feature row, by group.
FEATURE_ROW = (
    ["cust_ids", "time_censor"]
    + ["credit_pay_ratio_all", "credit_pay_ratio_max", "credit_pay_amount_ratio_all"]
    + ["credit_pay_amount_ratio_max", "credit_pay_amount_ratio_this_month"]
    + ["merchant_order_cnt", "merchant_order_amt_avg", "merchant_order_credit_pay_amt_avg", "rxd_pay_amt_ratio"]
    + ["LOGIN_POST_all", "E0906_all", "E0506_avg", "LOGIN_POST_avg", "E0406_avg", "E0906_avg", "E0418_avg"]
    + ["E0129_avg", "E0428_avg", "E0424_avg", "E0425_avg", "E0434_avg", "7days_device_cnt_more_than4"]
    + ["all_good_cnt", "all_bad_cnt", "xfd_good_cnt", "xfd_bad_cnt", "all_odds_ratio", "xfd_odds_ratio"]
    + ["query_cnt_3m", "query_cnt_6m", "query_cnt_12m", "query_loan_cnt_3m", "query_loan_cnt_6m"]
    + ["query_loan_cnt_12m", "query_card_cnt_3m", "query_card_cnt_12m", "query_loanmanage_24m", "query_selfquery_1m"]
    + ["xfd_apply_amt_cum", "xfd_int_pay_sum", "xfd_principal_pay_ratio"]
    + ["settled_loan_cnt_ratio_1y", "settled_loan_amount_ratio_1y", "lag2_loan_card_time_diff_min"]
    + ["month_machine_finger_loan_use_device_cnt_max", "month_machine_finger_loan_use_city_cnt_max"]
    + ["od10_dummy", "overdue_record_new_dummy"]
    + ["last_apply_amount", "last_apply_rate", "last_apply_term", "all_xfd_loan_cnt"]
    + ["suc_cnt", "fail_cnt", "p_sum", "s_f_rate", "rxd_principal_pay_cum"]
    + ["dow", "id_num", "id_head_1", "hr", "age", "good_ratio", "bad_ratio"]
)


def test_feature_row_has_the_66_columns(job):
    assert len(FEATURE_ROW) == len(set(FEATURE_ROW)) == 66
    assert sorted(job.features.columns) == sorted(FEATURE_ROW)
    final = job.final.columns
    assert set(final) - set(FEATURE_ROW) == {"credit_age", "credit_quota"}
    extra = set(job.applications.columns) - set(FEATURE_ROW)
    assert extra == {"loan_no", "loan_apply_amount", "loan_apply_rate", "loan_apply_term", "loan_apply_time"}
