"""Registered queries: every operator D1-D28 run on the test tables, and what
the library adds to them (several censors a customer, the report of values
that cannot be parsed).

Each query takes ``(spark, sf_dir)``, builds the logical inputs from the
tables under ``sf_dir`` (``sources.fixture``) and returns one stage of the
feature job over the whole tables. Decimal columns are presented as double.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwise import operators as op
from pitwise.operators import censors
from pitwise.operators.history import Days
from pitwise.plans.history import LoanHistory
from pitwise.plans.job import FeatureJob, JobParams
from pitwise.plans.session import ensure_checkpoint_dir
from pitwise.sources import fixture
from pitwise.sources.audit import parse_report
from pitwise.sources.inputs import Inputs

FIXTURE_PARAMS = JobParams(
    censor=fixture.CENSOR,
    amount_cap=fixture.AMOUNT_CAP,
    loan_use_period=fixture.LOAN_USE_PERIOD,
    gen2_min_create=fixture.GEN2_MIN_CREATE,
)

# query name -> FeatureJob attribute
STAGES = {
    "cohort_censor": "cohort",
    "account_link": "accounts",
    "device_events_asof": "device_events",
    "order_payments_asof": "payments",
    "credit_pay_ratios": "pay_ratios",
    "spend_summary": "spend",
    "event_code_rates": "event_rates",
    "device_burst_7d": "burst",
    "monthly_device_city_peak": "device_peak",
    "loan_history_counts": "history",
    "repaid_by_censor": "repaid",
    "principal_pay_ratio": "xfd",
    "repay_outcome_rates": "repay_outcomes",
    "latest_report": "latest_report",
    "query_counts_gen1": "gen1_counts",
    "report_flatten": "report_flat",
    "query_counts_gen2": "gen2_counts",
    "generation_merge": "bureau",
    "latest_report_normalised": "latest_report_normalised",
    "loan_settlement_ratios": "settlement",
    "min_gap_lag2": "card_gap",
    "overdue_flag_strict": "od_strict",
    "overdue_flag_any": "od_any",
    "last_loan_profile": "last_loan",
    "feature_assembly": "assembled",
    "derived_features": "features",
    "attach_applications": "applications",
    "credit_age": "final",
}


def fixture_job(spark: SparkSession, sf_dir: str, materialize: bool = False) -> FeatureJob:
    return FeatureJob(fixture.fixture_inputs(spark, sf_dir), FIXTURE_PARAMS, materialize=materialize)


def present(df: DataFrame) -> DataFrame:
    """Decimals as double and times as zone-less timestamps (the SQL
    ``TIMESTAMP`` type of the oracle); other columns unchanged."""

    def show(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return c.cast("timestamp_ntz").alias(f.name)
        return c

    return df.select(*[show(f) for f in df.schema.fields])


# Stages with inputs that several of their parts read: these are written to
# the checkpoint directory once, as in production, and not computed per part.
SHARED = {"gen2_counts", "bureau", "assembled", "features", "applications", "final"}


def _query(stage: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(getattr(fixture_job(spark, sf_dir, materialize=stage in SHARED), stage))

    run.__name__ = stage
    return run


#: Censors of the queries at several censors, and of the last digit of a
#: customer's id, which of them a customer has.
CENSORS = ((fixture.CENSOR, "true"), ("1998-03-01 00:00:00", "{d} % 2 = 0"), ("1996-02-29 12:00:00", "{d} % 3 = 1"))


def _at_censors(spark: SparkSession, sf_dir: str) -> tuple[Inputs, DataFrame, DataFrame]:
    """Inputs, a cohort with one to three censors a customer, and the customers' accounts."""
    inputs = fixture.fixture_inputs(spark, sf_dir)
    ids = op.cohort_censor(inputs["credits"], fixture.CENSOR)
    times = [F.when(F.expr(rule.format(d="cast(substr(cust_ids, 18, 1) as int)")), F.lit(t).cast("timestamp")) for t, rule in CENSORS]
    cohort = ids.select("cust_ids", F.explode(F.array_compact(F.array(*times))).alias("time_censor"))
    return inputs, cohort, op.account_link(ids, inputs["members"]).select("cust_ids", "acct_no")


def event_code_rates_at_censors(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, cohort, accounts = _at_censors(spark, sf_dir)
    return present(censors.event_code_rates_at(cohort, accounts, inputs["device_events"]))


def _payments_at_censors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    inputs, cohort, accounts = _at_censors(spark, sf_dir)
    return cohort, censors.payment_slots(cohort, accounts, inputs["orders"], inputs["order_lines"], amount_cap=fixture.AMOUNT_CAP)


def spend_summary_at_censors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(censors.spend_summary_at(*_payments_at_censors(spark, sf_dir)))


def credit_pay_ratios_at_censors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(censors.credit_pay_ratios_at(*_payments_at_censors(spark, sf_dir)))


def repay_outcome_rates_at_censors(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, cohort, _ = _at_censors(spark, sf_dir)
    return present(censors.repay_outcome_rates_at(cohort, inputs["loans"], inputs["repayments"]))


def input_parse_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_report(fixture.text_inputs(spark, sf_dir))


#: The days of the incremental loan history are added up to these.
HISTORY_DAYS = (date(1996, 8, 17), date(2100, 1, 1))


def loan_history_by_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D10 from a history to which days are added in two runs."""
    inputs = fixture.fixture_inputs(spark, sf_dir)
    days = Days(inputs["loans"], inputs["overdue"], inputs["repayments"])
    history = LoanHistory(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/pitwise/history-{uuid.uuid4().hex}")
    for until in HISTORY_DAYS:
        history.add(days, until)
    return present(history.counts())


ADDED = (
    loan_history_by_days,
    event_code_rates_at_censors,
    spend_summary_at_censors,
    credit_pay_ratios_at_censors,
    repay_outcome_rates_at_censors,
    input_parse_report,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(stage) for name, stage in STAGES.items()} | {q.__name__: q for q in ADDED}
