"""Days added to a loan history equal one run over all of them."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.operators.history import Days
from pitwise.plans.history import LoanHistory
from tests.conftest import frame
from tests.test_quirks import LOANS, OVERDUE, REPAY

START = datetime(2020, 1, 1)


def made(seed):
    """Loans, overdue records and repayments of a few customers in a month; some loan numbers are repeated, some unknown."""
    rng = random.Random(seed)
    when = lambda: START + timedelta(days=rng.randrange(30), seconds=rng.choice([0, 0, 1, 43_200, 86_399]))
    loans = [(f"l{rng.randrange(60)}", f"c{rng.randrange(6)}", when(), None, None, None, "10" if rng.random() < 0.5 else "2", "RXD", "02") for _ in range(110)]
    overdue = [(f"l{rng.randrange(70)}", None, when().date(), 5.0) for _ in range(40)]
    repay = [(f"l{rng.randrange(70)}", None, None, rng.choice(["200", "200", "500"]), when(), None) for _ in range(60)]
    return loans, overdue, repay


def counts(df):
    return sorted(map(tuple, df.collect()))


def test_days_added_equal_one_run(spark, tmp_path):
    loans, overdue, repay = made(5)
    days = Days(frame(spark, LOANS, loans), frame(spark, OVERDUE, overdue), frame(spark, REPAY, repay))
    history = LoanHistory(spark, str(tmp_path / "h"))
    assert history.until is None and history.counts().count() == 0
    for until in (date(2020, 1, 9), date(2020, 1, 10), date(2020, 2, 1)):
        history.add(days, until)
        assert history.until == until
        cut = days.between(None, F.lit(until))
        want = op.loan_history_counts(op.loan_outcomes(cut.loans, cut.overdue, cut.repayments))
        assert counts(history.counts()) == counts(want), until
    with pytest.raises(ValueError, match="in already"):
        history.add(days, date(2020, 1, 20))


def test_an_addition_that_was_ended_is_made_anew(spark, tmp_path):
    loans, overdue, repay = made(6)
    days = Days(frame(spark, LOANS, loans), frame(spark, OVERDUE, overdue), frame(spark, REPAY, repay))
    path = str(tmp_path / "h")
    # Files without a record, as an ended run leaves them.
    spark.range(4).write.parquet(f"{path}/2020-02-01/loans")
    history = LoanHistory(spark, path)
    history.add(days, date(2020, 2, 1))
    want = op.loan_history_counts(op.loan_outcomes(days.loans, days.overdue, days.repayments))
    assert counts(LoanHistory(spark, path).counts()) == counts(want) and want.count() > 3
