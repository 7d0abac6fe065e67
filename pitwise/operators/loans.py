"""Loan, repayment and overdue features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.exprs import flag_sum, no_money, ratio
from pitwise.functions.joins import looked_up
from pitwise.functions.time import as_datetime, day_start
from pitwise.operators.asof import Censor, prefilter
from pitwise.operators.sweep import coverage_totals


def is_xfd() -> Column:
    """The consumer-loan product; null codes make it false."""
    return (
        (F.col("partner_no") == codes.XFD_PARTNER_NO)
        & (F.col("product_no") == codes.XFD_PRODUCT_NO)
        & (F.col("quota_type") == codes.XFD_QUOTA_TYPE)
    )


def valid_loans(loans: DataFrame) -> DataFrame:
    """Loans with an application time and a non-empty customer id."""
    return loans.filter(F.col("loan_time").isNotNull() & (F.length("cust_ids") > 0))


def cohort_loans(cohort: DataFrame, loans: DataFrame) -> DataFrame:
    """The valid loans of the cohort's customers, as they are."""
    return valid_loans(loans).join(cohort.select("cust_ids"), "cust_ids", "left_semi")


def of_loans(rows: DataFrame, loans: DataFrame) -> DataFrame:
    """The overdue records or repayments ``rows`` of ``loans``, as they are."""
    return rows.join(looked_up(loans.select("loan_no").distinct()), "loan_no", "left_semi")


# --- D10 -------------------------------------------------------------------


def history_loans(loans: DataFrame) -> DataFrame:
    """``cust_ids, loan_no, loan_time, x``: the valid loans with a number; ``x`` is 1.0 for the consumer-loan product."""
    return valid_loans(loans).filter(F.col("loan_no").isNotNull()).select(
        "cust_ids",
        "loan_no",
        "loan_time",
        F.when(is_xfd(), F.lit(1.0)).otherwise(F.lit(0.0)).alias("x"),
    )


def successful(repayments: DataFrame) -> DataFrame:
    return repayments.filter(
        F.col("loan_no").isNotNull() & F.col("apply_time").isNotNull() & (F.col("status") == codes.REPAY_OK)
    )


def loan_outcomes(
    loans: DataFrame,
    overdue: DataFrame,
    repayments: DataFrame,
    cohort: DataFrame | None = None,
) -> DataFrame:
    """Each valid loan row with its first overdue day and first repayment.

    With a ``cohort``, of its customers only: their ids select the loans, the
    loans' numbers the overdue records and repayments, before anything is
    aggregated.
    """
    base = history_loans(loans)
    if cohort is not None:
        base = base.join(cohort.select("cust_ids"), "cust_ids", "left_semi")
        overdue, repayments = of_loans(overdue, base), of_loans(repayments, base)
    od = overdue.groupBy("loan_no").agg(F.min("stat_date").alias("od_day"))
    paid = successful(repayments).groupBy("loan_no").agg(F.min("apply_time").alias("pt"))
    return base.join(looked_up(od), "loan_no", "left").join(looked_up(paid), "loan_no", "left")


def history_points(d: DataFrame, keys: list[str]) -> DataFrame:
    """Edges and query points of the loan-history sweep.

    For a later loan L at time t0, an earlier loan L' (time t1) counts as
    good if it was repaid before t0 and its first overdue day (if any) is
    after t0's day; bad if its first overdue day is on or before t0's day.
    As sets of t0 these are intervals; the edges below open and close them.
    """
    t1 = F.unix_micros("loan_time")
    pt = F.unix_micros("pt")
    od0 = F.unix_micros(F.col("od_day").cast("timestamp"))
    good_lo = F.greatest(t1, pt) + 1
    good_open = pt.isNotNull() & (F.col("od_day").isNull() | (good_lo < od0))
    bad_lo = F.greatest(t1 + 1, od0)

    def edge(t: Column, d_any=0.0, d_good=0.0, d_bad=0.0) -> Column:
        return F.struct(
            t.alias("t"),
            F.lit(0).alias("kind"),
            F.lit(0).alias("q"),
            F.lit(d_any).alias("d_any"),
            F.lit(d_good).alias("d_good"),
            F.lit(d_bad).alias("d_bad"),
        )

    edges = F.array(
        edge(t1 + 1, d_any=1.0),
        edge(F.when(good_open, good_lo), d_good=1.0),
        edge(F.when(good_open & F.col("od_day").isNotNull(), od0), d_good=-1.0),
        edge(F.when(F.col("od_day").isNotNull(), bad_lo), d_bad=1.0),
        F.struct(
            t1.alias("t"),
            F.lit(1).alias("kind"),
            F.lit(1).alias("q"),
            F.lit(0.0).alias("d_any"),
            F.lit(0.0).alias("d_good"),
            F.lit(0.0).alias("d_bad"),
        ),
    )
    pts = d.select(*keys, "x", F.explode(edges).alias("e")).filter(F.col("e.t").isNotNull())
    return pts.select(
        *keys,
        "e.t",
        "e.kind",
        "e.q",
        "e.d_any",
        "e.d_good",
        "e.d_bad",
        (F.col("x") * F.col("e.d_good")).alias("d_xgood"),
        (F.col("x") * F.col("e.d_bad")).alias("d_xbad"),
    )


#: What a pair of loans adds to: any, good and bad earlier loans, and those of the consumer-loan product.
HISTORY = ["d_any", "d_good", "d_bad", "d_xgood", "d_xbad"]


def loan_history_counts(outcomes: DataFrame, bucket_days: int = 1) -> DataFrame:
    """Over all pairs (loan, earlier loan of the same customer, other
    loan number), how many earlier loans were good / bad at the later loan's
    time, for all loans and for the consumer-loan product; smoothed odds.

    ``outcomes`` are those of ``loan_outcomes``. No cohort and no censor:
    every customer with at least one such pair gets a row. Pairs are never materialised: the counts are
    coverage sums of a sweep (``sweep.coverage_totals``). Pairs of rows that
    share a loan number are excluded by running the same sweep over the
    rare repeated loan numbers only and subtracting.
    """
    return history_columns(history_totals(outcomes, bucket_days))


def history_totals(outcomes: DataFrame, bucket_days: int = 1) -> DataFrame:
    """``cust_ids`` and the sums of ``HISTORY`` over the customer's pairs of loans, 0.0 without any."""
    totals = coverage_totals(history_points(outcomes, ["cust_ids"]), ["cust_ids"], HISTORY, bucket_days)
    repeated = outcomes.groupBy("cust_ids", "loan_no").count().filter(F.col("count") > 1).drop("count")
    same = coverage_totals(
        history_points(outcomes.join(repeated, ["cust_ids", "loan_no"], "left_semi"), ["cust_ids", "loan_no"]),
        ["cust_ids", "loan_no"],
        HISTORY,
        bucket_days,
    )
    return less_same_number(totals, same)


def less_same_number(totals: DataFrame, same: DataFrame) -> DataFrame:
    """``totals`` without the pairs of rows that share a loan number (``same``, by customer and number)."""
    same = same.groupBy("cust_ids").agg(*[F.sum(m).alias(f"same_{m}") for m in HISTORY])
    return totals.join(same, "cust_ids", "left").select(
        "cust_ids",
        *[(F.col(m) - F.coalesce(F.col(f"same_{m}"), F.lit(0.0))).alias(m) for m in HISTORY],
    )


def history_columns(totals: DataFrame) -> DataFrame:
    """The columns of D10, of the customers with at least one pair."""
    return totals.filter(F.col("d_any") > 0).select(
        "cust_ids",
        F.col("d_good").alias("all_good_cnt"),
        F.col("d_bad").alias("all_bad_cnt"),
        F.col("d_xgood").alias("xfd_good_cnt"),
        F.col("d_xbad").alias("xfd_bad_cnt"),
        ratio(F.col("d_bad"), F.col("d_good") + F.col("d_bad") + codes.ODDS_SMOOTH).alias("all_odds_ratio"),
        ratio(F.col("d_xbad"), F.col("d_xgood") + F.col("d_xbad") + codes.ODDS_SMOOTH).alias("xfd_odds_ratio"),
    )


# --- D11, D12 --------------------------------------------------------------


def repaid_by_censor(
    cohort: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    censor: Censor = None,
) -> DataFrame:
    """Principal and interest of successful repayments of a customer's
    consumer loans made before the censor; 0.0 when there are none.

    One row per cohort customer: ``xfd_int_pay_sum``, ``xfd_p_pay_sum``.
    """
    xfd = valid_loans(loans).filter(is_xfd()).select("loan_no", "cust_ids")
    rep = repayments.filter(
        F.col("loan_no").isNotNull() & F.col("apply_time").isNotNull() & (F.col("status") == codes.REPAY_OK)
    ).select("loan_no", "principal", "interest", "status", "apply_time", "debit_time")
    # The cohort's loans first: only their repayments are made distinct.
    own = cohort.select("cust_ids", "time_censor").join(xfd, "cust_ids", "inner").distinct()
    paid = (
        prefilter(rep, "apply_time", censor).join(looked_up(own), "loan_no", "inner")
        .filter(F.col("apply_time") < F.col("time_censor"))
        .distinct()
        .groupBy("cust_ids")
        .agg(
            F.sum(F.coalesce(F.col("interest"), no_money())).alias("i_sum"),
            F.sum(F.coalesce(F.col("principal"), no_money())).alias("p_sum"),
        )
    )
    return cohort.select("cust_ids").join(paid, "cust_ids", "left").select(
        "cust_ids",
        F.coalesce(F.col("i_sum").cast("double"), F.lit(0.0)).alias("xfd_int_pay_sum"),
        F.coalesce(F.col("p_sum").cast("double"), F.lit(0.0)).alias("xfd_p_pay_sum"),
    )


def principal_pay_ratio(cohort: DataFrame, loans: DataFrame, repaid: DataFrame) -> DataFrame:
    """Consumer-loan amount applied for before the censor, and repaid
    principal over it (-0.1 when nothing was applied for).

    Loans are distinct on (customer, time, amount), as the definition has
    it. One row per cohort customer, with the D11 sums alongside.
    """
    applied = valid_loans(loans).filter(is_xfd()).select("cust_ids", "loan_time", "loan_amount").distinct()
    # Inner join, then aggregate: a customer with very many loans stays
    # splittable; customers without any get 0.0 from the final left join.
    sums = (
        cohort.select("cust_ids", "time_censor")
        .join(applied, "cust_ids", "inner")
        .groupBy("cust_ids")
        .agg(
            F.sum(F.when(F.col("loan_time") < F.col("time_censor"), F.col("loan_amount")).otherwise(no_money()))
            .cast("double")
            .alias("amt"),
            F.lit(True).alias("applied"),
        )
    )
    # No loan is 0.0, as is one after the censor; only earlier loans without
    # an amount give null.
    amount = F.when(F.col("applied"), F.col("amt")).otherwise(F.lit(0.0))
    cum = cohort.select("cust_ids").join(sums, "cust_ids", "left").select(
        "cust_ids", amount.alias("xfd_apply_amt_cum")
    )
    out = cum.join(repaid, "cust_ids", "left")
    return out.select(
        "cust_ids",
        "xfd_apply_amt_cum",
        "xfd_int_pay_sum",
        "xfd_p_pay_sum",
        F.when(F.col("xfd_apply_amt_cum") > 0.0, ratio(F.col("xfd_p_pay_sum"), F.col("xfd_apply_amt_cum")))
        .otherwise(F.lit(codes.NO_APPLICATION_RATIO))
        .alias("xfd_principal_pay_ratio"),
    )


# --- D13 -------------------------------------------------------------------


def repay_outcome_rates(
    cohort: DataFrame,
    loans: DataFrame,
    repayments: DataFrame,
    censor: Censor = None,
) -> DataFrame:
    """Successful and failed repayments (of loans taken before the
    censor, made before the censor), repaid principal, smoothed fail rate.

    One row per cohort customer with at least one such repayment.
    """
    ln = prefilter(valid_loans(loans).select("loan_no", "cust_ids", "loan_time"), "loan_time", censor)
    rp = repayments.filter(
        F.col("apply_time").isNotNull()
        & F.col("status").isNotNull()
        & F.col("status").isin(codes.REPAY_OK, codes.REPAY_FAIL)
    ).select("loan_no", "principal", "status", "apply_time")
    rp = prefilter(rp, "apply_time", censor)
    ok = F.col("status") == codes.REPAY_OK
    # The cohort's loans first. Only their repayments are made distinct, where
    # the join by loan number has put them: no shuffle of all repayments for it.
    own = cohort.select("cust_ids", "time_censor").join(ln, "cust_ids", "inner").filter(F.col("loan_time") < F.col("time_censor")).distinct()
    agg = (
        rp.join(looked_up(own), "loan_no", "inner")
        .filter(F.col("apply_time") < F.col("time_censor"))
        .distinct()
        .groupBy("cust_ids")
        .agg(
            flag_sum(ok).alias("suc_cnt"),
            flag_sum(F.col("status") == codes.REPAY_FAIL).alias("fail_cnt"),
            F.sum(F.when(ok, F.coalesce(F.col("principal"), no_money())).otherwise(no_money())).cast("double").alias("p_sum"),
        )
    )
    return agg.select(
        "cust_ids",
        "suc_cnt",
        "fail_cnt",
        "p_sum",
        ratio(F.col("fail_cnt"), F.col("fail_cnt") + F.col("suc_cnt") + codes.FAIL_RATE_SMOOTH).alias("s_f_rate"),
        F.coalesce(F.col("p_sum"), F.lit(0.0)).alias("rxd_principal_pay_cum"),
    )


# --- D22, D23 --------------------------------------------------------------


def overdue_flag_strict(
    cohort: DataFrame,
    loans: DataFrame,
    overdue: DataFrame,
    min_days: float = codes.OVERDUE_STRICT_DAYS,
    lead_days: float = codes.OVERDUE_STRICT_LEAD_DAYS,
    censor: Censor = None,
) -> DataFrame:
    """1.0 for customers with a non-consumer loan overdue by more than
    ``min_days`` days whose overdue started on a day more than ``lead_days``
    days before the censor. Only flagged customers get a row.

    The cohort selects the loans, these the overdue records.
    """
    other = valid_loans(loans).filter(_not_xfd_strict()).select("loan_no", "cust_ids")
    starts = prefilter(overdue.filter(F.col("overdue_days") > min_days), "start_date", censor).select(
        "loan_no", day_start(F.col("start_date")).alias("t1")
    )
    own = cohort.select("cust_ids", "time_censor").join(other, "cust_ids", "inner")
    lead_us = int(lead_days * 86_400_000_000)
    early = F.unix_micros("t1") < F.unix_micros("time_censor") - F.lit(lead_us)
    hit = starts.join(looked_up(own), "loan_no", "inner").filter(early).select("cust_ids").distinct()
    return hit.select("cust_ids", F.lit(1.0).alias("od10_dummy"))


def _not_xfd_strict() -> Column:
    """Not the consumer-loan product under SQL three-valued logic: a loan
    with a null code and otherwise matching codes is neither in nor out."""
    return (
        (F.col("partner_no") != codes.XFD_PARTNER_NO)
        | (F.col("product_no") != codes.XFD_PRODUCT_NO)
        | (F.col("quota_type") != codes.XFD_QUOTA_TYPE)
    )


def overdue_flag_any(cohort: DataFrame, loans: DataFrame, overdue: DataFrame, censor: Censor = None) -> DataFrame:
    """1.0 for customers with a loan that has a positive-day overdue
    record dated before the censor's day. Only flagged customers get a row.
    """
    every = valid_loans(loans).select("loan_no", "cust_ids")
    recs = overdue.filter(F.col("overdue_days") > 0.0).select("loan_no", "stat_date")
    if censor is not None:
        # A day to spare: the censor may be an instant of another zone.
        recs = recs.filter(F.col("stat_date") <= F.date_add(F.lit(as_datetime(censor).date()), 1))
    own = cohort.select("cust_ids", "time_censor").join(every, "cust_ids", "inner")
    early = F.col("stat_date") < F.to_date("time_censor")
    hit = recs.join(looked_up(own), "loan_no", "inner").filter(early).select("cust_ids").distinct()
    return hit.select("cust_ids", F.lit(1.0).alias("overdue_record_new_dummy"))


# --- D24 -------------------------------------------------------------------


def last_loan_profile(cohort: DataFrame, loans: DataFrame, censor: Censor = None) -> DataFrame:
    """Consumer loans before the censor, and amount, rate and term of
    the latest one. Ties on the latest time keep every tied loan, so a
    customer can have several rows.

    The latest time is a per-customer aggregate (combined map-side); the
    loans at that time are found by an equi join on (customer, time), which
    spreads one customer's loans over many partitions.
    """
    xfd = (
        valid_loans(loans)
        .filter(is_xfd())
        .select(
            F.col("loan_no").alias("ln"), "cust_ids", "loan_time", "loan_term", "loan_rate", "loan_amount"
        )
    )
    xfd = prefilter(xfd, "loan_time", censor).distinct()
    before = cohort.select("cust_ids", "time_censor").join(xfd, "cust_ids", "inner").filter(
        F.col("loan_time") < F.col("time_censor")
    )
    last = before.groupBy("cust_ids").agg(F.count(F.lit(1)).alias("cnt"), F.max("loan_time").alias("loan_time"))
    # The latest time is before the censor, so joining back to the loans
    # themselves (not to the cohort join) finds the same rows.
    rows = last.join(xfd, ["cust_ids", "loan_time"], "inner")
    return rows.select(
        "cust_ids",
        F.col("cnt").cast("double").alias("all_xfd_loan_cnt"),
        F.col("loan_amount").cast("double").alias("last_apply_amount"),
        F.col("loan_rate").cast("double").alias("last_apply_rate"),
        F.col("loan_term").cast("double").alias("last_apply_term"),
    )
