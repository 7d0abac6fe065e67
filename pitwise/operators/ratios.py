"""Payment-mix and spend features over as-of payment lines.

Both are plain two-phase aggregations: Spark combines partial aggregates
per map task before the shuffle on the customer key, so a customer with a
huge share of the lines costs one combined row per task, not its lines.
Money is summed as decimal (exact, order independent) and turned into
double once, right before a ratio.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.exprs import no_money, ratio
from pitwise.functions.time import trunc_period


def credit_pay_ratios(payments: DataFrame, period: str = "month") -> DataFrame:
    """Share of credit payments, overall, in the best month, this month.

    Per customer and calendar month: distinct credit / non-credit payment
    ids and credit / non-credit amounts; then per customer the overall
    ratios, the largest monthly ratios and the ratio of the censor's month
    (0.0 when the censor month has no payments).
    """
    p = payments.select(
        "cust_ids",
        "pay_order_id",
        "amount",
        F.col("pay_type").contains(codes.CREDIT_PAY_MARK).alias("is_credit"),
        trunc_period(F.col("pay_time"), period).alias("pay_month"),
        trunc_period(F.col("time_censor"), period).alias("censor_month"),
    )
    p = p.withColumn("is_credit", F.coalesce("is_credit", F.lit(False)))
    # One row per payment id and kind first: its rows combine before the
    # shuffle, and counting ids is then counting rows.
    per_id = p.groupBy("cust_ids", "pay_month", "is_credit", "pay_order_id").agg(
        F.sum("amount").alias("amt"), F.min("censor_month").alias("censor_month")
    )
    credit = F.col("is_credit")
    monthly = per_id.groupBy("cust_ids", "pay_month").agg(
        F.count(F.when(credit, F.col("pay_order_id"))).alias("m_credit_n"),
        F.count(F.when(~credit, F.col("pay_order_id"))).alias("m_other_n"),
        F.sum(F.when(credit, F.col("amt")).otherwise(no_money())).alias("m_credit_amt"),
        F.sum(F.when(~credit, F.col("amt")).otherwise(no_money())).alias("m_other_amt"),
        F.min("censor_month").alias("censor_month"),
    )
    m_ratio = ratio(F.col("m_credit_n"), F.col("m_credit_n") + F.col("m_other_n"))
    m_amt_ratio = ratio(F.col("m_credit_amt"), F.col("m_credit_amt") + F.col("m_other_amt"))
    return monthly.groupBy("cust_ids").agg(
        ratio(F.sum("m_credit_n"), F.sum("m_credit_n") + F.sum("m_other_n")).alias("credit_pay_ratio_all"),
        F.max(m_ratio).alias("credit_pay_ratio_max"),
        ratio(F.sum("m_credit_amt"), F.sum("m_credit_amt") + F.sum("m_other_amt")).alias(
            "credit_pay_amount_ratio_all"
        ),
        F.max(m_amt_ratio).alias("credit_pay_amount_ratio_max"),
        F.max(
            F.when(F.col("pay_month") == F.col("censor_month"), m_amt_ratio).otherwise(F.lit(0.0))
        ).alias("credit_pay_amount_ratio_this_month"),
    )


def spend_summary(payments: DataFrame) -> DataFrame:
    """Distinct orders, mean amount, mean credit amount, credit-channel share.

    Amounts are in cents and reported in yuan. Means are taken over payment
    lines (an order with n lines weighs n times); the channel share is
    smoothed by 0.1 in the denominator.
    """
    credit = F.coalesce(F.col("pay_type").contains(codes.CREDIT_PAY_MARK), F.lit(False))
    rxd = F.coalesce(F.col("pay_channel_name").contains(codes.RXD_CHANNEL_MARK), F.lit(False))
    agg = payments.groupBy("cust_ids").agg(
        F.count_distinct("merchant_order_id").alias("merchant_order_cnt"),
        F.sum("amount").cast("double").alias("amt"),
        F.count("amount").alias("amt_n"),
        F.sum(F.when(credit, F.col("amount")).otherwise(no_money())).cast("double").alias("credit_amt"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(rxd, F.col("amount")).otherwise(no_money())).cast("double").alias("rxd_amt"),
    )
    return agg.select(
        "cust_ids",
        "merchant_order_cnt",
        ratio(F.col("amt") / 100.0, F.col("amt_n")).alias("merchant_order_amt_avg"),
        ratio(F.col("credit_amt") / 100.0, F.col("n")).alias("merchant_order_credit_pay_amt_avg"),
        ratio(F.col("rxd_amt") / 100.0, F.col("amt") / 100.0 + codes.SPEND_RATIO_SMOOTH).alias(
            "rxd_pay_amt_ratio"
        ),
    )
