"""Cohort, accounts and as-of bounded fact tables.

The cohort is one row per customer with the time the features are censored
at. Facts are joined to it on an equi key and kept only when they happened
strictly before that customer's censor time. When every cohort row has the
same censor (the normal case, see ``cohort_censor``), pass it as ``censor``
too: the bound is then also applied to the fact table before the join, where
Spark pushes it into the parquet scan and shuffles only the surviving rows.
The per-row bound stays in place either way, so results do not depend on it.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.joins import looked_up
from pitwise.functions.time import instant_literal

Censor = str | datetime | date | None


def before_censor(ts: Column, censor: Censor) -> Column | None:
    """Scan-side bound ``ts < censor`` or None when no censor is known."""
    return None if censor is None else ts < instant_literal(censor)


def prefilter(df: DataFrame, ts: str, censor: Censor) -> DataFrame:
    """``df`` before the censor, when one is known."""
    cond = before_censor(F.col(ts), censor)
    return df if cond is None else df.filter(cond)


def cohort_censor(
    credits: DataFrame,
    censor: str | datetime | date,
    id_length: int = codes.ID_LENGTH,
) -> DataFrame:
    """Distinct valid customer ids, each stamped with the censor time.

    Output: ``cust_ids`` string, ``time_censor`` timestamp; one row per id.
    The ids are deduplicated before the censor column is added, so the
    shuffle carries ids only (and is combined map-side).
    """
    ids = (
        credits.select(F.col("card_no").alias("cust_ids"))
        .filter(F.length("cust_ids") == id_length)
        .distinct()
    )
    return ids.select("cust_ids", instant_literal(censor).alias("time_censor"))


def account_link(
    cohort: DataFrame,
    members: DataFrame,
    account_length: int = codes.ACCOUNT_LENGTH,
) -> DataFrame:
    """Every valid account of each cohort customer (one row per pair).

    Member rows are deduplicated on (id, account) before the join; with a
    distinct cohort the joined rows are then distinct too, so no distinct
    over the wider joined rows is needed.
    """
    links = (
        members.select(F.col("id_card").alias("cust_ids"), "acct_no")
        .filter((F.length("acct_no") == account_length) & F.col("acct_no").isNotNull())
        .distinct()
    )
    return cohort.join(links, "cust_ids", "inner").select("cust_ids", "time_censor", "acct_no")


def device_events_asof(
    accounts: DataFrame,
    events: DataFrame,
    account_length: int = codes.ACCOUNT_LENGTH,
    censor: Censor = None,
    dedupe: bool = True,
) -> DataFrame:
    """D3: device events of the cohort's accounts before each censor time.

    Output columns: ``acct_no, cust_ids, time_censor, pay_time, event_code,
    device_id, city, pay_order_no``; distinct rows. Consumers that are
    insensitive to duplicate rows may pass ``dedupe=False`` and save the
    shuffle of the distinct.
    """
    ev = events.filter(
        F.col("pay_time").isNotNull()
        & (F.length("account_no") == account_length)
        & F.col("account_no").isNotNull()
    ).withColumnRenamed("account_no", "acct_no")
    ev = prefilter(ev, "pay_time", censor)
    out = (
        accounts.select("acct_no", "cust_ids", "time_censor")
        .join(ev, "acct_no", "inner")
        .filter(F.col("pay_time") < F.col("time_censor"))
        .select(
            "acct_no",
            "cust_ids",
            "time_censor",
            "pay_time",
            "event_code",
            "device_id",
            "city",
            "pay_order_no",
        )
    )
    return out.distinct() if dedupe else out


def order_payments_asof(
    accounts: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    amount_cap: float = codes.AMOUNT_CAP,
    account_length: int = codes.ACCOUNT_LENGTH,
    censor: Censor = None,
) -> DataFrame:
    """One row per payment line of each cohort account's orders.

    Orders are capped by amount, need a valid buyer account and a payment
    id, and are deduplicated; lines are not (an order with n lines yields n
    rows). ``is_rxd_pay`` flags lines paid through the credit channel.
    """
    o = orders.filter(
        (F.col("amount") < F.lit(amount_cap))
        & (F.length("buyer_user_no") == account_length)
        & F.col("pay_order_id").isNotNull()
        & F.col("pay_time").isNotNull()
    )
    o = prefilter(o, "pay_time", censor).distinct()
    ln = lines.select(
        "merchant_order_id",
        "pay_channel_name",
        "pay_type",
        F.when(F.col("pay_channel_name").contains(codes.RXD_CHANNEL_MARK), F.lit(1))
        .otherwise(F.lit(0))
        .alias("is_rxd_pay"),
    )
    acc = accounts.select("cust_ids", "time_censor", "acct_no")
    joined = acc.join(o, acc["acct_no"] == o["buyer_user_no"], "inner").filter(
        F.col("pay_time") < F.col("time_censor")
    )
    return ln.join(looked_up(joined), "merchant_order_id", "inner").select(
        "merchant_order_id",
        "cust_ids",
        "time_censor",
        "acct_no",
        "buyer_user_no",
        "amount",
        "pay_time",
        "pay_order_id",
        "pay_channel_name",
        "pay_type",
        "is_rxd_pay",
    )
