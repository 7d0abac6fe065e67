"""Device-event features.

Inputs are the as-of device events of ``asof.device_events_asof``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.exprs import flag_sum, ratio
from pitwise.functions.time import MICROS_PER_DAY, epoch_days, trunc_period

BURST_COLUMN = "7days_device_cnt_more_than4"


def event_code_rates(
    events: DataFrame,
    event_codes: tuple[str, ...] = codes.EVENT_CODES,
    total_codes: tuple[str, ...] = codes.EVENT_TOTAL_CODES,
    rate_order: tuple[str, ...] = codes.EVENT_RATE_ORDER,
) -> DataFrame:
    """Per customer, event counts per code and counts per day.

    Rows are distinct (account, customer, censor, time, code, device) tuples
    before the censor. The per-day rate divides a code's count by the days
    between the customer's first event and the censor (null for a zero span).
    Output: ``cust_ids``, ``<code>_all`` for ``total_codes``, ``<code>_avg``
    for ``rate_order``.
    """
    e = (
        events.select("acct_no", "cust_ids", "time_censor", "pay_time", "event_code", "device_id")
        .filter(F.col("pay_time") < F.col("time_censor"))
        .distinct()
    )
    counts = [flag_sum(F.col("event_code") == F.lit(c)).alias(c) for c in event_codes]
    agg = e.groupBy("cust_ids").agg(
        *counts,
        F.min("pay_time").alias("first_ts"),
        F.max("time_censor").alias("censor_ts"),
    )
    span = epoch_days(F.col("censor_ts")) - epoch_days(F.col("first_ts"))
    return agg.select(
        "cust_ids",
        *[F.col(c).alias(f"{c}_all") for c in total_codes],
        *[ratio(F.col(c), span).alias(f"{c}_avg") for c in rate_order],
    )


def device_burst_7d(
    events: DataFrame,
    devices: int = codes.BURST_DEVICES,
    days: int = codes.BURST_DAYS,
) -> DataFrame:
    """1.0 if at some instant at least ``devices`` distinct devices were
    each seen within the last ``days`` days (window ends inclusive), else 0.0.

    A missing device id counts as one device, ``unknown``. Events with no
    time are ignored. One row per customer with events before the censor.

    Exact and without per-customer arrays. Time is cut into buckets of one
    window W. Within a bucket a device's events are less than W apart, so it
    is active from the first of them until W after the last: one aggregated
    row per (customer, device, bucket) is enough. That piece is cut off where
    the device's next piece begins, so a device's pieces are disjoint, and a
    running sum of +1 / -1 over the pieces of a customer is its number of
    active devices.

    The sweep runs per (customer, bucket): every piece is sent to its own
    bucket and the next one, so bucket g sees all pieces that can be active
    in it. Counts there never exceed the true count and equal it at events of
    bucket g, so the maximum over buckets is exact.
    """
    width = days * MICROS_PER_DAY
    us = F.unix_micros("pay_time")
    pieces = (
        events.filter(F.col("pay_time").isNotNull() & (F.col("pay_time") < F.col("time_censor")))
        .groupBy(
            "cust_ids",
            F.coalesce(F.col("device_id"), F.lit(codes.UNKNOWN_DEVICE)).alias("dev"),
            F.floor(us / F.lit(width)).alias("g"),
        )
        .agg(F.min(us).alias("first"), F.max(us).alias("last"))
    )
    nxt = F.lead("first").over(Window.partitionBy("cust_ids", "dev").orderBy("g"))
    stop = F.col("last") + F.lit(width + 1)
    end = F.least(stop, F.coalesce(nxt, stop))
    edge = lambda t, d: F.struct(t.alias("t"), F.lit(d).alias("d"))
    edges = (
        pieces.select("cust_ids", "g", "first", end.alias("end"))
        .select("cust_ids", F.explode(F.array("g", F.col("g") + 1)).alias("g"), "first", "end")
        .select("cust_ids", "g", F.inline(F.array(edge(F.col("first"), 1), edge(F.col("end"), -1))))
    )
    sweep = Window.partitionBy("cust_ids", "g").orderBy("t", "d").rowsBetween(Window.unboundedPreceding, 0)
    active = edges.select("cust_ids", F.sum("d").over(sweep).alias("active"))
    return active.groupBy("cust_ids").agg(
        F.when(F.max("active") >= devices, F.lit(1.0)).otherwise(F.lit(0.0)).alias(BURST_COLUMN)
    )


def monthly_device_city_peak(
    events: DataFrame,
    event_codes: tuple[str, ...] = codes.LOAN_USE_CODES,
    period: str = "month",
) -> DataFrame:
    """Most distinct devices and cities a customer used on loan-use
    events of one account within one calendar period.

    Output: ``month_machine_finger_loan_use_device_cnt_max`` and
    ``month_machine_finger_loan_use_city_cnt_max`` (bigint).
    """
    month = ["cust_ids", "acct_no", "pay_month"]
    e = events.filter(F.col("event_code").isin(list(event_codes))).select(
        "cust_ids", "acct_no", trunc_period(F.col("pay_time"), period).alias("pay_month"), "device_id", "city"
    )
    # A distinct (device, city) becomes two values; events themselves are not multiplied.
    value = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    values = e.distinct().select(*month, F.inline(F.array(value("d", "device_id"), value("c", "city")))).distinct()
    known = lambda kind: F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())
    per_month = values.groupBy(*month).agg(known("d").alias("dev_n"), known("c").alias("city_n"))
    return per_month.groupBy("cust_ids").agg(
        F.max("dev_n").alias("month_machine_finger_loan_use_device_cnt_max"),
        F.max("city_n").alias("month_machine_finger_loan_use_city_cnt_max"),
    )
