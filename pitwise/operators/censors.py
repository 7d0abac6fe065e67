"""Features at several censor times per customer, from one read of the facts.

Each fact is put into a slot: the number of the customer's censors that are not
after it, so it counts for the censors from that slot on. Facts are aggregated
per customer and slot to states that add up (counts, sums, earliest times, new
distinct values), and the states of a censor are the sums over the slots up to
its own, at most one per censor of a customer. A fact is read once and is one
row, however many censors it counts for.

The results are keyed by (``cust_ids``, ``time_censor``) and equal those of one
run per censor (D5, D6, D7, D13). D3 and D4, whose rows are the facts
themselves, take such a cohort as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.exprs import flag_sum, no_money, ratio
from pitwise.functions.time import epoch_days, trunc_period
from pitwise.operators.loans import valid_loans

#: The aggregate that adds up the slots of a state, by the kind of the state.
ADD = {"sum": F.sum, "min": F.min}


def censor_lists(cohort: DataFrame) -> DataFrame:
    """``cust_ids, censors``: a customer's distinct censor times in order (one row per customer; nulls left out)."""
    return cohort.where(F.col("time_censor").isNotNull()).groupBy("cust_ids").agg(F.array_sort(F.collect_set("time_censor")).alias("censors"))


def slot_of(time: Column) -> Column:
    """How many of ``censors`` are not after ``time``; null if none is after it (or the time is null)."""
    n = F.size(F.filter("censors", lambda c: c <= time))
    return F.when(time.isNotNull() & (n < F.size("censors")), n)


def slotted(cohort: DataFrame, accounts: DataFrame, facts: DataFrame, time: str) -> DataFrame:
    """``facts`` (with ``acct_no``) of the cohort's accounts that count for some censor, with ``cust_ids`` and ``slot``.

    ``accounts`` are ``cust_ids, acct_no``, distinct.
    """
    own = censor_lists(cohort).join(accounts.select("cust_ids", "acct_no"), "cust_ids")
    rows = own.join(facts, "acct_no").withColumn("slot", slot_of(F.col(time)))
    return rows.where(F.col("slot").isNotNull()).drop("censors")


def at_censors(cohort: DataFrame, states: DataFrame, adds: dict[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """``states`` (by ``cust_ids``, ``keys``, ``slot``) added up for every censor that has any.

    ``adds`` names the state columns and how they add (``ADD``). The rows are
    ``cust_ids``, ``keys``, ``time_censor`` and the states. What is before a
    censor is in its slot or an earlier one; a key without a state up to a
    censor has no row there.
    """
    of_key = states.groupBy("cust_ids", *keys).agg(F.collect_list(F.struct("slot", *adds)).alias("slots"))
    every = of_key.join(censor_lists(cohort), "cust_ids").select("cust_ids", *keys, "slots", F.posexplode("censors").alias("own", "time_censor"))
    upto = every.select("cust_ids", *keys, "time_censor", F.inline(F.filter("slots", lambda s: s["slot"] <= F.col("own"))))
    return upto.groupBy("cust_ids", *keys, "time_censor").agg(*[ADD[a](c).alias(c) for c, a in adds.items()])


def event_code_rates_at(
    cohort: DataFrame,
    accounts: DataFrame,
    events: DataFrame,
    event_codes: tuple[str, ...] = codes.EVENT_CODES,
    total_codes: tuple[str, ...] = codes.EVENT_TOTAL_CODES,
    rate_order: tuple[str, ...] = codes.EVENT_RATE_ORDER,
    account_length: int = codes.ACCOUNT_LENGTH,
) -> DataFrame:
    """D7 at every censor: see ``events.event_code_rates``."""
    ev = events.where(F.col("pay_time").isNotNull() & (F.length("account_no") == account_length)).withColumnRenamed("account_no", "acct_no")
    e = slotted(cohort, accounts, ev.select("acct_no", "pay_time", "event_code", "device_id"), "pay_time").distinct()
    states = e.groupBy("cust_ids", "slot").agg(
        *[flag_sum(F.col("event_code") == F.lit(c)).alias(c) for c in event_codes], F.min("pay_time").alias("first_ts")
    )
    g = at_censors(cohort, states, {c: "sum" for c in event_codes} | {"first_ts": "min"})
    span = epoch_days(F.col("time_censor")) - epoch_days(F.col("first_ts"))
    return g.select(
        "cust_ids",
        "time_censor",
        *[F.col(c).alias(f"{c}_all") for c in total_codes],
        *[ratio(F.col(c), span).alias(f"{c}_avg") for c in rate_order],
    )


def payment_slots(
    cohort: DataFrame,
    accounts: DataFrame,
    orders: DataFrame,
    lines: DataFrame,
    amount_cap: float = codes.AMOUNT_CAP,
    account_length: int = codes.ACCOUNT_LENGTH,
) -> DataFrame:
    """The payment lines of D4 with their ``slot`` in place of a censor, each once."""
    o = orders.where(
        (F.col("amount") < F.lit(amount_cap))
        & (F.length("buyer_user_no") == account_length)
        & F.col("pay_order_id").isNotNull()
        & F.col("pay_time").isNotNull()
    ).distinct()
    own = slotted(cohort, accounts, o.withColumnRenamed("buyer_user_no", "acct_no"), "pay_time")
    return own.join(lines.select("merchant_order_id", "pay_channel_name", "pay_type"), "merchant_order_id")


def spend_summary_at(cohort: DataFrame, payments: DataFrame) -> DataFrame:
    """D6 at every censor, of ``payment_slots``: see ``ratios.spend_summary``.

    An order is new in the first slot of its lines; counting new ones up to a
    censor counts the distinct ones before it.
    """
    credit = F.coalesce(F.col("pay_type").contains(codes.CREDIT_PAY_MARK), F.lit(False))
    rxd = F.coalesce(F.col("pay_channel_name").contains(codes.RXD_CHANNEL_MARK), F.lit(False))
    amount = F.col("amount")
    per_order = payments.groupBy("cust_ids", "merchant_order_id", "slot").agg(
        F.sum(amount).alias("amt"),
        F.count(amount).alias("amt_n"),
        F.sum(F.when(credit, amount).otherwise(no_money())).alias("credit_amt"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(rxd, amount).otherwise(no_money())).alias("rxd_amt"),
    )
    sums = ("amt", "amt_n", "credit_amt", "n", "rxd_amt")
    # The slots of one order, at most one per censor.
    slots = per_order.groupBy("cust_ids", "merchant_order_id").agg(F.array_sort(F.collect_list(F.struct("slot", *sums))).alias("slots"))
    rows = slots.select("cust_ids", "merchant_order_id", F.posexplode("slots").alias("pos", "s"))
    new = (F.col("pos") == 0) & F.col("merchant_order_id").isNotNull()
    states = rows.groupBy("cust_ids", F.col("s.slot").alias("slot")).agg(
        F.count_if(new).alias("merchant_order_cnt"), *[F.sum(f"s.{c}").alias(c) for c in sums]
    )
    g = at_censors(cohort, states, {c: "sum" for c in ("merchant_order_cnt", *sums)})
    double = lambda c: F.col(c).cast("double")
    return g.select(
        "cust_ids",
        "time_censor",
        "merchant_order_cnt",
        ratio(double("amt") / 100.0, F.col("amt_n")).alias("merchant_order_amt_avg"),
        ratio(double("credit_amt") / 100.0, F.col("n")).alias("merchant_order_credit_pay_amt_avg"),
        ratio(double("rxd_amt") / 100.0, double("amt") / 100.0 + codes.SPEND_RATIO_SMOOTH).alias("rxd_pay_amt_ratio"),
    )


def credit_pay_ratios_at(cohort: DataFrame, payments: DataFrame, period: str = "month") -> DataFrame:
    """D5 at every censor, of ``payment_slots``: see ``ratios.credit_pay_ratios``.

    A payment id is new in the first slot of its month and kind. The months'
    states add up over slots, then the months of a censor are compared.
    """
    p = payments.select(
        "cust_ids",
        "slot",
        "pay_order_id",
        "amount",
        F.coalesce(F.col("pay_type").contains(codes.CREDIT_PAY_MARK), F.lit(False)).alias("is_credit"),
        trunc_period(F.col("pay_time"), period).alias("pay_month"),
    )
    per_id = p.groupBy("cust_ids", "pay_month", "is_credit", "pay_order_id", "slot").agg(F.sum("amount").alias("amt"))
    slots = per_id.groupBy("cust_ids", "pay_month", "is_credit", "pay_order_id").agg(F.array_sort(F.collect_list(F.struct("slot", "amt"))).alias("slots"))
    rows = slots.select("cust_ids", "pay_month", "is_credit", "pay_order_id", F.posexplode("slots").alias("pos", "s"))
    new, credit, amt = (F.col("pos") == 0) & F.col("pay_order_id").isNotNull(), F.col("is_credit"), F.col("s.amt")
    states = rows.groupBy("cust_ids", "pay_month", F.col("s.slot").alias("slot")).agg(
        F.count_if(new & credit).alias("m_credit_n"),
        F.count_if(new & ~credit).alias("m_other_n"),
        F.sum(F.when(credit, amt).otherwise(no_money())).alias("m_credit_amt"),
        F.sum(F.when(~credit, amt).otherwise(no_money())).alias("m_other_amt"),
    )
    names = ("m_credit_n", "m_other_n", "m_credit_amt", "m_other_amt")
    monthly = at_censors(cohort, states, {c: "sum" for c in names}, keys=("pay_month",))
    m_ratio = ratio(F.col("m_credit_n"), F.col("m_credit_n") + F.col("m_other_n"))
    m_amt_ratio = ratio(F.col("m_credit_amt"), F.col("m_credit_amt") + F.col("m_other_amt"))
    this_month = F.col("pay_month") == trunc_period(F.col("time_censor"), period)
    return monthly.groupBy("cust_ids", "time_censor").agg(
        ratio(F.sum("m_credit_n"), F.sum("m_credit_n") + F.sum("m_other_n")).alias("credit_pay_ratio_all"),
        F.max(m_ratio).alias("credit_pay_ratio_max"),
        ratio(F.sum("m_credit_amt"), F.sum("m_credit_amt") + F.sum("m_other_amt")).alias("credit_pay_amount_ratio_all"),
        F.max(m_amt_ratio).alias("credit_pay_amount_ratio_max"),
        F.max(F.when(this_month, m_amt_ratio).otherwise(F.lit(0.0))).alias("credit_pay_amount_ratio_this_month"),
    )


def repay_outcome_rates_at(cohort: DataFrame, loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """D13 at every censor: see ``loans.repay_outcome_rates``. A repayment counts from the later slot of it and its loan."""
    ln = valid_loans(loans).select("loan_no", "cust_ids", "loan_time").distinct()
    own = censor_lists(cohort).join(ln, "cust_ids").withColumn("loan_slot", slot_of(F.col("loan_time"))).where(F.col("loan_slot").isNotNull())
    rp = repayments.where(F.col("apply_time").isNotNull() & F.col("status").isin(codes.REPAY_OK, codes.REPAY_FAIL))
    rp = rp.select("loan_no", "principal", "status", "apply_time")
    met = own.join(rp, "loan_no").withColumn("paid_slot", slot_of(F.col("apply_time"))).where(F.col("paid_slot").isNotNull())
    # Equal repayments of a loan row are one; made distinct after the cohort has chosen.
    met = met.select("cust_ids", "loan_no", "loan_time", "principal", "status", "apply_time", F.greatest("loan_slot", "paid_slot").alias("slot")).distinct()
    ok = F.col("status") == codes.REPAY_OK
    states = met.groupBy("cust_ids", "slot").agg(
        flag_sum(ok).alias("suc_cnt"),
        flag_sum(F.col("status") == codes.REPAY_FAIL).alias("fail_cnt"),
        F.sum(F.when(ok, F.coalesce(F.col("principal"), no_money())).otherwise(no_money())).alias("p_sum"),
    )
    g = at_censors(cohort, states, {c: "sum" for c in ("suc_cnt", "fail_cnt", "p_sum")}).withColumn("p_sum", F.col("p_sum").cast("double"))
    return g.select(
        "cust_ids",
        "time_censor",
        "suc_cnt",
        "fail_cnt",
        "p_sum",
        ratio(F.col("fail_cnt"), F.col("fail_cnt") + F.col("suc_cnt") + codes.FAIL_RATE_SMOOTH).alias("s_f_rate"),
        F.coalesce(F.col("p_sum"), F.lit(0.0)).alias("rxd_principal_pay_cum"),
    )
