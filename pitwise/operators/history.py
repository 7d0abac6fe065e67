"""The loan history (D10) kept up day by day.

The sums of D10 over the loans of past days do not change when later days come:
what counts for a loan is what was known before it. So a run needs, of all that
is older, one row of running counts per customer (how many earlier loans are
good or bad by now: the offset of the sweep), and the older loans whose first
overdue day or first repayment has just come. Everything it finds is added to
what is kept; nothing is rewritten.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.functions.joins import looked_up
from pitwise.operators.loans import HISTORY, history_loans, history_points, less_same_number, successful
from pitwise.operators.sweep import coverage_totals

#: The tables that are kept. Rows are added; what stands for a key is their least (``firsts``) or their sum.
KEPT = {
    "loans": "cust_ids string, loan_no string, loan_time timestamp, x double",
    "firsts": "loan_no string, od_day date, pt timestamp",
    "offsets": "cust_ids string, " + ", ".join(f"{m} double" for m in HISTORY),
    "totals": "cust_ids string, " + ", ".join(f"{m} double" for m in HISTORY),
}


@dataclass(frozen=True)
class Days:
    """What happened in some days: loans, overdue records and repayments."""

    loans: DataFrame
    overdue: DataFrame
    repayments: DataFrame

    def between(self, first: Column | None, end: Column) -> Days:
        """Of the days from ``first`` (None: all before) up to but not with ``end``, both dates."""

        def within(df: DataFrame, column: str, kind: str) -> DataFrame:
            df = df.where(F.col(column) < end.cast(kind))
            return df if first is None else df.where(F.col(column) >= first.cast(kind))

        return Days(within(self.loans, "loan_time", "timestamp"), within(self.overdue, "stat_date", "date"), within(self.repayments, "apply_time", "timestamp"))


def _least(firsts: list[DataFrame]) -> DataFrame:
    rows = reduce(DataFrame.unionByName, firsts)
    return rows.groupBy("loan_no").agg(F.min("od_day").alias("od_day"), F.min("pt").alias("pt"))



def added(
    kept: dict[str, DataFrame],
    days: Days,
    since: Column,
    bucket_days: int = 1,
    stage: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> dict[str, DataFrame]:
    """The rows to add to the tables ``kept`` for ``days``, which begin at ``since`` (a date).

    The days' own loans are the query points. The edges of the sweep are the
    offset of each customer, at the beginning, and what the days change: the
    edges of new loans, and for older loans with news the edges after them
    less those before. ``stage`` may write the days' loans and first events,
    which are read several times.
    """
    loans = stage("loans", history_loans(days.loans))
    overdue = days.overdue.select("loan_no", F.col("stat_date").alias("od_day"), F.lit(None).cast("timestamp").alias("pt"))
    paid = successful(days.repayments).select("loan_no", F.lit(None).cast("date").alias("od_day"), F.col("apply_time").alias("pt"))
    # One aggregation of both: it combines before its shuffle.
    firsts = stage("firsts", _least([overdue, paid]).where("loan_no is not null"))

    news = firsts.select("loan_no").union(loans.select("loan_no")).distinct()
    old = kept["loans"].join(news, "loan_no", "left_semi")
    known = kept["firsts"].join(news, "loan_no", "left_semi")
    now = _least([known, firsts])
    before, after = old.join(_least([known]), "loan_no", "left"), old.join(now, "loan_no", "left")
    own = loans.join(looked_up(now), "loan_no", "left")

    points = history_points(own, ["cust_ids"])
    is_edge = F.col("kind") == 0
    edges = points.where(is_edge).unionByName(history_points(after, ["cust_ids"]).where(is_edge))
    gone = history_points(before, ["cust_ids"]).where(is_edge).withColumns({m: -F.col(m) for m in HISTORY})
    change = edges.unionByName(gone)

    asked = loans.select("cust_ids").distinct()
    begin = kept["offsets"].join(asked, "cust_ids", "left_semi").groupBy("cust_ids").agg(*[F.sum(m).alias(m) for m in HISTORY])
    begin = begin.select("cust_ids", F.unix_micros(since.cast("timestamp")).alias("t"), F.lit(0).alias("kind"), F.lit(0).alias("q"), *HISTORY)
    sweep = points.where(~is_edge).unionByName(change.join(asked, "cust_ids", "left_semi")).unionByName(begin)
    totals = coverage_totals(sweep, ["cust_ids"], HISTORY, bucket_days)

    # Rows of one customer and loan number, some new: their pairs do not count.
    number = ["cust_ids", "loan_no"]
    rows = own.withColumn("new", F.lit(1)).unionByName(after.withColumn("new", F.lit(0)))
    repeated = rows.groupBy(*number).agg(F.count(F.lit(1)).alias("n"), F.max("new").alias("new")).where("n > 1 and new = 1").select(*number)
    same = history_points(own.join(repeated, number, "left_semi"), number)
    same = same.unionByName(history_points(after.join(repeated, number, "left_semi"), number).where(is_edge))
    same = coverage_totals(same, number, HISTORY, bucket_days)
    return {
        "loans": loans,
        "firsts": firsts,
        "offsets": change.groupBy("cust_ids").agg(*[F.sum(m).alias(m) for m in HISTORY]),
        "totals": less_same_number(totals, same),
    }


def summed_totals(totals: DataFrame) -> DataFrame:
    return totals.groupBy("cust_ids").agg(*[F.sum(m).alias(m) for m in HISTORY])
