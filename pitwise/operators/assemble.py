"""Assembly of the wide feature row.

Every feature table is keyed by ``cust_ids`` and (except where the
definition allows ties) has one row per customer. The one-row-per-customer
tables are assembled by one aggregation over their union
(``functions.joins.left_join_one_to_one``) rather than a chain of joins,
which would run as one deep, memory-hungry pipeline per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.exprs import ratio
from pitwise.functions.joins import heavy_keys, left_join_many, left_join_one_to_one
from pitwise.functions.time import epoch_days
from pitwise.operators.loans import is_xfd


def feature_assembly(
    cohort: DataFrame,
    pay_ratios: DataFrame,
    spend: DataFrame,
    event_rates: DataFrame,
    burst: DataFrame,
    history: DataFrame,
    bureau: DataFrame,
    xfd: DataFrame,
    settlement: DataFrame,
    card_gap: DataFrame,
    device_peak: DataFrame,
    od_strict: DataFrame,
    od_any: DataFrame,
    last_loan: DataFrame,
) -> DataFrame:
    """Cohort left-joined to the feature sets; ``merchant_order_cnt``
    as double; ``all_xfd_loan_cnt`` is the number of consumer loans plus one
    (1.0 with none). ``t0`` is the censor in days since the epoch.
    """
    ft = cohort.select("cust_ids", "time_censor", epoch_days(F.col("time_censor")).alias("t0"))
    one_per_customer = [
        pay_ratios,
        spend.withColumn("merchant_order_cnt", F.col("merchant_order_cnt").cast("double")),
        event_rates,
        burst,
        history,
        bureau.drop("time_censor"),
        xfd.drop("xfd_p_pay_sum"),
        settlement,
        card_gap,
        device_peak,
        od_strict,
        od_any,
    ]
    ft = left_join_one_to_one(ft, one_per_customer)
    # Ties on the latest loan give several rows: a join, which may fan out.
    ft = ft.join(last_loan, "cust_ids", "left")
    return ft.withColumn(
        "all_xfd_loan_cnt", F.coalesce(F.col("all_xfd_loan_cnt") + 1.0, F.lit(1.0))
    )


def derived_features(assembled: DataFrame, repay: DataFrame) -> DataFrame:
    """Adds the repayment outcome columns and derived values.

    ``dow`` is whole days since the epoch modulo 7 (0 is a Thursday), not a
    calendar weekday; ``id_num`` the first 17 id characters as a double;
    ``id_head_1`` characters 3-4; ``age`` the censor year minus characters
    7-10; ``good_ratio`` / ``bad_ratio`` consumer good / bad counts over
    ``all_xfd_loan_cnt``. Helper columns ``uq`` and ``t0`` are dropped.
    """
    ft = assembled.join(repay, "cust_ids", "left")
    year = F.year("time_censor").cast("double")
    ft = ft.withColumns(
        {
            "dow": (F.col("t0").cast("int") % 7).cast("double"),
            "id_num": F.substring("cust_ids", 1, 17).try_cast("double"),
            "id_head_1": F.substring("cust_ids", 3, 2).try_cast("double"),
            "hr": F.hour("time_censor").cast("double"),
            "age": F.substring("cust_ids", 7, 4).try_cast("double") * (-1.0) + year,
            "good_ratio": ratio(F.col("xfd_good_cnt"), F.col("all_xfd_loan_cnt") + 0.0),
            "bad_ratio": ratio(F.col("xfd_bad_cnt"), F.col("all_xfd_loan_cnt") + 0.0),
            "lag2_loan_card_time_diff_min": F.col("lag2_loan_card_time_diff_min").cast("double"),
            "query_loanmanage_24m": F.col("query_loanmanage_24m").try_cast("double"),
            "query_selfquery_1m": F.col("query_selfquery_1m").try_cast("double"),
        }
    )
    return ft.drop("uq", "t0")


def attach_applications(features: DataFrame, loans: DataFrame) -> DataFrame:
    """One row per customer and consumer-loan application (no time
    bound), with amount, term and time; the rate is a typed null."""
    apps = loans.filter(is_xfd()).select(
        "cust_ids",
        "loan_no",
        F.col("loan_amount").cast("double").alias("loan_apply_amount"),
        F.lit(None).cast("double").alias("loan_apply_rate"),
        F.col("loan_term").cast("double").alias("loan_apply_term"),
        F.col("loan_time").alias("loan_apply_time"),
    )
    return left_join_many(features, apps, ["cust_ids"], heavy_keys(apps, "cust_ids"))


def credit_age(
    features: DataFrame,
    credits_alt: DataFrame,
    credits: DataFrame,
    id_length: int = codes.ID_LENGTH,
) -> DataFrame:
    """Days from the credit grant to the censor, from the second copy
    of the grants (whose other columns come along), else from the earliest
    grant in the first copy; null when the grant is not before the censor.
    """

    def age(grant: str) -> F.Column:
        return F.when(
            F.col(grant) < F.col("time_censor"),
            epoch_days(F.col("time_censor")) - epoch_days(F.col(grant)),
        )

    alt = credits_alt.distinct().withColumnRenamed("card_no", "cust_ids")
    # A card may have many grant rows in the second copy (each fans out).
    heavy = heavy_keys(credits_alt, "card_no")
    ft = left_join_many(features, alt, ["cust_ids"], heavy, place=F.xxhash64(*alt.columns))
    ft = ft.withColumn("credit_age", age("credit_date")).drop("credit_date")
    first = (
        credits.select("card_no", "credit_date")
        .filter(F.length("card_no") == id_length)
        .groupBy(F.col("card_no").alias("cust_ids"))
        .agg(F.min("credit_date").alias("first_grant"))
    )
    ft = ft.join(first, "cust_ids", "left")
    return ft.withColumn("credit_age", F.coalesce(F.col("credit_age"), age("first_grant"))).drop("first_grant")
