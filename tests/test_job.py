"""The job with a censor per customer equals uniform-censor jobs per group."""

from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from pitwise.functions.joins import left_join_one_to_one
from pitwise.functions.time import as_compact_day, instant_literal
from pitwise.plans.job import FeatureJob
from pitwise.plans.registry import FIXTURE_PARAMS, present
from pitwise.sources.fixture import fixture_inputs

SF = "/root/testdata/sf0.001"
EARLY = "1998-01-01 00:00:00"
LATE = "1999-01-01 00:00:00"


def _rows(df):
    return sorted((tuple(r) for r in present(df).collect()), key=repr)


def test_per_customer_censor_matches_uniform_runs(spark):
    inputs = fixture_inputs(spark, SF)
    base = FeatureJob(inputs, FIXTURE_PARAMS).cohort
    early_ids = F.substring("cust_ids", 18, 1).isin("0", "2", "4", "6", "8")
    mixed = base.select(
        "cust_ids",
        F.when(early_ids, F.lit(EARLY).cast("timestamp")).otherwise(F.lit(LATE).cast("timestamp")).alias("time_censor"),
    )
    job = FeatureJob(inputs, replace(FIXTURE_PARAMS, censor=None), cohort=mixed)
    parts = []
    for censor, cond in ((EARLY, early_ids), (LATE, ~early_ids)):
        group = mixed.filter(cond)
        parts.append(FeatureJob(fixture_inputs(spark, SF), replace(FIXTURE_PARAMS, censor=censor), cohort=group))
    want = sorted(_rows(parts[0].features) + _rows(parts[1].features), key=repr)
    got = _rows(job.features)
    assert len(got) == base.count()
    assert got == want


def _cohort(spark, rows):
    return spark.createDataFrame(rows, "cust_ids string, time_censor string").withColumn("time_censor", F.col("time_censor").cast("timestamp"))


@pytest.mark.parametrize(
    ("rows", "censor", "message"),
    [
        ([("a", EARLY), ("a", LATE)], None, "twice"),
        ([("a", EARLY), ("b", None)], None, "without a censor"),
        ([("a", EARLY), ("b", LATE)], EARLY, "before a censor"),
    ],
)
def test_a_cohort_that_breaks_the_contract_is_refused(spark, rows, censor, message):
    with pytest.raises(ValueError, match=message):
        FeatureJob(fixture_inputs(spark, SF), replace(FIXTURE_PARAMS, censor=censor), cohort=_cohort(spark, rows))


def test_the_scan_bound_is_the_cohorts_last_censor(spark):
    job = FeatureJob(fixture_inputs(spark, SF), replace(FIXTURE_PARAMS, censor=LATE), cohort=_cohort(spark, [("a", EARLY), ("b", "1998-06-01")]))
    assert (job.first_censor.year, job.censor.month) == (1998, 6)


@pytest.mark.parametrize("bad", ["1999-13-45 00:00:00", "soon", "", "1999-1"])
def test_a_bad_censor_raises(spark, bad):
    with pytest.raises(ValueError):
        instant_literal(bad)


def test_given_times_keep_their_offset(spark):
    east = timezone(timedelta(hours=8))
    same = [instant_literal("1999-01-01 00:00:00+08:00"), instant_literal(datetime(1999, 1, 1, tzinfo=east))]
    naive = [instant_literal("1999.1.1 00:00:00"), instant_literal(datetime(1999, 1, 1)), instant_literal(date(1999, 1, 1))]
    got = spark.range(1).select(*[F.unix_seconds(c).alias(f"c{i}") for i, c in enumerate(same + naive)]).first()
    assert len(set(got[:2])) == len(set(got[2:])) == 1 and got[2] - got[0] == 8 * 3600


def test_assembly_refuses_a_repeated_key(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "cust_ids string, x int")
    part = spark.createDataFrame([("a", 3), ("a", 4)], "cust_ids string, y int")
    assert left_join_one_to_one(base, [part.limit(1)]).count() == 2
    with pytest.raises(Exception, match="more than one row"):
        left_join_one_to_one(base, [part]).collect()


def test_integer_days_are_read(spark):
    df = spark.createDataFrame([(20200131,), (20201331,)], "stat_date int")
    assert [r[0] for r in df.select(as_compact_day(df, "stat_date")).collect()] == [date(2020, 1, 31), None]
