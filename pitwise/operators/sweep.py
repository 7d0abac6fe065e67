"""Interval coverage totals by a bucketed prefix sum.

Given, per key, interval edges (+1 / -1 deltas at micro-second times) and
query points, compute for every key the sum over its query points of the
number of intervals covering each point. This replaces a self theta-join
("for each row, count earlier rows of the same key with a property") by a
sort, without emitting any pair of rows.

The running sum is split by time bucket, so a key with a very long history
is not one task: the within-bucket running sums are windows partitioned by
(key, bucket); a bucket's offset is the sum of the deltas of all earlier
buckets of the key, a window over one row per (key, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwise.functions.time import MICROS_PER_DAY

DEFAULT_BUCKET_DAYS = 1


def coverage_totals(
    points: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    bucket_days: int = DEFAULT_BUCKET_DAYS,
) -> DataFrame:
    """Sum of coverage counts at query points, per key.

    ``points`` columns: the ``keys``, ``t`` (long micros), ``kind`` (0 for
    an edge, 1 for a query point), ``q`` (1 on query points, else 0) and one
    delta column per measure (0 on query points). At equal times edges are
    applied before queries, so an interval starting at t covers t and one
    ending with a -1 at t does not.

    Returns the ``keys`` and one double column per measure.
    """
    keys = list(keys)
    width = bucket_days * MICROS_PER_DAY
    # Rows of one instant, however many, become one before they are sorted.
    sums = [F.sum(c).alias(c) for c in ("q", *measures)]
    p = points.groupBy(*keys, "t", "kind").agg(*sums).withColumn("bucket", F.floor(F.col("t") / F.lit(width)))
    local = Window.partitionBy(*keys, "bucket").orderBy("t", "kind").rowsBetween(Window.unboundedPreceding, 0)
    running = p.select(
        *keys,
        "bucket",
        "q",
        *[F.col(m) for m in measures],
        *[F.sum(m).over(local).alias(f"run_{m}") for m in measures],
    )
    per_bucket = running.groupBy(*keys, "bucket").agg(
        F.sum("q").alias("n_q"),
        *[F.sum(F.col("q") * F.col(f"run_{m}")).alias(f"s_{m}") for m in measures],
        *[F.sum(m).alias(f"d_{m}") for m in measures],
    )
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    with_offset = per_bucket.select(
        *keys,
        *[
            (
                F.col(f"s_{m}") + F.col("n_q") * F.coalesce(F.sum(f"d_{m}").over(earlier), F.lit(0))
            ).alias(f"tot_{m}")
            for m in measures
        ],
    )
    return with_offset.groupBy(*keys).agg(*[F.sum(f"tot_{m}").cast("double").alias(m) for m in measures])
