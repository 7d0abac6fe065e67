"""Join helpers: hot right-side keys, and wide one-to-one assembly."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a key from which it is dealt to several tasks, and the keys that are, at most.
HEAVY_ROWS, HEAVY_KEYS = 1_000_000, 1_000
#: Share of the rows that is looked at for heavy keys.
LOOKED_AT = 1 / 1024
#: Places of a sieve: 64 a row, so at most 524,288 rows, about 25 MB, are broadcast.
SIEVE_PLACES = 1 << 25


def heavy_keys(rows: DataFrame, key: str, least: int = HEAVY_ROWS, share: float = LOOKED_AT) -> dict[str, int]:
    """The keys of ``rows`` with about ``least`` rows or more, and how many times so many.

    Found in a sample of the key column, combined before the shuffle; at most
    ``HEAVY_KEYS`` come to the driver, the largest. It decides where rows are
    worked on, never what a result is.
    """
    seen = rows.where(F.col(key).isNotNull()).select(key)
    if share < 1:
        seen = seen.sample(share, seed=7)
    counts = seen.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least * share)
    return {r[0]: math.ceil(r["n"] / share / least) for r in counts.orderBy(F.desc("n"), key).limit(HEAVY_KEYS).collect()}


def looked_up(few: DataFrame) -> DataFrame:
    """``few`` as the side of a join that is held in memory, a shuffled part a task.

    For the selecting side of a join with a large table: both are shuffled by
    key, and the large one is neither sorted nor merged. ``few`` has at most a
    few rows a key (customers, their latest reports, their loans).
    """
    return few.hint("shuffle_hash")


def sieved(rows: DataFrame, key: str, few: DataFrame, of: str) -> DataFrame:
    """The rows of a large table whose ``key`` may be among the values ``of`` of ``few``.

    Every row that has such a key stays, with few others: those whose hash is
    that of one. For the input of an inner or semi join, or of the right side
    of a left join, that ``few`` selects little from: what goes is not
    shuffled. The sieve has one size; with many more values than places it
    lets more rows through. ``few`` is read once more for it. Keys that are not
    text on both sides are left alone.
    """
    if {dict(rows.dtypes)[key], dict(few.dtypes)[of]} != {"string"}:
        return rows
    place = lambda c: F.xxhash64(c).bitwiseAND(F.lit(SIEVE_PLACES - 1))
    mark = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_place") % 64).cast("int"))
    held = few.where(F.col(of).isNotNull()).select(place(of).alias("_place"))
    held = held.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(mark).alias("_marks"))
    met = rows.withColumn("_place", place(key)).join(F.broadcast(held), F.shiftright("_place", 6) == F.col("_word"))
    return met.where(F.getbit("_marks", (F.col("_place") % 64).cast("int")) == 1).select(*rows.columns)


def left_join_many(
    left: DataFrame, right: DataFrame, keys: Sequence[str], heavy: Mapping[str, int] | None = None, place: Column | None = None
) -> DataFrame:
    """``left LEFT JOIN right USING (keys)`` for a right side whose first key may be heavy.

    Adaptive execution splits a skewed partition of an outer join only on the
    preserved side. ``heavy`` (``heavy_keys`` of ``right``) names keys whose
    right rows are dealt to parts by their place, a part per ``HEAVY_ROWS``
    rows; a left row of such a key is sent to every part. As the key was seen
    on the right, some part matches, and the parts that do not are left out.
    Both sides are read once.

    A row's place must be the same if a lost task is run again: without
    ``place`` (a hash of the row's values, if rows are distinct), ``right`` is
    a projection or filter of a scan.
    """
    keys = list(keys)
    if not heavy:
        return left.join(right, keys, "left")
    sizes = F.create_map(*[F.lit(x) for item in heavy.items() for x in item])
    parts = F.coalesce(F.try_element_at(sizes, F.col(keys[0])), F.lit(1))
    sent = left.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = right.withColumn("_part", F.pmod(F.xxhash64(F.monotonically_increasing_id()) if place is None else place, parts).cast("int"))
    joined = sent.join(dealt.withColumn("_found", F.lit(True)), [*keys, "_part"], "left")
    return joined.where(F.col("_found").isNotNull() | ~F.col(keys[0]).isin(list(heavy)) | F.col(keys[0]).isNull()).drop("_part", "_found")


def left_join_one_to_one(base: DataFrame, parts: Sequence[DataFrame], key: str = "cust_ids") -> DataFrame:
    """``base LEFT JOIN parts[0] LEFT JOIN parts[1] ... USING (key)`` as one aggregation.

    For ``base`` and parts with at most one row per key. A long chain of
    sort-merge joins runs as one deep pipeline per task, with a sorter and a
    buffer per join all holding memory at once. Here the inputs are unioned
    side by side and one aggregation per key picks each column's (single)
    value: one shuffle, one spillable aggregate (a hash aggregate if the
    columns have a fixed width), and only rows of ``base`` are kept. A key that an input has
    twice is an error when the rows are read.
    """
    wide, out = [], []
    for i, df in enumerate([base, *parts]):
        own = [c for c in df.columns if c != key]
        wide.append(df.select(key, F.lit(1).alias(f"_n{i}"), *[F.col(f"`{c}`").alias(f"_{i}_{j}") for j, c in enumerate(own)]))
        out += [F.col(f"_{i}_{j}").alias(c) for j, c in enumerate(own)]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wide)
    names = [c for c in union.columns if c != key]
    rows = [F.count(f"_n{i}") for i in range(len(wide))]
    picked = union.groupBy(key).agg(*[F.max(c).alias(c) for c in names], F.greatest(*rows).alias("_most"))
    repeated = F.raise_error(F.concat(F.lit(f"more than one row of an input has {key} "), F.col(key))).cast("boolean")
    picked = picked.filter(F.when(F.col("_most") > 1, repeated).otherwise(F.col("_n0").isNotNull()))
    return picked.select(key, *out)
