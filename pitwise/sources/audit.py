"""Values of the inputs that cannot be read as what they should be.

Times, days, money and numbers are parsed once at the edge (``schemas``); what
does not parse becomes null there, and operators drop or default null values.
``parse_report`` counts these values, so that they are not lost in silence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwise.sources.inputs import Inputs
from pitwise.sources.schemas import SPECS, typed

REPORT = "input string, column string, kind string, stored string, given long, unparsed long"


class UnparsedValues(ValueError):
    """More values than allowed could not be parsed."""


def _may_fail(stored: T.DataType, kind: str) -> bool:
    """Whether values of the stored type can fail to parse as ``kind``: typed columns cannot."""
    if kind == "day8":
        return isinstance(stored, (T.StringType, T.IntegralType))
    return kind in ("instant", "money", "double") and isinstance(stored, T.StringType)


def parse_report(inputs: Inputs, names: tuple[str, ...] | None = None) -> DataFrame:
    """``input, column, kind, stored, given, unparsed``: a row per column that is stored as text (or days as numbers).

    ``given`` counts its values, ``unparsed`` those that become null (empty
    text, too). Inputs without such a column are not read; of the others, one
    scan each, of these columns only, with a row per task to the aggregate.
    """
    spark, parts = None, []
    for name in names or [n for n in SPECS if n in inputs]:
        raw = inputs.raw(name)
        spark = raw.sparkSession
        by_lower = {f.name.lower(): f for f in raw.schema.fields}
        checks = {}
        for column, kind in SPECS[name].columns.items():
            field = by_lower.get(column.lower())
            if field is not None and _may_fail(field.dataType, kind):
                checks[column] = (kind, field)
        if not checks:
            continue
        given = lambda f: F.col(f"`{f.name}`").isNotNull()
        counts = raw.agg(
            *[F.count_if(given(f)).alias(f"g{i}") for i, (_, f) in enumerate(checks.values())],
            *[F.count_if(given(f) & typed(raw, f.name, k).isNull()).alias(f"u{i}") for i, (k, f) in enumerate(checks.values())],
        )
        rows = [
            F.struct(
                F.lit(name).alias("input"), F.lit(c).alias("column"), F.lit(k).alias("kind"), F.lit(f.dataType.simpleString()).alias("stored"),
                F.col(f"g{i}").alias("given"), F.col(f"u{i}").alias("unparsed"),
            )
            for i, (c, (k, f)) in enumerate(checks.items())
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    if not parts:
        if spark is None:
            raise ValueError("no input to report on")
        return spark.createDataFrame([], REPORT)
    return reduce(DataFrame.unionByName, parts)


def check_parsed(report: DataFrame, limit: int) -> list:
    """The report's rows (one per text column); raises if a column has more than ``limit`` unparsed values."""
    rows = report.collect()
    bad = [r for r in rows if r.unparsed > limit]
    if bad:
        said = ", ".join(f"{r['input']}.{r['column']}: {r.unparsed} of {r.given}" for r in sorted(bad, key=lambda r: -r.unparsed))
        raise UnparsedValues(f"values that cannot be parsed ({limit} a column allowed): {said}")
    return rows
