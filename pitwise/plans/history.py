"""A loan history (D10) in a folder, to which days are added."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.operators.history import KEPT, Days, added, summed_totals
from pitwise.operators.loans import history_columns
from pitwise.plans.manifest import Records


class LoanHistory:
    """Tables that grow by the days added, and D10 as of the last of them.

    ``add`` is given the whole loans, overdue records and repayments (or what
    of them is at hand) and reads the days since it was last called. Days are
    added once and in order: what comes later for a day that is in already is
    not seen. An addition counts when its record is written; one that was
    ended before leaves files that nothing reads, and is made anew.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._records = Records(spark, f"{self.path}/added")

    @property
    def until(self) -> date | None:
        """The day up to which days are in, not itself; None before the first addition."""
        rows = self._records.rows()
        return date.fromisoformat(rows[-1].stage) if rows else None

    def kept(self) -> dict[str, DataFrame]:
        folders = [r.path for r in self._records.rows()]
        read = lambda name, schema: self.spark.read.schema(schema).parquet(*[f"{f}/{name}" for f in folders])
        return {name: read(name, schema) if folders else self.spark.createDataFrame([], schema) for name, schema in KEPT.items()}

    def add(self, days: Days, until: date, bucket_days: int = 1) -> None:
        since = self.until
        if since is not None and until <= since:
            raise ValueError(f"days up to {since} are in already")
        new = days.between(None if since is None else F.lit(since), F.lit(until))
        folder = f"{self.path}/{until.isoformat()}"

        def write(name: str, df: DataFrame) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            return self.spark.read.schema(KEPT[name]).parquet(f"{folder}/{name}")

        tables = added(self.kept(), new, F.lit(since or date(1970, 1, 1)), bucket_days, stage=write)
        for name in ("offsets", "totals"):
            write(name, tables[name])
        self._records.add([{"stage": until.isoformat(), "path": folder}])

    def counts(self) -> DataFrame:
        """D10 over all days that are in."""
        return history_columns(summed_totals(self.kept()["totals"]))
