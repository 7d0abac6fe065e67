"""The set of logical inputs a feature run reads.

``Inputs`` maps each logical input name (see ``schemas.SPECS``) to a loader
and hands out conformed DataFrames. Loaders are lazy, so a run touches only
the inputs its features need, and each loader is called once per run, so an
input read by several features is one scan in each plan that uses it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from pitwise.functions.time import scan_bound
from pitwise.sources.schemas import SPECS, conform

Loader = Callable[[], DataFrame]


class Inputs:
    def __init__(self, loaders: Mapping[str, Loader]):
        unknown = set(loaders) - set(SPECS)
        if unknown:
            raise ValueError(f"unknown inputs {sorted(unknown)}")
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._loaders:
                raise KeyError(f"input {name!r} has no loader")
            self._cache[name] = conform(self._loaders[name](), SPECS[name])
        return self._cache[name]

    def raw(self, name: str) -> DataFrame:
        """Input ``name`` as it is stored."""
        if name not in self._loaders:
            raise KeyError(f"input {name!r} has no loader")
        return self._loaders[name]()

    def before(self, name: str, column: str, censor: str | datetime | date | None) -> DataFrame:
        """Input ``name`` with a bound on the stored ``column`` that the scan can use.

        Rows at or after ``censor`` may remain; the caller compares typed times.
        """
        key = f"{name}<{censor}"
        if censor is None or name not in self._loaders:
            return self[name]
        if key not in self._cache:
            df = self._loaders[name]()
            stored = {c.lower(): c for c in df.columns}.get(column.lower())
            bound = scan_bound(df, stored, censor) if stored else None
            self._cache[key] = conform(df if bound is None else df.filter(bound), SPECS[name])
        return self._cache[key]

    def __contains__(self, name: str) -> bool:
        return name in self._loaders

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: Mapping[str, str]) -> Inputs:
        """Inputs read from catalog tables, e.g. ``{"loans": "db.loan_main"}``."""
        return cls({name: (lambda t=t: spark.table(t)) for name, t in tables.items()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> Inputs:
        """Inputs read from parquet paths (files or directories)."""
        return cls({name: (lambda p=p: spark.read.parquet(p)) for name, p in paths.items()})

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> Inputs:
        return cls({name: (lambda d=d: d) for name, d in frames.items()})
