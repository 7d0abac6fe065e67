"""The record of what a run has finished, and of what has been published.

Records are JSON lines in small files, written through Hadoop's file system and
read by Spark, so they live wherever the tables do; a file is there as a whole
or not at all. A stage is recorded after its files are complete; a run is
published by one file, after all its tables are.
"""

from __future__ import annotations

import json
import uuid
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

RECORD = "number long, run_id string, stage string, path string, format string, params string"


class Records:
    """An append-only table of records in the folder ``path``: a file of JSON lines per addition."""

    def __init__(self, spark: SparkSession, path: str, new: bool = False) -> None:
        self.spark, self.path = spark, path
        self._lock = Lock()
        self._rows = 0 if new else len(self.rows())

    def rows(self) -> list:
        """All records in the order in which they were added (a few per run)."""
        try:
            found = self.spark.read.schema(RECORD).json(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return found.orderBy("number").collect()

    def add(self, records: list[dict]) -> None:
        """Written under a name that readers pass over, then renamed."""
        with self._lock:
            lines = [json.dumps(r | {"number": self._rows + i}) + "\n" for i, r in enumerate(records)]
            self._rows += len(records)
        name = uuid.uuid4().hex
        folder, fs = _file_system(self.spark, self.path)
        draft = self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"_{name}")
        out = fs.create(draft)
        out.write(bytearray("".join(lines).encode()))
        out.close()
        if not fs.rename(draft, self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{name}.json")):
            raise OSError(f"cannot rename {draft}")


class Manifest:
    """The finished stages of one run, found again by its id."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, params: str, new: bool = False) -> None:
        self.records = Records(spark, f"{root.rstrip('/')}/manifest", new)
        self.run_id, self.params = run_id, params
        self.finished: dict[str, str] = {}
        for r in [] if new else self.records.rows():
            if r.params != params:
                raise ValueError(f"run {run_id!r} was started with other parameters: {r.params}")
            self.finished[r.stage] = r.path

    def add(self, stage: str, path: str) -> None:
        self.records.add([{"run_id": self.run_id, "stage": stage, "path": path, "params": self.params}])
        self.finished[stage] = path


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of a run through Hadoop's file system; False if it is not there."""
    folder, fs = _file_system(spark, path)
    return fs.delete(folder, True)


def published(spark: SparkSession, target: str, run_id: str | None = None) -> dict[str, DataFrame]:
    """The tables of the last run published at ``target``, or of ``run_id``, by stage.

    A run that did not reach its end is not seen, whatever it has written.
    """
    rows = Records(spark, f"{target.rstrip('/')}/published").rows()
    if run_id is None and rows:
        run_id = rows[-1].run_id
    # A run that was published twice counts as of the last time.
    tables = {r.stage: r for r in rows if r.run_id == run_id}
    if not tables:
        raise ValueError(f"no published run {run_id or ''} at {target}")
    return {stage: spark.read.format(r.format).load(r.path) for stage, r in tables.items()}
