"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of these characters separate words (space and the ASCII controls 9-13).
SPACES = r"[\x20\x09-\x0D]+"

#: Prefix of the columns that an operator adds for its own use.
OWN = "__llm_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    A local session without the setting (tests) gets a temporary folder; any
    other master must name one, since executors cannot see a local folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="pitwise-llm-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Folders written since the beginning of each open ``scratch``, the innermost last.
_open: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing
    what went before. The schema is passed on, so an empty result reads back.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pitwise-llm/{name}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The folders that ``staged`` writes meanwhile; those still in the list at the end are deleted.

    For a step whose result is written itself: nothing then reads what the
    step has staged. What the caller takes out of the list stays.
    """
    _open.append([])
    try:
        yield _open[-1]
    finally:
        for path in _open.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context.

    What ``--py-files`` does, for sessions that were started without it.
    """
    import pitwise

    name = "pitwise-shipped.zip"
    context = spark.sparkContext
    if name not in context._python_includes:
        root = os.path.dirname(os.path.dirname(os.path.abspath(pitwise.__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="pitwise-ship-"), name[: -len(".zip")])
        context.addPyFile(shutil.make_archive(target, "zip", root, "pitwise"))


def word_count(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    n = F.size(F.split(text, SPACES))
    edge = lambda pattern: text.rlike(pattern).cast("int")
    # A text of white space only splits into two empty parts, one of each edge.
    n = n - edge(r"\A[\x20\x09-\x0D]") - F.when(F.length(text) > 0, edge(r"[\x20\x09-\x0D]\z")).otherwise(1)
    return F.coalesce(n, F.lit(0)).cast("long")


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary file of this name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


