"""Lines that many documents share (operator 13).

Lines are exploded, normalised and hashed; the distinct documents of each hash
are counted; lines over the threshold stay in one document only, and what is
left of a text is put together by position.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import staged

#: What is stripped off both ends of a line (space and the ASCII controls 9-13).
BLANK = b"\x20\t\n\x0b\x0c\r"
LINE = "id long, text_id long, pos int, line binary"
#: Rows of lines that a Python worker hands over at a time.
BATCH = 65_536


def line_key(line: bytes) -> bytes:
    """A UTF-8 line without blanks at its ends, A-Z lower-cased."""
    return line.strip(BLANK).lower()


def _code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode("utf-8", "replace"))


def _explode(min_chars: int):
    """A row per line whose key is long enough: its place and the 128-bit hash of the key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []

        def out() -> pd.DataFrame:
            pdf = pd.DataFrame(rows, columns=["id", "text_id", "pos", "line"])
            pdf["id"] = pdf["id"].astype("Int64")
            rows.clear()
            return pdf

        for pdf in batches:
            for id_, text_id, text in zip(pdf["id"].astype("Int64"), pdf["text_id"], pdf["text"], strict=True):
                for pos, line in enumerate(text.encode().split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and _code_points(key) >= min_chars:
                        rows.append((id_, text_id, pos, md5(key).digest()))
                        if len(rows) >= BATCH:
                            yield out()
        if rows:
            yield out()

    return run


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    least_docs: int = 3,
) -> DataFrame:
    """``id_col, text_col, n_lines, n_dropped``, one row per row of ``docs``.

    A line's key is the line without blanks at its ends, A-Z lower-cased. A key
    of at least ``min_chars`` code points found in at least ``least_docs``
    documents keeps its lines only in the document of the largest id (all of
    them, if it holds several); the other documents lose theirs. Other lines
    stay as they are, in order. ``n_lines`` counts the lines before dropping.

    A null or empty text is one empty line and becomes an empty text. Rows of
    one id are one document for counting, and each row is cut on its own; rows
    with a null id are one document, whose id is below all others. An empty
    table gives no row. A text of any length is one row at the beginning and at
    the end, a line of it a row of 36 bytes in between. Columns of ``docs``
    beside the two named are not read.

    Hot lines are counted by partial aggregation, first by line and document;
    its documents meet the one row of the line in an inner join, which adaptive
    execution may split. Keys are told apart by 128 bits of MD5.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_id", F.xxhash64("text"))
    lines = staged(rows.select("id", "text_id", "text").mapInPandas(_explode(min_chars), LINE), "line-keys")

    # The null id is a document, too; a line of nothing else is in one document.
    counts = lines.groupBy("line").agg(
        F.count_distinct("id").alias("docs"), F.max(F.col("id").isNull().cast("int")).alias("unnamed"), F.max("id").alias("keeper")
    )
    # Written, so that both sides of the join below are shuffled for it alone
    # and a hot line's documents can be split.
    common = staged(counts.where(F.col("docs") + F.col("unnamed") >= least_docs).select("line", "keeper"), "line-common")

    lost = lines.join(common, "line").where(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = lost.groupBy("id", "text_id").agg(F.collect_set("pos").alias("lost"))
    lost = lost.select(F.col("id").alias("lost_id"), F.col("text_id").alias("lost_text"), "lost")

    same = F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("text_id") == F.col("lost_text"))
    parts = F.split("text", "\n")
    joined = rows.join(lost, same, "left").withColumn("n_lines", F.size(parts).cast("long"))
    # The parts and the places that stay are bound once per row: a place is then
    # an index, so the work is linear in the lines.
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "lost")
    bound = F.array(F.struct(parts.alias("parts"), stay.alias("stay")))
    kept = F.get(F.transform(bound, lambda b: F.array_join(F.transform(b["stay"], lambda i: F.get(b["parts"], i)), "\n")), 0)
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(kept).alias(text_col),
        "n_lines",
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def digest(deduplicated: DataFrame) -> DataFrame:
    return deduplicated.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
