"""Token counts by heap-and-linked-list byte-pair merging (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.bpe import heap_counter


def token_count(text: Column, path: str) -> Column:
    """The number of tokens of ``text`` in the byte-level vocabulary at ``path``.

    Special strings inside a text are one token each, as the library has it.
    Null and empty texts have 0. Each Python worker reads the vocabulary once
    and keeps the counts of a bounded number of pieces.
    """

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = heap_counter(path)
        for texts in batches:
            yield pd.Series([counter.count(x) for x in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    One narrow pass: no shuffle, one row out per row in, so repeated rows and
    null ids come through as they are. A null or empty text has 0 bytes and 0
    tokens and is not over the limit; an empty table gives no row. A text of any
    length is counted as a whole. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        token_count(text, path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
