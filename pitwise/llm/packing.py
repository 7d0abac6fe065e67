"""Cost-balanced packing of documents into sequences (operator 1).

A document of ``n`` tokens costs ``6 * width * n + n ** 2`` in a transformer
layer of that width (projections are linear, attention within the document is
quadratic; a common factor is left out). Documents are dealt to blocks of a
bounded number; within a block they are taken in descending order, and each
goes to the sequence of lowest cost that has room for it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.bpe import encoder

PIECE = "__block long, doc_id long, doc_tokens long, start long, length long, ids_crc32 long, ids binary"
PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_cost double"
)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def _cut(path: str, end_id: int, capacity: int, keep_ids: bool):
    """Rows of documents to rows of pieces: whole sequences, and one rest with its ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        dtype = "<u2" if enc.n_vocab <= 1 << 16 and end_id < 1 << 16 else "<u4"
        for pdf in batches:
            rows = []
            for block, doc_id, text in zip(pdf["block"], pdf["doc_id"], pdf["text"], strict=True):
                ids = np.array([*enc.encode(text), end_id], dtype=dtype)
                n = len(ids)
                for start in range(0, n, capacity):
                    part = ids[start : start + capacity]
                    whole = len(part) == capacity
                    rows.append((block, doc_id, n, start, len(part), crc32_of(part), part.tobytes() if keep_ids or not whole else None))
            out = pd.DataFrame(rows, columns=["__block", "doc_id", "doc_tokens", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def assign(lengths: list[int], capacity: int, width: int) -> tuple[list[tuple[int, int, int, int]], np.ndarray]:
    """Descending documents to the lowest-cost sequence with room.

    ``lengths`` are in descending order. There are as many sequences as their
    sum needs. A document that no sequence has room for as a whole is cut: the
    lowest-cost sequence with any room takes what fits, then the next. Returns
    (document, start in it, length, sequence) per piece and each sequence's
    cost. Ties go to the first sequence.
    """
    n = max(1, -(-sum(lengths) // capacity))
    cost, room = np.zeros(n), np.full(n, capacity)
    out = []
    for k, left in enumerate(lengths):
        start = 0
        while left:
            fits = np.flatnonzero(room >= left)
            part = left
            if not len(fits):
                fits = np.flatnonzero(room)
            s = int(fits[cost[fits].argmin()])
            part = min(left, int(room[s]))
            out.append((k, start, part, s))
            cost[s] += 6.0 * width * part + float(part) ** 2
            room[s] -= part
            start, left = start + part, left - part
    return out, cost


def _pack(capacity: int, width: int, keep_ids: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        block = int(pdf["__block"].iloc[0])
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        whole = pdf["length"].to_numpy() == capacity
        rest = pdf[~whole]
        placed, cost = assign(rest["length"].tolist(), capacity, width)
        used = np.zeros(max(1, len(cost)), dtype="int64")
        doc_ids, starts, crcs = rest["doc_id"].tolist(), rest["start"].tolist(), rest["ids_crc32"].tolist()
        totals, lengths, ids = rest["doc_tokens"].tolist(), rest["length"].tolist(), rest["ids"].tolist()
        rows = []
        for k, start, n, s in placed:
            if n == lengths[k]:
                crc, own = crcs[k], ids[k]
            else:
                each = len(ids[k]) // lengths[k]
                own = ids[k][start * each : (start + n) * each]
                crc = crc32_of(np.frombuffer(own, dtype=f"<u{each}"))
            rows.append((doc_ids[k], starts[k] + start, n, crc, totals[k], s, int(used[s]), float(cost[s]), own))
            used[s] += n
        full = 6.0 * width * capacity + float(capacity) ** 2
        first = len(cost)
        for i, r in enumerate(pdf[whole].itertuples(index=False)):
            rows.append((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, first + i, 0, full, r.ids))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_cost", "ids"]
        out = pd.DataFrame(rows, columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["sequence_id"] += block << 32
        return out if keep_ids else out.drop(columns="ids")

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    width: int = 1024,
    block_docs: int = 2048,
    keep_ids: bool = False,
    in_order: bool = False,
) -> DataFrame:
    """One row per piece of a document with its sequence and place there.

    A document is its token ids and then ``end_id``. What exceeds
    ``capacity`` is cut off as whole sequences, in order; the rests are packed
    block by block, so that a block's sequences hold ``capacity`` tokens but
    for less than one sequence's worth. A block has about ``block_docs``
    documents, however many copies or rows of one source there are: rows are
    dealt by their own number, not by any value; ``in_order``, blocks are runs
    of rows as they are read, so that documents shuffled before stay together
    (the last block of each task may be short). ``keep_ids`` adds the pieces'
    ids (little-endian, 2 bytes each if the vocabulary allows it, else 4).

    A null or empty text is a document of one token, the end; null ids come
    through as null; repeated rows are packed as so many documents; an empty
    table gives no row. A text of any length, of white space or one letter
    only, too, is encoded and cut in one task. Columns of ``docs`` beside the
    two named are not read.
    """
    number = F.monotonically_increasing_id()
    if in_order:
        # The task in the upper bits, the row within it in the lower 33.
        task, row = F.shiftright(number, 33), number.bitwiseAND(F.lit((1 << 33) - 1))
        # Two runs that share a number are one block of twice the size.
        block = F.pmod(F.xxhash64(task, F.floor(row / block_docs)), F.lit(1 << 31))
    else:
        block = F.pmod(F.xxhash64(number), F.lit(max(1, -(-docs.count() // block_docs))))
    rows = docs.select(
        block.alias("block"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    pieces = rows.mapInPandas(_cut(path, end_id, capacity, keep_ids), PIECE)
    schema = PACKED + (", ids binary" if keep_ids else "")
    return pieces.groupBy("__block").applyInPandas(_pack(capacity, width, keep_ids), schema)
