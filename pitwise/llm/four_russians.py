"""Hard negatives by Four-Russians scoring (operator 12).

Integer vectors are cut into groups of eight dimensions. Bit ``k`` of a group's
eight components is one byte of a candidate (two's complement planes). For an
anchor, the sums of every subset of a group's components make a table of 256
entries, so a candidate's inner product with it is a shifted sum of one lookup
per group and plane. All scores are exact integers.

Anchors go in blocks to every shard of candidates, twice: among the rows of the
anchor's label for its positives, then among the others for its negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import staged

#: Components of a block of candidates, and of a block of anchors, at most on average.
CANDIDATES, ANCHORS = 1 << 18, 1 << 15
#: Blocks of candidates in a shard, at most.
SHARD = 32
#: Candidates that are scored at a time.
STRIP = 512
#: The id in a place that nothing holds.
NOBODY = np.iinfo("int64").max

PLANES = "dim int, block long, shard long, n_planes int, rows binary, ids binary, labels binary, planes binary"
ANCHOR = "dim int, a_block long, a_rows binary, a_labels binary, a_vectors binary, a_positives binary"


def bit_planes(vectors: np.ndarray) -> tuple[int, np.ndarray]:
    """The number of planes, and bytes by row, group and plane, lowest bit first.

    The last plane is the sign. A group that eight dimensions do not fill is
    padded with zeros.
    """
    n, dim = vectors.shape
    magnitude = np.where(vectors < 0, ~vectors, vectors)
    count = int(magnitude.max(initial=0)).bit_length() + 1
    groups = -(-dim // 8)
    padded = np.zeros((n, groups * 8), dtype="int64")
    padded[:, :dim] = vectors
    out = np.empty((n, groups, count), dtype="uint8")
    for k in range(count):
        # An arithmetic shift: beyond the highest bit comes the sign.
        bits = ((padded >> min(k, 63)) & 1).astype("uint8").reshape(n, groups, 8)
        out[:, :, k] = np.packbits(bits, axis=2, bitorder="little")[:, :, 0]
    return count, out


def subset_sums(anchors: np.ndarray, dtype: str) -> np.ndarray:
    """Tables by group, byte and anchor: the sum of the components whose bits are set."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    padded = np.zeros((groups * 8, n), dtype=dtype)
    padded[:dim] = anchors.T
    tables = np.zeros((groups, 256, n), dtype=dtype)
    for g in range(groups):
        for d in range(8):
            # Subsets with d as the highest dimension: those below, and d.
            tables[g, 1 << d : 2 << d] = tables[g, : 1 << d] + padded[8 * g + d]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products by candidate and anchor, by shifts and additions of lookups."""
    n, groups, count = planes.shape
    out = np.zeros((n, tables.shape[2]), dtype=tables.dtype)
    part = np.empty_like(out)
    for k in reversed(range(count)):
        # From the sign down: what is summed so far is shifted by one plane.
        if k < count - 1:
            np.left_shift(out, 1, out=out)
        for g in range(groups):
            np.take(tables[g], planes[:, g, k], axis=0, out=part, mode="clip")
            if k == count - 1:
                out -= part
            else:
                out += part
    return out


def number_type(anchors: np.ndarray, n_planes: int) -> str:
    """32 bits where no sum on the way can exceed them, else 64 (which wrap around as longs do)."""
    if not anchors.size:
        return "int32"
    most = max(abs(int(anchors.max())), abs(int(anchors.min()))) * anchors.shape[1]
    return "int32" if most << n_planes < 1 << 31 else "int64"


def limits(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and largest negative score for a positive score: 30 and 90 per cent, without overflow."""
    tens, rest = positive // 10, positive % 10
    return 3 * tens - (-3 * rest) // 10, 9 * tens + 9 * rest // 10


class Best:
    """The ``k`` first of each of ``n`` lists, by score descending and id ascending."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.zeros((n, k), dtype="int64")
        self.id = np.full((n, k), NOBODY)
        self.held = np.zeros((n, k), dtype=bool)

    def offer(self, i: int, score: np.ndarray, id_: np.ndarray) -> None:
        own = self.held[i]
        score, id_ = np.concatenate([self.score[i][own], score]), np.concatenate([self.id[i][own], id_])
        # ~x orders longs from large to small; -x would overflow for the least one.
        first = np.lexsort((id_, ~score))[: self.k]
        n = len(first)
        self.score[i, :n], self.id[i, :n] = score[first], id_[first]
        self.held[i, :n] = True

    def may_enter(self, i: int, score: np.ndarray) -> np.ndarray:
        return score >= self.score[i, -1] if self.held[i, -1] else np.ones(len(score), dtype=bool)


def _longs(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype="int64")


class Miner:
    """What one block of anchors has found so far in the candidates it has met."""

    def __init__(self, row, k_positives: int, k_negatives: int) -> None:
        self.rows, self.labels = _longs(row.a_rows), _longs(row.a_labels)
        self.vectors = _longs(row.a_vectors).reshape(len(self.rows), row.dim)
        self.positives = _longs(row.a_positives).reshape(len(self.rows), -1) if row.a_positives is not None else None
        self.tables: dict[str, np.ndarray] = {}
        self.k = k_positives
        n = len(self.rows)
        self.best = Best(n, k_positives) if self.positives is None else Best(n * k_positives, k_negatives)
        if self.positives is not None:
            self.count, self.p_score = self.positives[:, 0], self.positives[:, 1 : 1 + self.k]
            self.p_id = self.positives[:, 1 + self.k :]
            self.low, self.high = limits(self.p_score)

    def table(self, n_planes: int) -> np.ndarray:
        kind = number_type(self.vectors, n_planes)
        if kind not in self.tables:
            self.tables[kind] = subset_sums(self.vectors, kind)
        return self.tables[kind]

    def meet(self, row) -> None:
        rows, ids, labels = _longs(row.rows), _longs(row.ids), _longs(row.labels)
        planes = np.frombuffer(row.planes, dtype="uint8").reshape(len(rows), -(-row.dim // 8), row.n_planes)
        tables = self.table(row.n_planes)
        if self.positives is None:
            for label in np.unique(self.labels):
                mine, theirs = np.flatnonzero(self.labels == label), np.flatnonzero(labels == label)
                if len(theirs):
                    own = np.ascontiguousarray(tables[:, :, mine])
                    for strip in np.array_split(theirs, -(-len(theirs) // STRIP)):
                        self._positives(mine, scores(own, planes[strip]), rows[strip], ids[strip])
        else:
            for strip in np.array_split(np.arange(len(rows)), -(-len(rows) // STRIP)):
                self._negatives(scores(tables, planes[strip]), ids[strip], labels[strip])

    def _positives(self, mine: np.ndarray, found: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        for j, i in enumerate(mine):
            score = found[:, j].astype("int64")
            may = np.flatnonzero(self.best.may_enter(i, score) & (rows != self.rows[i]))
            if len(may):
                self.best.offer(i, score[may], ids[may])

    def _negatives(self, found: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for i, n in enumerate(self.count):
            if not n:
                continue
            score = found[:, i].astype("int64")
            low, high = self.low[i, :n], self.high[i, :n]
            may = np.flatnonzero((score >= low.min()) & (score <= high.max()) & (labels != self.labels[i]))
            if not len(may):
                continue
            near, near_ids = score[may], ids[may]
            for p in range(n):
                at = i * self.k + p
                own = (near >= low[p]) & (near <= high[p]) & self.best.may_enter(at, near)
                if own.any():
                    self.best.offer(at, near[own], near_ids[own])

    def found(self) -> pd.DataFrame:
        i, j = np.nonzero(self.best.held)
        if self.positives is None:
            return pd.DataFrame({"a_row": self.rows[i], "id": self.best.id[i, j], "score": self.best.score[i, j]})
        a, p = i // self.k, i % self.k
        return pd.DataFrame(
            {
                "a_row": self.rows[a],
                "p": p.astype("int32"),
                "positive_id": self.p_id[a, p],
                "positive_score": self.p_score[a, p],
                "negative_id": self.best.id[i, j],
                "negative_score": self.best.score[i, j],
            }
        )


def _mine(k_positives: int, k_negatives: int):
    """Pairs of blocks to the best of each anchor block and run of candidate blocks.

    The join hands an anchor block's candidates over one after another; its
    finds are handed on when another block of anchors or another shard comes.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, miner = None, None
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if at != (row.dim, row.a_block, row.shard):
                    if miner is not None:
                        yield miner.found()
                    at, miner = (row.dim, row.a_block, row.shard), Miner(row, k_positives, k_negatives)
                miner.meet(row)
        if miner is not None:
            yield miner.found()

    return run


def _pack_candidates(per_shard: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, block = int(pdf["dim"].iloc[0]), int(pdf["block"].iloc[0])
        vectors = np.stack([np.asarray(v, dtype="int64") for v in pdf["vector"]])
        count, planes = bit_planes(vectors)
        longs = [pdf[c].to_numpy("int64").tobytes() for c in ("row", "id", "label")]
        return pd.DataFrame([(dim, block, block // per_shard, count, *longs, planes.tobytes())], columns=[c.split()[0] for c in PLANES.split(", ")])

    return run


def _pack_anchors(k: int):
    """Anchors of a block; with positives: how many, their scores and their ids, padded to ``k`` each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, block = int(pdf["dim"].iloc[0]), int(pdf["a_block"].iloc[0])
        vectors = np.stack([np.asarray(v, dtype="int64") for v in pdf["vector"]])
        positives = None
        if "p_scores" in pdf:
            table = np.zeros((len(pdf), 1 + 2 * k), dtype="int64")
            for i, (s, d) in enumerate(zip(pdf["p_scores"], pdf["p_ids"], strict=True)):
                table[i, 0] = len(s)
                table[i, 1 : 1 + len(s)], table[i, 1 + k : 1 + k + len(d)] = s, d
            positives = table.tobytes()
        row = (dim, block, pdf["row"].to_numpy("int64").tobytes(), pdf["label"].to_numpy("int64").tobytes(), vectors.tobytes(), positives)
        return pd.DataFrame([row], columns=[c.split()[0] for c in ANCHOR.split(", ")])

    return run


def quantised(vectors: DataFrame, scale: int = 256, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``row, id, label, dim, vector`` with integer components, of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("v", finite), F.lit(False)))
    # floor() keeps what a long cannot hold at its ends.
    whole = F.transform("v", lambda x: F.floor(x * float(scale)))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", F.size("v").alias("dim"), whole.alias("vector"))


def hard_negatives(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components are ``floor(scale * x)``, a row's score is its inner product
    with the anchor, exactly. Anchors are the rows whose id is divisible by
    ``every``; an anchor's positives are the first ``positives`` other rows of
    its label, by score descending and id ascending; for each, the first
    ``negatives`` rows of other labels that score from 30 to 90 per cent of the
    positive, in the same order, have ``rank`` from 1. An anchor without
    positives, or a positive without such rows, gives no row.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part. Vectors are compared with those of their own dimension; empty
    ones score 0. Components beyond a long stay at its ends, and sums wrap
    around as longs do. Repeated rows are rows of their own: an anchor's equal
    is among its positives, and where two rows tie in score and id each has a
    rank. An empty table gives no row. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = staged(quantised(vectors, scale, id_col=id_col, vector_col=vector_col, label_col=label_col), "quantised")
    is_anchor = F.col("id") % every == 0
    size = F.sum(F.greatest("dim", F.lit(8)).cast("long"))
    total, chosen = rows.agg(size, F.sum(F.when(is_anchor, F.greatest("dim", F.lit(8))).cast("long"))).first()
    blocks, a_blocks = max(1, -(-(total or 0) // CANDIDATES)), max(1, -(-(chosen or 0) // ANCHORS))
    per_shard = min(SHARD, max(1, blocks // (4 * spark.sparkContext.defaultParallelism)))
    shards = -(-blocks // per_shard)
    dealt = lambda parts: F.pmod(F.xxhash64("row"), F.lit(parts))
    index = staged(rows.withColumn("block", dealt(blocks)).groupBy("dim", "block").applyInPandas(_pack_candidates(per_shard), PLANES), "bit-planes")
    anchors = staged(rows.where(is_anchor).withColumn("a_block", dealt(a_blocks)), "anchors")

    def met(own: DataFrame, schema: str) -> DataFrame:
        packed = own.groupBy("dim", "a_block").applyInPandas(_pack_anchors(positives), ANCHOR)
        sent = packed.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        # A merge join hands an anchor block's rows over in a run.
        return sent.hint("merge").join(index, ["dim", "shard"]).mapInPandas(_mine(positives, negatives), schema)

    first = lambda keys, score, id_: F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(score), id_))
    near = met(anchors, "a_row long, id long, score long").withColumn("rank", first(["a_row"], "score", "id")).where(F.col("rank") <= positives)
    near = near.groupBy("a_row").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("near"))
    near = near.select(F.col("a_row").alias("row"), F.col("near")["score"].alias("p_scores"), F.col("near")["id"].alias("p_ids"))
    paired = staged(anchors.join(near, "row"), "positives")

    kind = "a_row long, p int, positive_id long, positive_score long, negative_id long, negative_score long"
    out = met(paired, kind).withColumn("rank", first(["a_row", "p"], "negative_score", "negative_id")).where(F.col("rank") <= negatives)
    ids = anchors.select(F.col("row").alias("a_row"), F.col("id").alias("anchor_id"))
    return out.join(ids, "a_row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted_labels(vectors: DataFrame, *, every: int = 7, labels: int = 10) -> DataFrame:
    """``vectors`` with the label of every seventh id moved on by one."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))
