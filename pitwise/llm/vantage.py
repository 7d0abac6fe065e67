"""Nearest neighbours by vantage-point trees over shards (operator 4).

Distance is the chord between directions, so the triangle inequality holds.
A vantage-point tree fitted on a bounded sample cuts the space into shards:
every row goes down it, nearer or farther than a node's median, to its shard,
and each shard (in parts of a bounded size) gets a tree of its own.

A query first searches the shard it falls into. The distance of the worst
neighbour it holds then decides where else to look: a shard is skipped as a
whole, and a subtree of a shard's tree likewise, if ``factor`` times its lower
bound by the triangle inequality exceeds that distance. Factor 1 is exact,
larger factors skip more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import staged

#: Vectors per shard or part of one, queries per block, and vectors per leaf.
SHARD, BLOCK, LEAF = 4096, 512, 256
#: Components of the sample that the shards are fitted on, vectors of it per shard, and levels at most.
SAMPLE, PER_SHARD, LEVELS = 1 << 22, 16, 12
#: Vantage points, those of the upper nodes first, that a shard's distances are measured from.
POINTS = 64
#: Chords are compared with this slack, above their rounding error.
SLACK = 1e-7
#: Rounding error that cosines of one pair may differ by.
ROUNDING = 1e-12
#: The id in a place that no neighbour holds.
NOBODY = np.iinfo("int64").max

TREE = "dim int, shard int, part int, rows binary, ids binary, vectors binary, bounds binary, least array<double>, most array<double>"
PACKED = "dim int, shard int, block int, q_rows binary, q_ids binary, q_vectors binary, q_floors binary"
FOUND = "q_row long, query_id long, vec_id long, score double"
SAMPLED = "dim int, rows binary, vectors binary"
FITTED = "dim int, points binary, medians binary"


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows scaled by powers of two to a largest component in [0.5, 1), which is exact."""
    m = np.stack([np.asarray(v, dtype="float64") for v in vectors])
    return np.ldexp(m, -np.frexp(np.abs(m).max(axis=1))[1][:, None])


def cosines(a: np.ndarray, a_norm: np.ndarray, b: np.ndarray, b_norm: np.ndarray) -> np.ndarray:
    """All pairs' cosines, up to rounding that depends on the others."""
    return (a @ b.T) / (a_norm[:, None] * b_norm[None, :])


def exact_cosines(a: np.ndarray, a_norm: np.ndarray, b: np.ndarray, b_norm: np.ndarray) -> np.ndarray:
    """The cosines of ``a[i]`` and ``b[i]``; a pair's value does not depend on the others."""
    return _dots(a, b) / (a_norm * b_norm)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row products, added up component by component in order."""
    out = np.zeros(len(a))
    for i in range(a.shape[1]):
        out += a[:, i] * b[:, i]
    return out


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(_dots(m, m))


def _chord(cos: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cos))


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the vectors in the tree, and each node's distance bounds.

    A node is a run of the order: its vantage point, then the nearer half,
    then the farther half of the rest. ``bounds[start]`` has the smallest and
    largest distance of either half. Equal distances are parted by place, so
    any number of equal vectors leaves the tree balanced.
    """
    norms = _norms(vectors)
    order, bounds = np.arange(len(vectors)), np.zeros((len(vectors), 4))
    todo = [(0, len(vectors))]
    while todo:
        start, end = todo.pop()
        if end - start <= LEAF:
            continue
        own = order[start:end]
        # The point farthest from another one sees the others spread out.
        far = _chord(cosines(vectors[own[:1]], norms[own[:1]], vectors[own], norms[own])[0]).argmax()
        own[[0, far]] = own[[far, 0]]
        rest = own[1:]
        d = _chord(cosines(vectors[own[:1]], norms[own[:1]], vectors[rest], norms[rest])[0])
        by = np.argsort(d, kind="stable")
        own[1:], d = rest[by], d[by]
        half = len(d) // 2
        bounds[start] = d[0], d[half - 1], d[half], d[-1]
        todo += [(start + 1, start + 1 + half), (start + 1 + half, end)]
    return order, bounds


def reach(worst: np.ndarray) -> np.ndarray:
    """The distance within which a vector may be nearer than one of cosine ``worst`` (-inf: any)."""
    return np.where(worst == -np.inf, np.inf, _chord(np.maximum(worst, -1.0))) + SLACK


class Shards:
    """The upper levels of a vantage tree: a perfect binary tree of points and medians.

    Node ``i`` has the children ``2 i + 1`` (not farther than the median) and
    ``2 i + 2``; the shards are the children of the last level. ``least`` and
    ``most`` are the distances of a shard's rows from the first points.
    """

    def __init__(self, sample: np.ndarray, levels: int) -> None:
        points = np.zeros(((1 << levels) - 1, sample.shape[1]))
        medians = np.zeros((1 << levels) - 1)
        inside = {0: np.arange(len(sample))}
        norms = _norms(sample)
        for node in range(len(points)):
            own = inside.pop(node)
            # The point farthest from another one sees the others spread out.
            far = own[_chord(cosines(sample[own[:1]], norms[own[:1]], sample[own], norms[own])[0]).argmax()]
            d = _chord(cosines(sample[[far]], norms[[far]], sample[own], norms[own])[0])
            middle = np.sort(d)[(len(d) - 1) // 2]
            points[node], medians[node] = sample[far], middle
            near, other = own[d <= middle], own[d > middle]
            inside[2 * node + 1] = near
            inside[2 * node + 2] = other if len(other) else near[:1]  # equal vectors: nothing is farther
        self._hold(points, medians)

    @classmethod
    def fitted(cls, points: np.ndarray, medians: np.ndarray) -> Shards:
        """The shards of points and medians that were fitted before."""
        out = cls.__new__(cls)
        out._hold(points, medians)
        return out

    def _hold(self, points: np.ndarray, medians: np.ndarray) -> None:
        self.levels, self.points, self.medians, self.norms = len(points).bit_length(), points, medians, _norms(points)
        empty = (len(points) + 1, min(POINTS, len(points)))
        self.least, self.most = np.full(empty, np.inf), np.full(empty, -np.inf)

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The shard of each vector."""
        node, norms = np.zeros(len(vectors), dtype="int64"), _norms(vectors)
        for _ in range(self.levels):
            d = _chord(exact_cosines(vectors, norms, self.points[node], self.norms[node]))
            node = 2 * node + 1 + (d > self.medians[node])
        return node - len(self.points)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """By vector and point, for the first ``POINTS``."""
        n = self.least.shape[1]
        return _chord(cosines(vectors, _norms(vectors), self.points[:n], self.norms[:n]))

    def bounds(self, vectors: np.ndarray) -> np.ndarray:
        """By vector and shard, a lower bound of the distance to whatever is in the shard; infinite for an empty one."""
        out = np.zeros((len(vectors), len(self.least)))
        for j, d in enumerate(self.distances(vectors).T):
            np.maximum(out, self.least[None, :, j] - d[:, None], out=out)
            np.maximum(out, d[:, None] - self.most[None, :, j], out=out)
        return out


class Search:
    """The ``k`` nearest of a tree's vectors for a block of queries.

    ``queries["floors"]``, if given, are cosines below which a query has no use for a vector.
    """

    def __init__(self, tree: dict, queries: dict, k: int, factor: float) -> None:
        self.t, self.q, self.k, self.factor = tree, queries, k, factor
        n = len(queries["rows"])
        self.cos = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), NOBODY)
        self.floors = queries.get("floors", np.full(n, -np.inf))
        self.t_norm, self.q_norm = _norms(tree["vectors"]), _norms(queries["vectors"])

    def offer(self, active: np.ndarray, start: int, end: int) -> np.ndarray:
        """Hold what is nearer among the vectors ``start`` to ``end``; all their cosines, roughly.

        Pairs that may be among the nearest are computed again on their own,
        so equal vectors have equal cosines wherever they are met.
        """
        q, q_norm, v, v_norm = self.q["vectors"][active], self.q_norm[active], self.t["vectors"][start:end], self.t_norm[start:end]
        rough = cosines(q, q_norm, v, v_norm)
        own = self.q["rows"][active][:, None] == self.t["rows"][None, start:end]
        may = (rough >= self.worst(active)[:, None] - ROUNDING) & ~own
        rows = np.flatnonzero(may.any(axis=1))
        if len(rows):
            i, j = np.nonzero(may[rows])
            cos = np.full((len(rows), end - start), -np.inf)
            cos[i, j] = exact_cosines(q[rows[i]], q_norm[rows[i]], v[j], v_norm[j])
            ids = np.where(cos > -np.inf, self.t["ids"][None, start:end], NOBODY)
            held = active[rows]
            cos, ids = np.concatenate([self.cos[held], cos], axis=1), np.concatenate([self.ids[held], ids], axis=1)
            by_id = np.argsort(ids, axis=1, kind="stable")
            cos, ids = np.take_along_axis(cos, by_id, 1), np.take_along_axis(ids, by_id, 1)
            best = np.argsort(-cos, axis=1, kind="stable")[:, : self.k]
            self.cos[held], self.ids[held] = np.take_along_axis(cos, best, 1), np.take_along_axis(ids, best, 1)
        return rough

    def worst(self, active: np.ndarray) -> np.ndarray:
        return np.maximum(self.cos[active, -1], self.floors[active])

    def near(self, active: np.ndarray, bound: np.ndarray) -> np.ndarray:
        return bound * self.factor <= reach(self.worst(active))

    def visit(self, active: np.ndarray, start: int, end: int) -> None:
        if not len(active) or start == end:
            return
        if end - start <= LEAF:
            self.offer(active, start, end)
            return
        d = _chord(self.offer(active, start, start + 1)[:, 0])
        in0, in1, out0, out1 = self.t["bounds"][start]
        middle = start + 1 + (end - start - 1) // 2
        sides = ((start + 1, middle, np.maximum(in0 - d, d - in1)), (middle, end, np.maximum(out0 - d, d - out1)))
        # The side that is nearer to most of the queries goes first.
        for side in sides if 2 * np.count_nonzero(sides[0][2] <= sides[1][2]) >= len(active) else sides[::-1]:
            now = self.near(active, side[2])
            self.visit(active[now], side[0], side[1])

    def run(self) -> None:
        self.visit(np.arange(len(self.q["rows"])), 0, len(self.t["rows"]))


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for a batch's vectors of a dimension."""
    for pdf in batches:
        for dim, own in pdf.groupby("dim"):
            row = (dim, own["row"].to_numpy("int64").tobytes(), _matrix(own["vector"]).tobytes())
            yield pd.DataFrame([row], columns=[c.split()[0] for c in SAMPLED.split(", ")])


def _fit(share: float):
    """The points and medians of a dimension, of the sample in the order of its rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        order = np.argsort(np.concatenate([_longs(b) for b in pdf["rows"]]))
        wanted = max(1, round(len(order) / share / SHARD))
        levels = min(LEVELS, (wanted - 1).bit_length(), max(0, (len(order) // PER_SHARD).bit_length() - 1))
        fitted = []
        if levels:
            sample = np.concatenate([np.frombuffer(b).reshape(-1, dim) for b in pdf["vectors"]])[order]
            shards = Shards(sample, levels)
            fitted = [(dim, shards.points.tobytes(), shards.medians.tobytes())]
        return pd.DataFrame(fitted, columns=[c.split()[0] for c in FITTED.split(", ")])

    return run


def _plant(shards: dict[int, Shards]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = _matrix(pdf["vector"])
        order, bounds = build(vectors)
        rows, ids = pdf["row"].to_numpy("int64")[order], pdf["id"].to_numpy("int64")[order]
        dim, shard, part = (int(pdf[c].iloc[0]) for c in ("dim", "shard", "part"))
        d = shards[dim].distances(vectors) if dim in shards else np.zeros((1, 0))
        row = (dim, shard, part, rows.tobytes(), ids.tobytes(), vectors[order].tobytes(), bounds.tobytes(), d.min(axis=0), d.max(axis=0))
        return pd.DataFrame([row], columns=[c.split()[0] for c in TREE.split(", ")])

    return run


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    rows, ids, floors = pdf["row"].to_numpy("int64"), pdf["id"].to_numpy("int64"), pdf["floor"].to_numpy("float64")
    at = [int(pdf[c].iloc[0]) for c in ("dim", "shard", "block")]
    row = (*at, rows.tobytes(), ids.tobytes(), _matrix(pdf["vector"]).tobytes(), floors.tobytes())
    return pd.DataFrame([row], columns=["dim", "shard", "block", "q_rows", "q_ids", "q_vectors", "q_floors"])


def _longs(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype="int64")


def _route(shards: dict[int, Shards]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["shard"] = np.zeros(len(pdf), dtype="int32")
            for dim, own in pdf.groupby("dim").groups.items():
                if dim in shards:
                    pdf.loc[own, "shard"] = shards[dim].route(_matrix(pdf.loc[own, "vector"])).astype("int32")
            yield pdf

    return run


def _elsewhere(shards: dict[int, Shards], factor: float):
    """Blocks of queries to rows for each other shard that may hold something nearer, with the queries that need it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.dim not in shards:
                    continue
                vectors, floors = np.frombuffer(r.q_vectors).reshape(-1, r.dim), np.frombuffer(r.q_floors)
                needed = shards[r.dim].bounds(vectors) * factor <= reach(floors)[:, None]
                needed[:, r.shard] = False
                for shard in np.flatnonzero(needed.any(axis=0)):
                    own = np.flatnonzero(needed[:, shard])
                    longs = [_longs(b)[own].tobytes() for b in (r.q_rows, r.q_ids)]
                    row = (r.dim, shard, r.block, *longs, vectors[own].tobytes(), floors[own].tobytes())
                    yield pd.DataFrame([row], columns=list(pdf.columns))

    return run


def _search(k: int, factor: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                doubles = lambda b, n=r.dim: np.frombuffer(b).reshape(-1, n)
                tree = {"rows": _longs(r.rows), "ids": _longs(r.ids), "vectors": doubles(r.vectors), "bounds": doubles(r.bounds, 4)}
                queries = {"rows": _longs(r.q_rows), "ids": _longs(r.q_ids), "vectors": doubles(r.q_vectors), "floors": np.frombuffer(r.q_floors)}
                found = Search(tree, queries, k, factor)
                found.run()
                q, i = np.nonzero(found.cos > -np.inf)
                yield pd.DataFrame({"q_row": queries["rows"][q], "query_id": queries["ids"][q], "vec_id": found.ids[q, i], "score": found.cos[q, i]})

    return run


def usable(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``row, id, dim, vector`` of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0.0), F.lit(False)))
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", F.size("vector").alias("dim"), "vector")


def fit_shards(rows: DataFrame) -> dict[int, Shards]:
    """The shards of each dimension that has a share in the sample, of ``usable`` rows.

    The sample is of at most ``SAMPLE`` components (4,194,304; 65,536 vectors
    of 64 dimensions) in expectation, rows chosen by a hash of their place. A
    task gathers a dimension's share of it and fits the shards; their points and
    medians, a ``PER_SHARD``-th of the sample at most, go to the driver. A
    dimension has a shard per ``SHARD`` rows, rounded up to a power of two, at
    most one per ``PER_SHARD`` sampled vectors and ``2 ** LEVELS``; where rows
    are many more, shards have more parts.
    """
    size = rows.groupBy("dim").agg(F.count("*").alias("n"))
    total = size.agg(F.sum(F.col("n") * F.col("dim"))).first()[0] or 0
    if not total:
        return {}
    share = min(1.0, SAMPLE / total)
    chosen = F.shiftrightunsigned(F.xxhash64("row", F.lit("sample")), 11) < int(share * (1 << 53))
    sample = rows.where(chosen).select("row", "dim", "vector").mapInPandas(_gather, SAMPLED)
    out = {}
    for r in sample.groupBy("dim").applyInPandas(_fit(share), FITTED).collect():
        out[r.dim] = Shards.fitted(np.frombuffer(r.points).reshape(-1, r.dim), np.frombuffer(r.medians))
    return out


def measure(shards: dict[int, Shards], trees: DataFrame) -> None:
    """Note how near and far each shard's rows are: at most ``POINTS`` rows a shard go to the driver."""
    both = trees.select("dim", "shard", F.posexplode(F.arrays_zip("least", "most")).alias("j", "d"))
    both = both.groupBy("dim", "shard", "j").agg(F.min("d.least").alias("least"), F.max("d.most").alias("most"))
    for r in both.toLocalIterator():
        shards[r.dim].least[r.shard, r.j], shards[r.dim].most[r.shard, r.j] = r.least, r.most


def dealt(rows: DataFrame, size: int, name: str) -> DataFrame:
    """``rows`` of ``dim, shard, row`` with ``name``: a number such that about ``size`` rows of a shard share it."""
    counts = rows.groupBy("dim", "shard").agg(F.ceil(F.count("*") / size).alias("__n"))
    return rows.join(counts, ["dim", "shard"]).withColumn(name, F.pmod(F.xxhash64("row"), "__n").cast("int")).drop("__n")


def build_index(rows: DataFrame) -> tuple[DataFrame, DataFrame, dict[int, Shards]]:
    """``usable`` rows with their ``shard``, a tree for each part of a shard, and the shards."""
    shards = fit_shards(rows)
    routed = staged(rows.mapInPandas(_route(shards), "row long, id long, dim int, vector array<double>, shard int"), "vantage-routed")
    trees = dealt(routed, SHARD, "part").groupBy("dim", "shard", "part").applyInPandas(_plant(shards), TREE)
    trees = staged(trees, "vantage-index")
    measure(shards, trees)
    return routed, trees.drop("least", "most"), shards


def nearest(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    factor: float = 1.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are
    all rows but the query's own. Nearness is the cosine in double precision;
    the nearest have rank 1, ties go to the smaller id. A query with fewer
    candidates has so many rows.

    Rows with a null id, and vectors that are null, empty, zero or hold null
    or non-finite components, take no part. Vectors are compared with those
    of their own dimension. Repeated rows are candidates of one another. An
    empty table gives no row. Every row is in the index; equal vectors may
    fill a shard, which then has more parts.
    """
    routed, index, shards = build_index(staged(usable(vectors, id_col=id_col, vector_col=vector_col), "vectors"))
    first = F.row_number().over(W.partitionBy("q_row").orderBy(F.desc("score"), "vec_id"))
    queries = staged(dealt(routed.where(F.col("id") % every == 0), BLOCK, "block"), "vantage-queries")
    packed = queries.withColumn("floor", F.lit(float("-inf"))).groupBy("dim", "shard", "block").applyInPandas(_pack, PACKED)
    # The hint keeps a join from being a broadcast, which would bring the vectors to the driver.
    index = index.hint("merge")
    home = packed.join(index, ["dim", "shard"]).mapInPandas(_search(k, factor), FOUND)
    home = staged(home.withColumn("rank", first).where(F.col("rank") <= k), "vantage-home")

    # A query that holds k neighbours needs no vector farther than the last.
    floors = home.groupBy(F.col("q_row").alias("row")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floor = F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf"))
    again = queries.join(floors, "row", "left").select(*queries.columns, F.coalesce(floor, F.lit(float("-inf"))).alias("floor"))
    packed = again.groupBy("dim", "shard", "block").applyInPandas(_pack, PACKED)
    sent = packed.mapInPandas(_elsewhere(shards, factor), PACKED)
    others = sent.join(index, ["dim", "shard"]).mapInPandas(_search(k, factor), FOUND)
    found = home.drop("rank").unionByName(others)
    return found.withColumn("rank", first).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
