"""Operator 4 against brute force."""

import pickle
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwise.llm import vantage
from pitwise.llm.common import staged
from tests.llm.helpers import SF, by_id

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def brute(rows, every=50, k=5):
    """Ranked (score, id) of each usable query, as ids are unique here."""
    usable = [(i, np.array(v, dtype="float32").astype("float64")) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            cos = [(-(v * w).sum() / (np.sqrt((v * v).sum()) * np.sqrt((w * w).sum())), j) for j, w in usable if j != i and len(w) == len(v)]
            out[i] = [(j, -c) for c, j in sorted((round(c, 13), j) for c, j in cos)[:k]]
    return out


def check(out, want):
    got = by_id(out, "query_id")
    assert set(got) == {q for q, near in want.items() if near}
    for q, own in got.items():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert [r.vec_id for r in own] == [j for j, _ in want[q]]
        assert [r.score for r in own] == pytest.approx([c for _, c in want[q]], abs=1e-12)


def table_rows(spark, sf=SF):
    return [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]


def test_factor_one_is_exact_on_the_table(spark):
    want = brute(table_rows(spark))
    check(vantage.nearest(spark.read.parquet(f"{SF}/embeddings.parquet"), factor=1.0).collect(), want)


def test_recall_of_the_query(spark):
    from pitwise.llm.registry import queries

    sf = SF.replace("0.001", "0.1")
    want = brute(table_rows(spark, sf))
    got = by_id(queries()["op4_vantage_trees"](spark, sf).collect(), "query_id")
    hits = sum(len({r.vec_id for r in got[q]} & {j for j, _ in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_many_shards_ties_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 64)
    monkeypatch.setattr(vantage, "BLOCK", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, [1.0, 0, 0, 0, 0, 0]) for i in range(300)]
    check(vantage.nearest(frame(spark, rows)).collect(), brute(rows))


def clustered(rng, centres, each, dim=16):
    middle = rng.normal(size=(centres, dim)) * 3
    return [(middle[i % centres] + rng.normal(size=dim) * 0.2).tolist() for i in range(centres * each)]


def test_whole_shards_are_skipped_on_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 64)
    rng = np.random.default_rng(6)
    visited = {}
    for n in (16, 64):
        rows = list(enumerate(clustered(rng, n, 64)))
        df = frame(spark, rows)
        want = brute(rows)
        check(vantage.nearest(df).collect(), want)
        shards = vantage.build_index(staged(vantage.usable(df), "test-vectors"))[2][16]
        assert 1 << shards.levels == n
        queries = np.array([v for i, v in rows if i % 50 == 0])
        worst = np.array([want[i][-1][1] for i, _ in rows if i % 50 == 0])
        visited[n] = (shards.bounds(queries) <= vantage.reach(worst)[:, None]).sum(axis=1).mean()
    assert visited[64] < 2 * visited[16] and visited[64] < 16, visited


def test_shards_bound_what_is_routed_to_them():
    rng = np.random.default_rng(7)
    sample = rng.normal(size=(600, 5))
    shards = vantage.Shards(sample, 4)
    vectors, queries = rng.normal(size=(500, 5)), rng.normal(size=(40, 5))
    norm = lambda m: np.sqrt((m * m).sum(axis=1))
    far = np.sqrt(np.maximum(0, 2 - 2 * (queries @ vectors.T) / (norm(queries)[:, None] * norm(vectors)[None])))
    at, d = shards.route(vectors), shards.distances(vectors)
    for s in set(at):
        shards.least[s], shards.most[s] = d[at == s].min(axis=0), d[at == s].max(axis=0)
    bounds = shards.bounds(queries)
    assert set(at) <= set(range(16)) and len(set(at)) > 8
    assert (bounds[:, at] <= far + vantage.SLACK).all() and (bounds > 0).any()
    equal = vantage.Shards(np.ones((64, 3)), 2)  # nothing is farther than the median
    assert set(equal.route(np.ones((5, 3)))) == {0}


def test_the_sample_is_not_gathered_on_the_driver(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 64)
    rng = np.random.default_rng(9)
    rows = list(enumerate(rng.normal(size=(2000, 16)).tolist() + rng.normal(size=(300, 3)).tolist() + [[1.0, 2.0]] * 3))
    df = staged(vantage.usable(frame(spark, rows).repartition(7)), "test-vectors")
    sent, collect, iterate = [], type(df).collect, type(df).toLocalIterator
    monkeypatch.setattr(type(df), "collect", lambda self: [sent.append(r) or r for r in collect(self)])
    monkeypatch.setattr(type(df), "toLocalIterator", lambda self, *a: (sent.append(r) or r for r in iterate(self, *a)))
    shards = vantage.fit_shards(df)
    monkeypatch.undo()
    # one point and median a node; the driver needs neither rows nor ids
    assert {dim: s.levels for dim, s in shards.items()} == {16: 5, 3: 3}
    assert sum(len(pickle.dumps(r.asDict())) for r in sent) < 2 * 8 * (31 * 17 + 7 * 4)
    for dim, s in shards.items():
        own = vantage._matrix(df.where(F.col("dim") == dim).orderBy("row").toPandas()["vector"])
        whole = vantage.Shards(own, s.levels)
        assert (s.points == whole.points).all() and (s.medians == whole.medians).all()
        assert (s.route(own) == whole.route(own)).all() and s.least.shape == whole.least.shape == (1 << s.levels, len(s.points))


def test_vectors_are_not_broadcast(spark, monkeypatch):
    joins, join = [], type(spark.range(0)).join

    def noted(self, other, *a, **k):
        out = join(self, other, *a, **k)
        if "q_vectors" in self.columns:
            joins.append(out)
        return out

    monkeypatch.setattr(type(spark.range(0)), "join", noted)
    monkeypatch.setattr(vantage, "SHARD", 64)
    rows = list(enumerate(np.random.default_rng(10).normal(size=(400, 6)).tolist()))
    check(vantage.nearest(frame(spark, rows)).collect(), brute(rows))
    assert len(joins) == 2
    for df in joins:
        df.collect()
        ran = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]  # as adaptive execution has left it
        assert "isFinalPlan=true" in ran and re.findall(r"(\w+Join) (?!Inner,)", ran)[:1] == ["SortMergeJoin"], ran


def test_relaxed_search_keeps_most_neighbours_and_several_dimensions(spark, monkeypatch):
    monkeypatch.setattr(vantage, "SHARD", 128)
    rng = np.random.default_rng(8)
    rows = [(i, v) for i, v in enumerate(clustered(rng, 20, 60, dim=8) + clustered(rng, 5, 60, dim=3) + [[1.0, 2.0]] * 3)]
    want = brute(rows)
    got = by_id(vantage.nearest(frame(spark, rows), factor=2.0).collect(), "query_id")
    hits = sum(len({r.vec_id for r in got[q]} & {j for j, _ in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1, 0]), (1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (7, [3, 4]), (8, [1, 2, 3])]
    df = frame(spark, rows + [(50, [0, 0]), (100, [1, 2, 2])]).withColumn("row", F.lit("x")).withColumn("rank", F.lit(9))
    out = vantage.nearest(df).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in out) == [(0, 1, 7), (100, 1, 8)]
    assert {r.query_id: r.score for r in out}[0] == 0.6


def test_null_ids_repeated_rows_huge_values_and_an_empty_table(spark):
    rows = [(50, [1e30, 2e30]), (50, [1e30, 2e30]), (None, [1, 2]), (7, [1e-30, 2e-30])]
    out = vantage.nearest(frame(spark, rows)).collect()
    # each of the equal rows finds the other, and the third vector; ties by id
    assert sorted((r["rank"], r.vec_id) for r in out) == [(1, 7), (1, 7), (2, 50), (2, 50)]
    assert all(r.score == pytest.approx(1.0) for r in out)
    assert vantage.nearest(frame(spark, [])).count() == 0


def test_larger_factors_visit_fewer_vectors():
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(1024, 3))
    order, bounds = vantage.build(vectors)
    tree = {"rows": order, "ids": order, "vectors": vectors[order], "bounds": bounds}
    queries = {"rows": -1 - np.arange(20), "ids": np.arange(20), "vectors": rng.normal(size=(20, 3))}

    def seen(factor):
        search, n = vantage.Search(tree, queries, 5, factor), [0]
        offer = search.offer

        def counted(active, start, end):
            n[0] += len(active) * (end - start)
            return offer(active, start, end)

        search.offer = counted
        search.run()
        return n[0]

    exact, loose = seen(1.0), seen(3.0)
    assert loose < exact < 20 * 1024
