"""Operator 12 against all inner products."""

from collections import Counter
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwise.llm import four_russians
from tests.llm.helpers import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], c) for i, v, c in rows], SCHEMA)


def brute(rows, every=100, positives=5, negatives=10):
    ok = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    used = [(i, [floor(256 * float(np.float32(x))) for x in v], c) for i, v, c in rows if i is not None and c is not None and ok(v)]
    out = Counter()
    for a, (i, v, c) in enumerate(used):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), j, d) for b, (j, w, d) in enumerate(used) if b != a and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == c)[:positives]:
            near = sorted(x for x in scored if x[2] != c and 30 * -s <= 100 * -x[0] <= 90 * -s)
            out.update((i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(near[:negatives], 1))
    return out


def got(df):
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def moved(i, c):
    return c if c is None or i is None or i % 7 else (c + 1) % 10


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_the_table(spark, sf):
    from pitwise.llm.registry import queries

    sf = SF.replace("0.001", sf)
    rows = [(r.vec_id, list(r.embedding), moved(r.vec_id, r.label)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows)
    assert got(queries()["op12_four_russians"](spark, sf)) == want and len(want) > 50


def test_many_blocks_shards_and_ties(spark, monkeypatch):
    monkeypatch.setattr(four_russians, "CANDIDATES", 600)
    monkeypatch.setattr(four_russians, "ANCHORS", 40)
    monkeypatch.setattr(four_russians, "STRIP", 7)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-3, 8, 11) / 4).tolist(), int(rng.integers(0, 4))) for i in range(700)]
    rows += [(700 + i, rows[100][1], 1) for i in range(80)] + [(1000 + i, [0.25] * 11, 2) for i in range(200)]
    assert got(four_russians.hard_negatives(frame(spark, rows).repartition(5))) == brute(rows)


def test_rows_that_take_no_part_other_dimensions_and_clashing_columns(spark):
    rows = [(0, [1, 0.5], 1), (1, [1, 0.5], 1), (2, [0.5, 0.25], 2), (3, [0.5, None], 2), (4, None, 2), (5, [float("nan"), 1], 2)]
    rows += [(6, [float("inf"), 1], 2), (7, [0.5, 0.25], None), (None, [0.5, 0.25], 2), (8, [0.5, 0.25, 0], 2), (100, [], 1), (101, [], 1), (102, [], 2)]
    rows += [(200, [2.0] * 9, 5), (201, [1.0] * 9, 5)]  # no row of another label
    rows += [(300, [-1.0, 0.0, 0.0], 6), (301, [1.0, 0.0, 0.0], 6), (302, [0.5, 0, 0], 7)]  # a negative positive
    df = frame(spark, rows).withColumns({c: F.lit("x") for c in ("row", "dim", "rank", "score", "id", "vector", "a_row", "shard", "p")})
    out = got(four_russians.hard_negatives(df))
    assert out == brute(rows) and {x[:4] for x in out} == {(0, 1, 1, 2), (100, 101, 1, 102)}


def test_repeated_rows_and_an_empty_table(spark):
    rows = [(0, [1, 1], 1)] * 3 + [(50, [0.5, 0.5], 2)] * 12 + [(7, [1, 0.5], 1)]
    assert got(four_russians.hard_negatives(frame(spark, rows))) == brute(rows)
    assert four_russians.hard_negatives(frame(spark, [])).count() == 0
    assert four_russians.hard_negatives(frame(spark, [(1, [1.0], 1)])).count() == 0


def test_large_and_huge_components(spark):
    rng = np.random.default_rng(5)
    rows = [(50 * i, (rng.normal(size=5) * 10.0 ** int(rng.integers(0, 6))).tolist(), i % 3) for i in range(90)]
    assert got(four_russians.hard_negatives(frame(spark, rows))) == brute(rows)
    # beyond a long: defined by saturation and wrap-around, without an error
    huge = [(0, [1e38, 1.0], 1), (1, [-1e38, 2.0], 1), (2, [3e38, 1.0], 2), (3, [1.0, 1.0], 2)]
    assert four_russians.hard_negatives(frame(spark, huge)).count() >= 0


def test_scores_equal_inner_products():
    rng = np.random.default_rng(1)
    for dim, top in ((1, 3), (8, 1), (19, 200), (64, 1 << 40)):
        a, b = rng.integers(-top, top + 1, (4, dim)), rng.integers(-top, top + 1, (33, dim))
        b[0] = 0
        count, planes = four_russians.bit_planes(b)
        tables = four_russians.subset_sums(a, four_russians.number_type(a, count))
        with np.errstate(over="ignore"):
            assert (four_russians.scores(tables, planes) == (b @ a.T)).all()
    low, high = four_russians.limits(np.array([10, 11, -10, 0, 999, 7]))
    assert low.tolist() == [3, 4, -3, 0, 300, 3] and high.tolist() == [9, 9, -9, 0, 899, 6]
