"""Operator 7: targets by repeated sharing, exact quotas, disjoint shards."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pitwise.llm import mixing
from tests.llm.helpers import SF, docs_frame, words


def shared_out(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share by weight; what exceeds a cap is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    budget = share * sum(sizes.values())
    target, free = {}, set(order)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= most * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


def check(rows, out):
    """``rows`` of (doc_id, text, source)."""
    sizes, smallest = Counter(), {}
    for _, t, s in rows:
        n = len(words(t))
        sizes[s] += n
        smallest[s] = min(smallest.get(s, 10**9), n or 10**9)
    target = shared_out(sizes)
    taken = Counter()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.source, r.size) for r in out) == Counter((i, s, len(words(t))) for i, t, s in rows)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == len(r.shards) * r.size
        taken[r.source] += r.taken
    return taken, target


def test_targets_and_taken_words_of_the_table(spark):
    from pitwise.llm.registry import queries

    sf = SF.replace("0.001", "0.01")
    out = queries()["op7_splitting_tree_mix"](spark, sf).collect()
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    taken, target = check(rows, out)
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s]


def test_hot_source_null_source_null_and_wordless_texts(spark):
    rows = [(i, "w " * (1 + i % 7), "hot") for i in range(900)]
    rows += [(1000 + i, "w " * 3, s) for i, s in enumerate(["a", "b", "é", "Z", None] * 20)]
    rows += [(2000, None, "hot"), (2001, " \n", "void"), (None, "w w", None), (3, "w w w w", "hot")]
    df = docs_frame(spark, rows).withColumn("size", F.lit("x")).withColumn("block", F.lit(0))
    out = mixing.mix(df, block_docs=32, depth=3).collect()
    taken, target = check(rows, out)
    assert target["void"] == 0
    for s in target:
        assert abs(taken[s] - target[s]) <= 7
    again = mixing.mix(df.repartition(5), block_docs=32, depth=3).collect()
    assert Counter(map(str, out)) == Counter(map(str, again))


def test_repeated_rows_are_spread_over_blocks(spark):
    rows = [(1, "w w w", "s")] * 500 + [(i, "w", "t") for i in range(2, 400)]
    taken, target = check(rows, mixing.mix(docs_frame(spark, rows), block_docs=16).collect())
    assert all(abs(taken[s] - target[s]) <= 3 for s in target)


def test_empty_table(spark):
    assert mixing.mix(docs_frame(spark, [])).count() == 0


def test_tree_splits_quotas_exactly_and_runs_are_disjoint(spark):
    quotas = {"a": 1000, "b": 37, "c": 1, None: 200, "z": 0}
    df = spark.createDataFrame(list(quotas.items()), "source string, blocks long")
    runs = mixing.split_tree(df, 4, 3).collect()
    by_source, by_shard = defaultdict(list), Counter()
    for r in runs:
        by_source[r.source].append((r.start, r.start + r.blocks))
        by_shard[r.shard] += r.blocks
    for s, n in quotas.items():
        ends = sorted(by_source[s])
        assert [a for a, _ in ends] == [0, *[b for _, b in ends[:-1]]][: len(ends)]
        assert sum(b - a for a, b in ends) == n
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 16


def test_splits_are_hypergeometric(spark):
    df = spark.createDataFrame([("a", 30), ("b", 70)], "source string, blocks long")
    lefts = [sum(r.blocks for r in mixing.split_tree(df, 1, seed).collect() if (r.shard, r.source) == (0, "a")) for seed in range(40)]
    mean = sum(lefts) / len(lefts)
    var = sum((x - mean) ** 2 for x in lefts) / len(lefts)
    # 50 draws from 30 + 70: mean 15, variance 50 * 0.3 * 0.7 * 50 / 99 = 5.3
    assert abs(mean - 15) < 1.5 and 2 < var < 11


def test_draws_have_the_hypergeometric_distribution(spark):
    from math import comb

    long = lambda x: F.lit(x).cast("long")
    steps = 20_000
    u = spark.range(steps).select(((F.col("id") + 0.5) / steps).alias("u"))
    for total, good, draws in ((60, 25, 20), (7, 3, 7), (9, 0, 4), (9, 9, 4), (9, 4, 0), (1, 1, 1), (50, 49, 25), (40, 3, 39)):
        n = Counter(r[0] for r in u.select(mixing.hypergeometric(F.col("u"), long(total), long(good), long(draws))).collect())
        for x in range(min(good, draws) + 1):
            chance = comb(good, x) * comb(total - good, draws - x) / comb(total, draws) if draws - x <= total - good else 0
            assert abs(n[x] / steps - chance) < 2 / steps, (total, good, draws, x)


def test_ten_million_blocks_and_more_sources_than_a_row_holds(spark):
    df = spark.createDataFrame([("a", 6_000_000), ("b", 3_999_999), ("c", 1)], "source string, blocks long")
    runs = mixing.split_tree(df, 3, 1).collect()
    shards = Counter()
    for r in runs:
        shards[r.shard] += r.blocks
        if r.source == "a":  # 750,000 each, standard deviation of about 510
            assert abs(r.blocks - 750_000) < 6 * 510
    assert sum(shards.values()) == 10_000_000 and set(shards.values()) == {1_250_000}

    quotas = {f"s{i}": 1 + i % 5 for i in range(300)}
    df = spark.createDataFrame(list(quotas.items()), "source string, blocks long")
    runs = mixing.split_tree(df, 2, 1, bits=3).collect()
    ends, shards = defaultdict(list), Counter()
    for r in runs:
        ends[r.source].append((r.start, r.start + r.blocks))
        shards[r.shard] += r.blocks
    for s, n in quotas.items():
        own = sorted(ends[s])
        assert own[0][0] == 0 and own[-1][1] == n and all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))
    assert max(shards.values()) - min(shards.values()) <= 1
    assert spark.createDataFrame([], "source string, blocks long").transform(lambda d: mixing.split_tree(d, 2, 1)).count() == 0


def test_a_very_long_text(spark):
    rows = [(1, "w " * 300_000, "s"), (2, "w", "s"), (3, "w" * 500_000, "t"), (4, " " * 500_000, "t")]
    out = {r.doc_id: r for r in mixing.mix(docs_frame(spark, rows)).collect()}
    assert [out[i].size for i in range(1, 5)] == [300_000, 1, 1, 0]


def test_documents_come_as_often_as_taken(spark):
    rows = [(i, "w " * (3 + i % 5), "ab"[i % 2]) for i in range(200)] + [(5, "w w w x x x x x", "b")] * 2
    df = docs_frame(spark, rows).withColumn("shard", F.lit("x"))
    out = mixing.mixed_documents(df, block_docs=16)
    want = sum(len(r.shards) for r in mixing.mix(df, block_docs=16).collect())
    assert out.count() == want and set(out.columns) == set(df.columns) | {"place"}
    assert out.select("shard", "place").distinct().count() == want
