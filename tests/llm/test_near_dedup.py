"""Operator 3 against comparing all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from pitwise.llm import near_dedup
from tests.llm.helpers import SF, docs_frame, linked_components, shingles


def found(df, k):
    return {r.doc_id: r for r in near_dedup.near_duplicates(df, k=k).collect()}


def check(rows, out, k):
    want = linked_components([r for r in rows if r[0] is not None], k)
    for i, t in rows:
        assert out[i].n_shingles == len(shingles(t, k)), i
        assert out[i].component_id == want[i], i
        assert out[i].kept == (want[i] == i)


def variants(rng, base, n, edits):
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield " ".join(w)


def test_components_of_the_table(spark):
    from pitwise.llm.registry import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, {r.doc_id: r for r in queries()["op3_min_max_hash"](spark, SF).collect()}, 4)


def test_large_groups_of_near_copies_with_links_around_the_threshold(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 90))) for _ in range(40)]
    for edits in (4, 9, 14):
        base = [f"b{rng.randrange(10**6)}" for _ in range(120)]
        texts += variants(rng, base, 70, edits)
        texts += [" ".join(base)] * 15
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    check(rows, found(docs_frame(spark, rows), 4), 4)


def test_chains_are_followed(spark):
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 130])) for i in range(30)]
    out = found(docs_frame(spark, rows), 5)
    assert {r.component_id for r in out.values()} == {0}


def test_null_empty_short_repeated_and_null_id_rows(spark):
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "One  TWO"), (10, "one"), (11, "é É"), (12, "É é")]
    out = found(docs_frame(spark, rows), 4)
    check(rows, out, 4)
    assert out[5].n_shingles == 0 and out[9].component_id == 8
    df = docs_frame(spark, [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, "q r s")])
    got = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_dedup.near_duplicates(df, k=4).collect())
    assert got == [(-1, -1, False), (-1, 3, False), (3, 3, True), (3, 3, True)]
    assert near_dedup.near_duplicates(docs_frame(spark, []), k=4).count() == 0


def test_one_row_of_each_group_stays_with_its_columns(spark):
    text = " ".join(map(str, range(40)))
    df = docs_frame(spark, [(4, text), (2, text), (2, text), (9, text + " x"), (1, None), (None, text), (7, "other words here now then")])
    df = df.withColumn("key", F.lit("k")).withColumn("label", F.lit(1))
    out = near_dedup.deduplicated(df, k=5)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 7]


def test_one_permutation_gives_two_unbiased_agreements():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 200, 200))
    agree = []
    for _ in range(40):
        shared, a, b = (near_dedup._mix(x) for x in (shared, a, b))
        s = near_dedup.signatures([np.concatenate([shared, a]), np.concatenate([shared, b])])
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 0.6) < 0.02
    assert s.shape[1] == 2 * near_dedup.PERMUTATIONS


def test_very_long_texts(spark):
    words = [f"w{i}" for i in range(250_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-50])), (3, "a " * 400_000), (4, "a " * 300_000), (5, "x" * 1_000_000)]
    got = {i: (r.n_shingles, r.component_id) for i, r in found(docs_frame(spark, rows), 5).items()}
    assert got == {1: (249_996, 1), 2: (249_946, 1), 3: (1, 3), 4: (1, 3), 5: (1, 5)}
