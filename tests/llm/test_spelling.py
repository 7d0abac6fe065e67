"""Operator 11 against comparing all pairs of words."""

import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitwise.llm import spelling
from tests.llm.helpers import SF, docs_frame, lower

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, rate):
    n = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if rate and h % rate == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    """word -> (form, root, n, n_near, form_n)."""
    neighbours = {w: [] for w in n}
    less = {}
    for w in n:  # words one edit apart share what is left without one letter, or are it
        for k in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            less.setdefault(k, []).append(w)
    for a, b in {tuple(sorted(p)) for group in less.values() for p in combinations(group, 2)}:
        if near(a, b):
            neighbours[a].append(b)
            neighbours[b].append(a)
    form = {}
    for w, others in neighbours.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(neighbours[w]), n[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_the_table(spark):
    from pitwise.llm.registry import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(counted(rows, 97))
    assert got(queries()["op11_pivotal_grams"](spark, SF)) == want
    assert sum(v[0] is not None for v in want.values()) > 50


def test_every_edit_of_a_word_is_found(spark):
    word = "bananaéss"
    letters = "abnsxzéß"
    other = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    other |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters} | {word[:i] + word[i + 1 :] for i in range(len(word))}
    rows = [(1, " ".join(sorted(other - {word}) * 3)), (2, f"{word} " * 9)]
    out = got(spelling.spelling_variants(docs_frame(spark, rows)))
    assert out == brute(counted(rows, 0)) and all(out[w][0] == word for w in other - {word})


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text("abàÿ", min_size=5, max_size=8), min_size=2, max_size=60, unique=True))
def test_random_words_over_few_letters(spark, words):
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    pairs = [tuple(sorted((r.word, r.other))) for r in spelling.near_words(df).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {tuple(sorted(p)) for p in combinations(words, 2) if near(*p)}


def test_pivots_are_the_cheapest_disjoint_pair():
    import random

    rng = random.Random(4)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randint(3, 8)))
        weights = [rng.randint(1, 9) for _ in places]
        a, b = spelling.pivots(places, weights)
        cost = dict(zip(places, weights, strict=True))
        assert b - a >= 2 and cost[a] + cost[b] == min(cost[x] + cost[y] for x, y in combinations(places, 2) if y - x >= 2)


def test_chains_ties_case_and_runs(spark):
    rows = [
        (1, "abcde " * 3 + "abcdef " * 6 + "abcdefg " * 12 + "Abcdefgh " * 24 + "abcdefghi " * 48 + "ABCDEFGHIJ " * 96),
        (2, "zzzzz " * 4 + "zzzzy " * 9 + "zzzzx " * 9 + "zzzz " * 50),
        (3, "toooÉx-toooÉx toooÉx_toooéx toooéx toooéx d7×x÷yz Āabcdx " * 3),
    ]
    out = got(spelling.spelling_variants(docs_frame(spark, rows)))
    assert out == brute(counted(rows, 0))
    assert out["abcde"][1] == "abcdefghij" and out["zzzzz"][0] == "zzzzx"


def test_nulls_empty_texts_repeated_rows_long_texts_and_clashing_columns(spark):
    rows = [(None, "wordle wordle"), (1, None), (2, ""), (3, " .\n"), (4, "wordle"), (4, "wordle")] + [(5, "wordles " * 200_000 + "x" * 100_000)]
    rows += [(i, "".join(chr(97 + (i * k) % 26) for k in range(1, 9)) + " abcdefgh") for i in range(500)]
    df = docs_frame(spark, rows).withColumns({c: F.lit("x") for c in ("word", "n", "id", "key", "form", "root", "gram")})
    for rate in (0, 2, 97):
        assert got(spelling.spelling_variants(df, rate=rate)) == brute(counted(rows, rate))


def test_no_words(spark):
    for rows in ([], [(1, "a b c")], [(1, "alone alone alone")]):
        assert got(spelling.spelling_variants(docs_frame(spark, rows))) == brute(counted(rows, 0))
    with pytest.raises(ValueError, match="five"):
        spelling.spelling_variants(docs_frame(spark, []), min_chars=4)


def test_counts_do_not_depend_on_how_often_workers_hand_over(spark, monkeypatch):
    rows = [(i, f"alpha{'b' * (i % 9)} gamma delta epsilon" * 2) for i in range(200)]
    want = brute(counted(rows, 5))
    run = spelling._count(5, 5)
    monkeypatch.setattr(spelling, "HELD", 3)
    total = Counter()
    import pandas as pd

    for pdf in run(iter([pd.DataFrame(rows, columns=["id", "text"])])):
        for w, n in zip(pdf["word"], pdf["n"], strict=True):
            total[w] += n
    assert {w: n for w, n in total.items() if n >= 3} == {w: v[2] for w, v in want.items()}
