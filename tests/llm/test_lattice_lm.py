"""Operator 6: base scores and lattice sums against enumeration."""

import math
import zlib
from collections import Counter

from pitwise.llm import lattice_lm
from pitwise.llm.common import tokenizer_path
from tests.llm.helpers import SF, by_id, docs_frame, lower, words

PATH = tokenizer_path("piece_bpe_32k.model")


def check(rows, out):
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    c = Counter(w for t in train for w in [*words(lower(t)), " end"])
    n, v = sum(c.values()), len(c)
    got = by_id(out)
    assert len(out) == len(rows)
    for i, t in rows:
        tokens = [*words(lower(t)), " end"]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        for r in got[i]:
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(c[w] > 0 for w in tokens), n)
            assert r.held_out == (zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1)
            assert math.isclose(r.base_score, base, rel_tol=1e-9)
            assert r.score < 0


def test_scores_of_the_table(spark):
    from pitwise.llm.registry import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries()["op6_subword_lattice"](spark, SF).collect()
    check(rows, out)
    # held-out text of the corpus is likelier, by character, than scrambled text
    held = [(r.doc_id, r.score) for r in out if r.held_out]
    texts = dict(rows)
    scrambled = docs_frame(spark, [(r[0], r[1]) for r in rows if r[0] not in dict(held)] + [(i, texts[i][::-1]) for i, _ in held])
    worse = {r.doc_id: r.score for r in lattice_lm.score_documents(scrambled, PATH).collect()}
    assert sum(s > worse[i] for i, s in held) >= 0.9 * len(held)


def test_odd_texts_repeated_rows_and_null_ids(spark):
    rows = [(0, None), (1, ""), (2, "A a b"), (2, "A a b"), (3, "東京 \U0001f600x"), (None, "b"), (4, "x" * 3000), (5, " \n a\x0bB")]
    check([r for r in rows], lattice_lm.score_documents(docs_frame(spark, rows), PATH).collect())
    assert lattice_lm.score_documents(docs_frame(spark, []), PATH).count() == 0


def test_words_beyond_the_common_ones_are_joined(spark, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    whole = {r.doc_id: r.score for r in lattice_lm.score_documents(docs_frame(spark, rows), PATH).collect()}
    monkeypatch.setattr(lattice_lm, "COMMON", 3)
    out = lattice_lm.score_documents(docs_frame(spark, rows), PATH).collect()
    check(rows, out)
    assert all(math.isclose(r.score, whole[r.doc_id], rel_tol=1e-9) for r in out)


def segmentations(s, pieces):
    if not s:
        yield 0.0
    for n in range(1, len(s) + 1):
        if s[:n] in pieces:
            for rest in segmentations(s[n:], pieces):
                yield pieces[s[:n]] + rest


def test_recursion_is_the_sum_over_all_segmentations():
    plain, bytes_ = lattice_lm.pieces_of(PATH)
    lattice = lattice_lm.Lattice(PATH, {i: 7 * i % 91 for i in plain.values()}, 5)
    for word in ("the", "tion", "houses", "a", "über", "12,"):
        want = math.log(sum(math.exp(x) for x in segmentations(lattice_lm.MARK + word, lattice.score)))
        assert math.isclose(lattice.word(word), want, rel_tol=1e-12)
    strange = "\U0001f9ff"
    spelled = sum(lattice.byte[b] for b in strange.encode())
    assert math.isclose(lattice.word(strange), lattice.score[lattice_lm.MARK] + spelled, rel_tol=1e-12)


def test_piece_scores_sum_to_one():
    plain, bytes_ = lattice_lm.pieces_of(PATH)
    lattice = lattice_lm.Lattice(PATH, {i: i % 5 for i in [*plain.values(), *bytes_]}, 9)
    total = sum(math.exp(x) for x in [*lattice.score.values(), *lattice.byte, lattice.end])
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_words_with_the_mark_clashing_columns_and_long_texts(spark):
    from pyspark.sql import functions as F

    mark = lattice_lm.MARK
    rows = [(i, f"the {mark} a{mark}b {mark}{mark} house") for i in range(6)] + [(10, "the " * 100_000 + "x" * 3_000), (11, mark)]
    df = docs_frame(spark, rows).withColumns({c: F.lit("x") for c in ("word", "n", "train", "base", "log10", "row", "known")})
    out = lattice_lm.score_documents(df, PATH).collect()
    check(rows, out)
    plain, _ = lattice_lm.pieces_of(PATH)
    lattice = lattice_lm.Lattice(PATH, {i: 7 * i % 91 for i in plain.values()}, 5)
    for word in (f"a{mark}the", mark):
        spelled = math.log(sum(math.exp(x) for x in segmentations(mark + word, lattice.score)))
        assert math.isclose(lattice.word(word), spelled, rel_tol=1e-12)
