"""Operator 5: counts against Python, the learned list on held-out labels."""

import random
import re

import pytest
from pyspark.sql import functions as F

from pitwise.llm import quality
from tests.llm.helpers import SF, by_id, docs_frame, repeat_words, words

TEXTS = [
    None,
    "",
    " \n\t ",
    "a b c a b c a b",
    "x\n\nx\n x\n\t\nx",
    "a a a a",
    "# $% <b> | é&É 12 !!",
    "one two three",
    " lead and trail \x0b",
    "ab cd ef gh " * 3000,
    "u " * 49 + "v",
    " nbsp is no separator",
]


def counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeat_words(w)


def check(rows, out):
    got = by_id(out)
    for i, t in rows:
        want = counts(t)
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.kept and r.base_failed)


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_counts_of_odd_texts_without_labels(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "null id")]
    df = docs_frame(spark, rows).withColumn("n_words", F.lit("x")).withColumn("keep", F.lit(1)).withColumn("words", F.lit(2))
    out = quality.judge(df, no_labels(spark)).collect()
    assert len(out) == len(rows)
    check(rows, out)
    assert all(r.kept == (not r.base_failed) for r in out)
    assert quality.judge(docs_frame(spark, []), no_labels(spark)).count() == 0


def test_counts_of_the_table_and_labels(spark):
    from pitwise.llm.registry import queries

    sf = SF.replace("0.001", "0.01")
    out = queries()["op5_decision_list"](spark, sf).collect()
    check([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], out)
    kept = {r.doc_id: r.kept for r in out}
    marks = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [kept[m.doc_id] for m in marks if m.quality == 1]
    bad = [kept[m.doc_id] for m in marks if m.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)


@pytest.fixture(scope="module")
def made(spark):
    """Rows whose label is a list of two rules, with a little noise."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        f = {name: rng.random() for name in quality.FEATURES}
        bad = f["symbols_per_word"] > 0.8 or (f["upper_share"] > 0.6 and f["mean_word_chars"] <= 0.5)
        rows.append((i, *f.values(), bad != (rng.random() < 0.01)))
    schema = "doc_id long, " + ", ".join(f"{n} double" for n in quality.FEATURES) + ", reject boolean"
    return spark.createDataFrame(rows, schema)


def test_learned_list_finds_the_rules_behind_the_labels(made):
    train, held = made.where("doc_id % 2 = 0"), made.where("doc_id % 2 = 1")
    rules = quality.learn_rules(train, least_precision=0.9)
    terms = {t.feature for r in rules for t in r}
    assert {"symbols_per_word", "upper_share", "mean_word_chars"} <= terms
    right = held.withColumn("rule", quality.first_rule(rules)).where("reject = (rule is not null)").count()
    assert right >= 0.95 * held.count()


def test_rules_are_ordered_conditions(spark):
    a = (quality.Term("n_words", True, 3.0),)
    b = (quality.Term("n_words", True, 9.0), quality.Term("upper_share", False, 0.5))
    df = spark.createDataFrame([(2.0, 1.0), (5.0, 1.0), (5.0, 0.1), (50.0, 1.0)], "n_words double, upper_share double")
    assert [r[0] for r in df.select(quality.first_rule([a, b])).collect()] == [1, 2, None, None]
    assert str(b[1]) == "upper_share > 0.5"


def test_one_class_null_labels_and_repeated_labels(spark):
    docs = docs_frame(spark, [(i, " ".join(f"w{j}" for j in range(60 + i))) for i in range(30)])
    one = spark.createDataFrame([(i, 1, 0) for i in range(30)] * 2 + [(3, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(r.kept for r in quality.judge(docs, one).collect())


def test_filter_keeps_columns_and_agrees_with_the_verdicts(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    out = quality.filtered(docs, labels)
    assert out.columns == docs.columns
    assert sorted(out.exceptAll(docs).collect()) == [] and {r.doc_id for r in out.collect()} == kept
