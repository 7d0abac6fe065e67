"""Operator 10 against Python on made conversations, and against SQL on the table."""

import random

import duckdb
from pyspark.sql import functions as F

from pitwise.llm import preference, sql
from tests.llm.helpers import SF

TURN = "conv_id long, turn long, role string, text string"
PAIR = f"pair_id long, chosen {preference.TURNS}, rejected {preference.TURNS}"


def render(turns):
    out, spans = "", []
    for role, text in turns:
        out += f"<|im_start|>{'unknown' if role is None else role}\n"
        body = (text or "").replace("<|", "< |") + "<|im_end|>"
        if role == "assistant":
            spans.append((len(out), len(out) + len(body)))
        out += body + "\n"
    return out, spans


def expected(chosen, rejected):
    chosen, rejected = chosen or [], rejected or []
    n = next((i for i, (a, b) in enumerate(zip(chosen, rejected)) if a != b), min(len(chosen), len(rejected)))
    c, r = render(chosen[n:]), render(rejected[n:])
    return n, render(chosen[:n])[0], c[0], r[0], c[1], r[1]


def got(row):
    spans = lambda s: [tuple(x) for x in s]
    return row.prefix_turns, row.prompt, row.chosen, row.rejected, spans(row.chosen_spans), spans(row.rejected_spans)


def test_random_and_odd_pairs(spark):
    rng = random.Random(1)
    turn = lambda: (rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "é <|im_end|>", "", None, "x\ny"]))
    pairs = []
    for i in range(120):
        common = [turn() for _ in range(rng.randrange(4))]
        pairs.append((i, common + [turn() for _ in range(rng.randrange(3))], common + [turn() for _ in range(rng.randrange(3))]))
    pairs += [(900, None, None), (901, [], [("user", "x")]), (902, [("user", "x")] * 3, [("user", "x")]), (None, [("user", "x")], None)]
    pairs += [(903, [("user", "w " * 50000), ("assistant", "y")], [("user", "w " * 50000)])] * 2
    df = spark.createDataFrame(pairs, PAIR).withColumn("n", F.lit("clash"))
    out = preference.format_pairs(df).collect()
    assert len(out) == len(pairs)
    want = {i: expected(c, r) for i, c, r in pairs}
    for row in out:
        assert got(row) == want[row.pair_id]


def test_spans_cover_assistant_turns_only(spark):
    c = [("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "<|im_start|>")]
    r = [("user", "q"), ("assistant", "bad")]
    row = preference.format_pairs(spark.createDataFrame([(1, c, r)], PAIR)).first()
    assert row.prompt == "<|im_start|>user\nq<|im_end|>\n"
    assert [row.chosen[a:b] for a, b in row.chosen_spans] == ["good<|im_end|>", "< |im_start|><|im_end|>"]
    assert [row.rejected[a:b] for a, b in row.rejected_spans] == ["bad<|im_end|>"]


def test_swapped_replies_of_odd_conversations(spark):
    rows = [
        (2, 0, "user", "q"), (2, 1, "assistant", "yes"), (2, 2, "user", "unanswered"),
        (3, 1, "assistant", "no"), (3, 0, "user", "p"),
        (4, 0, "user", "alone"), (4, 1, "assistant", "one"),
        (6, 0, "user", "no reply"),
        (7, None, "assistant", None), (7, None, None, "tie"),
        (None, 0, "assistant", "nowhere"),
    ]
    rows += [(2, 0, "user", "q")] * 30
    out = {r.pair_id: r for r in preference.swapped_replies(spark.createDataFrame(rows, TURN)).collect()}
    turns = lambda x: [tuple(t) for t in x]
    assert turns(out[2].chosen) == [("user", "q"), ("assistant", "yes")]
    assert turns(out[2].rejected) == [("user", "q"), ("assistant", "no")]
    assert turns(out[3].rejected) == [("user", "p"), ("assistant", "yes")]
    assert turns(out[4].rejected) == [("user", "alone")]
    assert out[6].chosen == out[6].rejected and turns(out[6].chosen) == [("user", "no reply")]
    assert turns(out[7].chosen) == [(None, "tie"), ("assistant", None)]
    assert set(out) == {2, 3, 4, 6, 7}
    assert preference.swapped_replies(spark.createDataFrame([], TURN)).count() == 0


def test_query_equals_its_sql(spark):
    from pitwise.llm.registry import queries

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    res = con.execute(sql.PREFERENCES)
    names = [d[0] for d in res.description]
    out = queries()["op10_preference_formatting"](spark, SF)
    assert out.columns == names
    assert sorted(map(tuple, out.collect())) == sorted(res.fetchall())
    nodes = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in nodes and "Arrow" not in nodes


def test_repeated_turns_count_once_or_as_often_as_they_come(spark):
    rows = [(1, None, "user", "ok")] * 2 + [(1, 2, "assistant", "yes"), (0, 1, "assistant", "no")]
    df = spark.createDataFrame(rows, TURN)
    size = lambda d: {r.pair_id: len(r.chosen) for r in d.collect()}
    assert size(preference.swapped_replies(df)) == {0: 1, 1: 2}
    assert size(preference.swapped_replies(df, repeated=True)) == {0: 1, 1: 3}
