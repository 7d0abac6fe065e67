"""What is shuffled and sorted where a step meets a large table."""

import math
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.functions import codes, joins
from pitwise.llm import lattice_lm
from pitwise.llm.common import tokenizer_path
from pitwise.operators import history, reports
from pitwise.plans.registry import fixture_job
from pitwise.sources import fixture
from tests.conftest import frame

T = datetime(1998, 5, 1, 12)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def flat_inputs(spark, docs=("d1", "d2")):
    """Documents of one time and person, each with the same three enquiries, one of them twice."""
    main = frame(spark, "id string, report_code string, create_time timestamp", [(d, "r", T) for d in docs])
    pqo = frame(spark, "id string, doc_id string", [("q" + d, d) for d in docs])
    pc05 = frame(spark, "id string, pqo_id string", [("c" + d, "q" + d) for d in docs])
    pc05a = frame(spark, "pqo_pc05_id string, pc05ar01 string, pc05aq01 string, pc05ad01 string, pc05ai01 string", [])
    pc05b = frame(spark, "pqo_pc05_id string, " + ", ".join(f"pc05bs0{i} long" for i in range(1, 7)), [])
    poq = frame(spark, "id string, doc_id string", [("p" + d, d) for d in docs])
    ph01 = [("p" + d, T, "t", f"org{i}", "2") for d in docs for i in (0, 1, 2, 2)]
    ph01 = frame(spark, "poq_id string, ph010r01 timestamp, ph010d01 string, ph010q02 string, ph010q03 string", ph01)
    identity = frame(spark, "doc_id string, " + ", ".join(f"{c} string" for c in reports.IDENTITY_COLUMNS), [(d, "n", "10", "x", "o", "01") for d in docs])
    return main, pqo, pc05, pc05a, pc05b, poq, ph01, identity


def test_flattened_rows_of_a_document_are_shuffled_together(spark):
    out = op.report_flatten(*flat_inputs(spark))
    dealt = [line for line in plan(out).split("\n") if "Exchange hashpartitioning(create_time" in line]
    # The final distinct needs no shuffle of its own.
    assert len(dealt) == 1 and " query_date#" not in dealt[0] and " id_card_num#" in dealt[0]
    want = sorted((r.query_org, r.id_card_num) for r in out.collect())
    assert want == [(f"org{i}", "x") for i in range(3)]


def test_equal_rows_of_a_heavy_and_another_document_are_one(spark):
    for heavy in (({}, {}), ({"pd1": 3}, {"d1": 3}), ({}, {"d1": 2, "d2": 5})):
        assert sorted(r.query_org for r in op.report_flatten(*flat_inputs(spark), heavy=heavy).collect()) == ["org0", "org1", "org2"]


def test_enquiries_of_a_latest_report_are_not_sorted(spark):
    latest = frame(spark, "cust_ids string, cert_no string, report_sn string, report_create_time timestamp", [("a", "a", "s", T)])
    queries = frame(spark, "report_id string, querydate timestamp, queryreason string", [("s", T, codes.REASON_LOAN)] * 2 + [("u", T, codes.REASON_LOAN)])
    summary = frame(spark, "report_id string, lastmonthquery_selfquery long, last2yearquery_loanmanage long", [("s", 1, 2)])
    out = op.query_counts_gen1(latest, queries, summary)
    assert plan(out).count("ShuffledHashJoin") >= 2
    assert [r.query_loan_cnt_3m_1 for r in out.collect()] == [2.0]


def test_repayments_are_made_distinct_after_the_join(spark):
    cohort = frame(spark, "cust_ids string, time_censor timestamp", [("a", T)])
    loans = frame(spark, "loan_no string, cust_ids string, loan_time timestamp", [("l", "a", datetime(1998, 1, 1))] * 2 + [("m", "b", datetime(1998, 1, 1))])
    paid = datetime(1998, 2, 1)
    rows = [("l", 5, codes.REPAY_OK, paid)] * 3 + [("l", 7, codes.REPAY_FAIL, paid), ("m", 9, codes.REPAY_OK, paid), ("l", 1, codes.REPAY_OK, T)]
    repayments = frame(spark, "loan_no string, principal decimal(18,2), status string, apply_time timestamp", [(a, Decimal(b), c, d) for a, b, c, d in rows])
    out = op.repay_outcome_rates(cohort, loans, repayments)
    above, below = plan(out).split("ShuffledHashJoin", 1)
    assert "apply_time" in above and not any("Aggregate" in line and "apply_time" in line for line in below.split("\n")[1:])
    assert [(r.suc_cnt, r.fail_cnt, r.p_sum) for r in out.collect()] == [(1.0, 1.0, 5.0)]


def test_first_events_of_days_are_shuffled_once(spark):
    kept = {name: spark.createDataFrame([], schema) for name, schema in history.KEPT.items()}
    loans = frame(spark, "cust_ids string, loan_no string, loan_time timestamp, partner_no string, product_no string, quota_type string", [("a", "l", T, "1", "2", "3")])
    overdue = frame(spark, "loan_no string, stat_date date", [("l", date(1998, 6, 2)), ("l", date(1998, 6, 1)), (None, date(1998, 6, 1))])
    repayments = frame(spark, "loan_no string, status string, apply_time timestamp", [("l", codes.REPAY_OK, T), ("m", codes.REPAY_OK, T), ("l", codes.REPAY_FAIL, datetime(1998, 1, 1))])
    firsts = history.added(kept, history.Days(loans, overdue, repayments), F.lit(date(1970, 1, 1)))["firsts"]
    assert plan(firsts).count("Exchange ") == 1
    got = sorted((r.loan_no, r.od_day, r.pt and r.pt.hour) for r in firsts.collect())
    assert got == [("l", date(1998, 6, 1), 12), ("m", None, 12)]


def test_pieces_of_a_word_are_followed_by_their_beginnings(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    plain, _ = lattice_lm.pieces_of(path)
    lattice = lattice_lm.Lattice(path, {i: i % 50 for i in plain.values()}, 3)

    def every_cut(s):
        if not s:
            return 1.0
        total = sum(math.exp(lattice.score[s[:k]]) * every_cut(s[k:]) for k in range(1, len(s) + 1) if s[:k] in lattice.score)
        if s[0] not in lattice.score:
            total += math.exp(sum(lattice.byte[b] for b in s[0].encode())) * every_cut(s[1:])
        return total

    looked = []

    class Steps(dict):
        def get(self, key, *default):
            looked.append(key)
            return dict.get(self, key, *default)

    lattice.steps = Steps(lattice.steps)
    for word in ("", "thing", "\u2581a", "a\u65e5b", "\U0001f600q\x00", "unknown"):
        assert math.isclose(lattice.word(word), math.log(every_cut(lattice_lm.MARK + word)), rel_tol=1e-9)
    looked.clear()
    lattice.word("q" * 200)
    assert len(looked) < 200 * 6  # not the longest piece from every character


def test_a_sieve_loses_no_row_that_has_a_key(spark, monkeypatch):
    few = frame(spark, "s string, n long", [("a", 1), ("b", 2), ("b", 3), (None, 4), ("", 5)])
    keys = ["a", "b", "b", "", None, *(f"x{i}" for i in range(500))]
    rows = frame(spark, "k string, v long, n long", [(k, i, i) for i, k in enumerate(keys)])
    for places in (64, 1 << 12, 1 << 25):
        monkeypatch.setattr(joins, "SIEVE_PLACES", places)
        left = joins.sieved(rows, "k", few, "s")
        assert left.columns == rows.columns
        got = sorted((r.v, r.k) for r in left.collect() if r.k in ("a", "b", ""))
        assert got == [(0, "a"), (1, "b"), (2, "b"), (3, "")]
    assert left.count() < 10
    assert joins.sieved(rows, "k", few.where("false"), "s").count() == 0
    assert joins.sieved(rows, "v", few, "n") is rows  # keys of other types, which a join might convert


def test_children_of_a_latest_report_are_sieved_before_they_are_shuffled(spark):
    job = fixture_job(spark, "/root/testdata/sf0.001", materialize=True)
    plain = fixture_job(spark, "/root/testdata/sf0.001")
    lines = plain.inputs["report_queries"].count()
    latest = job.latest_report.count()
    assert [df.count() < lines / 5 for df in (*job.gen1_children, *job.normalised_children)] == [True] * 4
    assert 0 < latest <= job.gen1_children[0].select("report_id").distinct().count() < 2 * latest
    assert "latest_report_queries" in plan(job.gen1_counts) and "report_loans" in plan(job.settlement)
    for name in ("gen1_counts", "gen2_counts", "settlement", "card_gap", "repaid", "xfd", "repay_outcomes", "od_strict", "od_any", "last_loan"):
        got, want = (sorted(map(repr, getattr(j, name).collect())) for j in (job, plain))
        assert got == want and got, name
    job.cleanup()


def test_the_cohorts_loans_and_overdue_records_are_read_once(spark):
    job = fixture_job(spark, "/root/testdata/sf0.001", materialize=True)
    for name in ("cohort_outcomes", "repaid", "xfd", "repay_outcomes", "od_strict", "od_any", "last_loan"):
        getattr(job, name)
    for name in ("repaid", "xfd", "od_strict", "od_any", "last_loan", "repay_outcomes"):
        assert "orders.parquet" not in plan(getattr(job, name)), name
    assert "lineitem.parquet" not in plan(job.od_strict) + plan(job.od_any)
    job.cleanup()


def test_an_id_is_the_same_as_a_number_and_in_parts(spark):
    keys = [0, 5, 96, 97, 1949, 14999, 99_999_999, 100_000_000, 123_456_789_012, -5, None]
    df = frame(spark, "k long", [(k,) for k in keys]).selectExpr("k", f"{fixture._id18('k')} AS parts", f"{fixture._id18_spark('k')} AS number")
    got = df.collect()
    assert [r.number for r in got] == [r.parts for r in got]
    assert got[1].number == "110005195500000005" and got[-1].number is None
