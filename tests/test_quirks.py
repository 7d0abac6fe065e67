"""Hand-made rows, one case per semantic rule the features must keep."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.functions.time import parse_instant_text
from tests.conftest import frame

COHORT = "cust_ids string, time_censor timestamp"
LOANS = (
    "loan_no string, cust_ids string, loan_time timestamp, loan_amount decimal(18,2), loan_term double, "
    "loan_rate double, partner_no string, product_no string, quota_type string"
)
OVERDUE = "loan_no string, start_date timestamp, stat_date date, overdue_days double"
REPAY = (
    "loan_no string, principal decimal(18,2), interest decimal(18,2), status string, apply_time timestamp, "
    "debit_time timestamp"
)
EVENTS = "cust_ids string, acct_no string, time_censor timestamp, pay_time timestamp, event_code string, device_id string"
CENSOR = datetime(2021, 1, 1)


def by_key(rows, key="cust_ids"):
    return {r[key]: r for r in rows}


# --- time parsing (dotted dates, fractions) ---------------------------------


def test_times_parse_once_with_fraction_and_dots(spark):
    df = frame(
        spark,
        "s string",
        [
            ("2020.05.01 10:00:00.5",),
            ("2020-05-01 10:00:00.0",),
            ("2020.05.01 10:00:00.123",),
            ("2020-05-01 10:00:00.000",),
            ("2020.05.01 10:00:00",),
            ("2020-05-01",),
            ("2020.5.1",),
            ("not a time",),
        ],
    )
    got = [r.t for r in df.select(parse_instant_text(F.col("s")).alias("t")).collect()]
    assert got == [
        datetime(2020, 5, 1, 10, 0, 0, 500000),
        datetime(2020, 5, 1, 10),
        datetime(2020, 5, 1, 10, 0, 0, 123000),
        datetime(2020, 5, 1, 10),
        datetime(2020, 5, 1, 10),
        datetime(2020, 5, 1),
        datetime(2020, 5, 1),
        None,
    ]


def test_dotted_sorts_by_time_not_text(spark):
    df = frame(spark, "a string, b string", [("2020.05.01", "2020-06-01")])
    r = df.select((parse_instant_text(F.col("a")) < parse_instant_text(F.col("b"))).alias("lt")).first()
    assert r.lt is True


# --- D4/D6: an order with two payment lines -----------------------------------


def test_two_payment_lines_count_amount_twice_order_once(spark):
    accounts = frame(spark, "cust_ids string, time_censor timestamp, acct_no string", [("c1", CENSOR, "a" * 19)])
    orders = frame(
        spark,
        "buyer_user_no string, merchant_order_id string, amount decimal(18,2), pay_time timestamp, pay_order_id string",
        [("a" * 19, "o1", Decimal("1000.00"), datetime(2020, 6, 1), "p1")],
    )
    lines = frame(
        spark,
        "merchant_order_id string, pay_channel_name string, pay_type string",
        [("o1", "任性贷-x", "CREDIT_PAY"), ("o1", "bank", "DEBIT")],
    )
    pay = op.order_payments_asof(accounts, orders, lines)
    assert pay.count() == 2
    s = op.spend_summary(pay).first()
    assert s.merchant_order_cnt == 1
    assert s.merchant_order_amt_avg == 10.0
    assert s.merchant_order_credit_pay_amt_avg == 5.0
    assert s.rxd_pay_amt_ratio == 10.0 / (20.0 + 0.1)


# --- D8: device bursts ----------------------------------------------------------


def _burst(spark, rows):
    df = frame(spark, EVENTS, [(c, "acc", CENSOR, t, "E", d) for c, t, d in rows])
    return {r.cust_ids: r["7days_device_cnt_more_than4"] for r in op.device_burst_7d(df).collect()}


def test_device_burst_boundaries(spark):
    t0 = datetime(2020, 3, 1, 12)
    week = timedelta(days=7)
    us = timedelta(microseconds=1)
    rows = []
    # exactly 7 days between the first and fourth device: counts
    rows += [("exact", t0, "d1"), ("exact", t0 + timedelta(days=1), "d2"), ("exact", t0 + timedelta(days=3), "d3")]
    rows += [("exact", t0 + week, "d4")]
    # one microsecond more: does not
    rows += [("over", t0, "d1"), ("over", t0 + timedelta(days=1), "d2"), ("over", t0 + timedelta(days=3), "d3")]
    rows += [("over", t0 + week + us, "d4")]
    # three devices only
    rows += [("three", t0 + timedelta(hours=h), f"d{h % 3}") for h in range(10)]
    # a missing device counts as one device ("unknown")
    rows += [("nulldev", t0, None), ("nulldev", t0, "d1"), ("nulldev", t0, "d2"), ("nulldev", t0, "d3")]
    # four devices at one instant
    rows += [("same", t0, f"d{i}") for i in range(4)]
    # one device many times
    rows += [("one", t0 + timedelta(hours=h), "d1") for h in range(50)]
    # a device seen again later is active again, the old sighting is not
    rows += [("renew", t0, "d1"), ("renew", t0, "d2"), ("renew", t0 + timedelta(days=10), "d3")]
    rows += [("renew", t0 + timedelta(days=10), "d4"), ("renew", t0 + timedelta(days=12), "d1")]
    got = _burst(spark, rows)
    assert got == {
        "exact": 1.0,
        "over": 0.0,
        "three": 0.0,
        "nulldev": 1.0,
        "same": 1.0,
        "one": 0.0,
        "renew": 0.0,
    }


def test_device_burst_across_bucket_boundary(spark):
    # 1970-01-01 + 7k days is a bucket edge; straddle it.
    edge = datetime(1970, 1, 1) + timedelta(days=7 * 2630)
    rows = [
        ("x", edge - timedelta(days=3), "d1"),
        ("x", edge - timedelta(seconds=1), "d2"),
        ("x", edge, "d3"),
        ("x", edge + timedelta(days=3), "d4"),
    ]
    assert _burst(spark, rows) == {"x": 1.0}


def test_null_event_time_is_ignored(spark):
    t0 = datetime(2020, 3, 1)
    rows = [("n", t0, "d1"), ("n", None, "d2"), ("n", t0, "d3"), ("n", t0, "d4")]
    assert _burst(spark, rows) == {"n": 0.0}


# --- D10: day against instant, repeated loan numbers --------------------------


def _loan(no, cust, t, xfd=False):
    codes = ("10", "RXD", "02") if xfd else ("20", "CASH", "02")
    return (no, cust, t, Decimal("100.00"), 3.0, 0.1, *codes)


def test_overdue_on_the_later_loans_day_counts_as_before(spark):
    loans = frame(
        spark,
        LOANS,
        [_loan("L1", "c", datetime(2020, 1, 1, 10)), _loan("L2", "c", datetime(2020, 3, 5, 12))],
    )
    overdue = frame(spark, OVERDUE, [("L1", datetime(2020, 3, 1), date(2020, 3, 5), 5.0)])
    repay = frame(spark, REPAY, [])
    r = op.loan_history_counts(op.loan_outcomes(loans, overdue, repay)).first()
    assert (r.all_good_cnt, r.all_bad_cnt) == (0.0, 1.0)


def test_good_needs_repayment_before_and_overdue_after(spark):
    loans = frame(
        spark,
        LOANS,
        [
            _loan("L1", "c", datetime(2020, 1, 1), xfd=True),
            _loan("L2", "c", datetime(2020, 2, 1)),
            _loan("L3", "c", datetime(2020, 4, 1)),
        ],
    )
    overdue = frame(spark, OVERDUE, [("L1", datetime(2020, 3, 1), date(2020, 3, 10), 2.0)])
    repay = frame(spark, REPAY, [("L1", None, None, "200", datetime(2020, 1, 15), None)])
    r = op.loan_history_counts(op.loan_outcomes(loans, overdue, repay)).first()
    # (L2, L1): repaid before L2, overdue after L2's day -> good (also xfd good)
    # (L3, L1): overdue before L3 -> bad (also xfd bad); (L3, L2): nothing
    assert (r.all_good_cnt, r.all_bad_cnt, r.xfd_good_cnt, r.xfd_bad_cnt) == (1.0, 1.0, 1.0, 1.0)
    assert r.all_odds_ratio == 1.0 / 2.1


def test_rows_sharing_a_loan_number_do_not_pair(spark):
    # The same loan number twice, at two times: the pair is excluded.
    loans = frame(spark, LOANS, [_loan("L1", "c", datetime(2020, 1, 1)), _loan("L1", "c", datetime(2020, 2, 1))])
    overdue = frame(spark, OVERDUE, [("L1", datetime(2019, 12, 1), date(2019, 12, 1), 2.0)])
    assert op.loan_history_counts(op.loan_outcomes(loans, overdue, frame(spark, REPAY, []))).count() == 0
    loans2 = frame(
        spark,
        LOANS,
        [_loan("L1", "c", datetime(2020, 1, 1)), _loan("L1", "c", datetime(2020, 2, 1)), _loan("L2", "c", datetime(2020, 3, 1))],
    )
    r = op.loan_history_counts(op.loan_outcomes(loans2, overdue, frame(spark, REPAY, []))).first()
    assert r.all_bad_cnt == 2.0  # L2 with each L1 row


# --- D14 / D19 / D24 ties -------------------------------------------------------


def test_latest_report_breaks_ties_by_serial(spark):
    cohort = frame(spark, COHORT, [("c", CENSOR), ("d", CENSOR)])
    reports = frame(
        spark,
        "report_sn string, cert_no string, report_create_time timestamp",
        [
            ("001", "c", datetime(2020, 5, 1)),
            ("003", "c", datetime(2020, 5, 1)),
            ("009", "c", datetime(2020, 1, 1)),
            ("007", "c", datetime(2021, 5, 1)),
            (None, "d", datetime(2020, 5, 1)),
            ("005", "d", datetime(2020, 1, 1)),
        ],
    )
    got = by_key(op.latest_report(cohort, reports).collect())
    assert set(got) == {"c"}  # d's latest report has no serial: no row
    assert got["c"].report_sn == "003"
    norm = by_key(op.latest_report_normalised(cohort, reports).collect())
    assert norm["c"].report_sn == "003"
    assert norm["d"].report_sn is None  # kept, serial null


def test_last_loan_keeps_ties(spark):
    cohort = frame(spark, COHORT, [("c", CENSOR)])
    t = datetime(2020, 6, 1)
    loans = frame(
        spark,
        LOANS,
        [
            ("L1", "c", t, Decimal("10.00"), 3.0, 0.1, "10", "RXD", "02"),
            ("L2", "c", t, Decimal("20.00"), 6.0, 0.2, "10", "RXD", "02"),
            ("L3", "c", datetime(2020, 1, 1), Decimal("30.00"), 6.0, 0.2, "10", "RXD", "02"),
            ("L4", "c", datetime(2022, 1, 1), Decimal("40.00"), 6.0, 0.2, "10", "RXD", "02"),
        ],
    )
    rows = op.last_loan_profile(cohort, loans).collect()
    assert sorted(r.last_apply_amount for r in rows) == [10.0, 20.0]
    assert {r.all_xfd_loan_cnt for r in rows} == {3.0}


# --- D15: enquiries after the report, null dates -------------------------------


def test_gen1_counts_later_enquiries_not_null_dates(spark):
    latest = frame(
        spark,
        "cust_ids string, cert_no string, report_sn string, report_create_time timestamp",
        [("c", "c", "r1", datetime(2020, 6, 1))],
    )
    queries = frame(
        spark,
        "report_id string, querydate timestamp, queryreason string",
        [
            ("r1", datetime(2020, 7, 1), "贷款审批"),  # after the report: counts
            ("r1", None, "贷款审批"),  # no date: does not
            ("r1", datetime(2020, 5, 1), "贷款审批"),
            ("r1", datetime(2020, 5, 1), "贷款审批"),  # equal enquiry: counts again
            ("r1", datetime(2019, 1, 1), "信用卡审批"),
        ],
    )
    summary = frame(
        spark,
        "report_id string, lastmonthquery_selfquery bigint, last2yearquery_loanmanage bigint",
        [("r1", 1, 5), ("r1", 2, 7)],
    )
    r = op.query_counts_gen1(latest, queries, summary).first()
    # each enquiry row pairs with both summary rows
    assert r.query_loan_cnt_3m_1 == 3 * 2
    assert r.query_cnt_12m_1 == 3 * 2
    assert r.query_card_cnt_12m_1 == 0
    assert (r.query_loanmanage_24m_1, r.query_selfquery_1m_1, r.uq) == (7, 2, 2)


# --- D16/D17: gen-2 trees -------------------------------------------------------


def _gen2(spark, docs, records):
    """docs: (doc id, create time, person id); records: (doc id, date, org, reason)."""
    s = lambda schema, rows: frame(spark, schema, rows)
    main = s("id string, report_code string, create_time timestamp", [(d, "R" + d, t) for d, t, _ in docs])
    pqo = s("id string, doc_id string", [("q" + d, d) for d, _, _ in docs])
    pqo_pc05 = s("id string, pqo_id string", [("c" + d, "q" + d) for d, _, _ in docs])
    pc05a = s(
        "id string, pqo_pc05_id string, pc05aq01 string, pc05ar01 timestamp, pc05ad01 string, pc05ai01 string",
        [("a" + d, "c" + d, "r", None, "o", "x") for d, _, _ in docs],
    )
    pc05b = s(
        "id string, pqo_pc05_id string, pc05bs01 bigint, pc05bs02 bigint, pc05bs03 bigint, pc05bs04 bigint, "
        "pc05bs05 bigint, pc05bs06 bigint",
        [("b" + d, "c" + d, 1, 1, 1, 1, 4, 9) for d, _, _ in docs],
    )
    poq = s("id string, doc_id string", [("p" + d, d) for d, _, _ in docs])
    ph01 = s(
        "poq_id string, ph010r01 timestamp, ph010d01 string, ph010q02 string, ph010q03 string",
        [("p" + d, t, "m", org, reason) for d, t, org, reason in records],
    )
    prh = s("id string, doc_id string", [("h" + d, d) for d, _, _ in docs])
    pa01 = s("id string, prh_id string", [("u" + d, "h" + d) for d, _, _ in docs])
    pa01b = s(
        "prh_pa01_id string, pa01bq01 string, pa01bd01 string, pa01bi01 string, pa01bi02 string, pa01bd02 string",
        [("u" + d, "name", "10", who, "q", "01") for d, _, who in docs],
    )
    ident = op.report_identity(prh, pa01, pa01b)
    return main, (pqo, pqo_pc05, pc05a, pc05b, poq, ph01, ident)


def test_gen2_collapses_equal_enquiries_and_keeps_tied_reports(spark):
    t = datetime(2020, 6, 1)
    docs = [("d1", t, "c"), ("d2", t, "c"), ("d0", datetime(2020, 1, 1), "c")]
    q = datetime(2020, 5, 20)
    records = [
        ("d1", q, "org1", "2"),
        ("d1", q, "org1", "2"),  # equal row within a document
        ("d2", q, "org1", "2"),  # equal row in the tied document: collapses
        ("d2", q, "org2", "02"),  # another organisation, code written 02: counts
        ("d2", q, "org3", "x"),  # non-numeric code: no match, no error
        ("d0", q, "org9", "3"),  # older report: ignored
    ]
    main, tree = _gen2(spark, docs, records)
    cohort = frame(spark, COHORT, [("c", CENSOR)])
    r = op.query_counts_gen2(op.latest_documents(cohort, main, tree[-1]), *tree).first()
    assert r.query_cnt_3m_2 == 3.0
    assert r.query_loan_cnt_3m_2 == 2.0
    assert r.query_card_cnt_12m_2 == 0.0
    assert (r.query_loanmanage_24m_2, r.query_selfquery_cnt_1m_2) == (9, 4)


# --- D20: settlement ratios -----------------------------------------------------


def test_settlement_ratios_and_zero_divisors(spark):
    censor = datetime(2021, 1, 1)
    latest = frame(
        spark,
        "cust_ids string, report_sn string, cert_no string, censor timestamp, report_create_time timestamp",
        [("a", "r1", "a", censor, None), ("b", "r2", "b", censor, None)],
    )
    schema = (
        "report_id string, loan_id string, start_date timestamp, end_date timestamp, org_type string, "
        "organname string, loan_amount decimal(18,2), loan_type string, period double, payment_method string, "
        "account_status string"
    )
    rows = [
        # settled
        ("r1", "l1", datetime(2020, 6, 1), datetime(2020, 12, 1), "b", "o", Decimal("100"), "t", 10.0, "m", "结清"),
        # open with a status
        ("r1", "l2", datetime(2020, 6, 1), datetime(2021, 6, 1), "b", "o", Decimal("200"), "t", 10.0, "m", "正常"),
        # no status, ends after the censor: 365 days, 10 periods, 151 days left -> int(4.13..) = 4 periods
        ("r1", "l3", datetime(2020, 6, 1), datetime(2021, 6, 1), "b", "o", Decimal("300"), "t", 10.0, "m", None),
        # too old, and an excluded type
        ("r1", "l4", datetime(2019, 1, 1), datetime(2021, 6, 1), "b", "o", Decimal("999"), "t", 10.0, "m", "结清"),
        ("r1", "l5", datetime(2020, 6, 1), datetime(2021, 6, 1), "b", "o", Decimal("999"), "个人住房贷款", 1.0, "m", "结清"),
        # b: only a loan without status and no amount
        ("r2", "l6", datetime(2020, 6, 1), datetime(2020, 7, 1), "b", "o", Decimal("0"), "t", 1.0, "m", None),
    ]
    got = by_key(op.loan_settlement_ratios(latest, frame(spark, schema, rows)).collect())
    assert got["a"].settled_loan_cnt_ratio_1y == 0.5
    periods_left = int((151 / 365) * 10)
    assert got["a"].settled_loan_amount_ratio_1y == (100 + 30.0 * periods_left) / 600
    assert got["b"].settled_loan_cnt_ratio_1y == 0.0  # 0 / 0 -> 0.0
    assert got["b"].settled_loan_amount_ratio_1y is None  # 0 / 0 -> null


def test_min_gap_over_three_cards(spark):
    latest = frame(
        spark,
        "cust_ids string, report_sn string, cert_no string, censor timestamp, report_create_time timestamp",
        [("a", "r1", "a", CENSOR, None), ("b", "r2", "b", CENSOR, None), ("c", "r3", "c", CENSOR, None)],
    )
    schema = (
        "report_id string, start_date timestamp, org_type string, organname string, card_type string, "
        "guarantee_type string, deadline string"
    )
    d = lambda m, dd: datetime(2020, m, dd)
    rows = [
        ("r1", d(1, 1), "t", "o1", "c", "g", "x"),
        ("r1", d(1, 1), "t", "o2", "c", "g", "x"),
        ("r1", d(1, 20), "t", "o3", "c", "g", "x"),
        ("r1", d(3, 1), "t", "o4", "c", "g", "x"),
        ("r1", None, "t", "o5", "c", "g", "x"),
        ("r2", d(1, 1), "t", "o1", "c", "g", "x"),
        ("r2", d(1, 1), "t", "o1", "c", "g", "x"),  # duplicate card: one
        ("r2", d(2, 1), "t", "o1", "c", "g", "x"),
    ]
    got = by_key(op.min_gap_lag2(latest, frame(spark, schema, rows)).collect())
    assert got["a"].lag2_loan_card_time_diff_min == 19
    assert got["b"].lag2_loan_card_time_diff_min is None
    assert got["c"].lag2_loan_card_time_diff_min is None


# --- D26: derived values ----------------------------------------------------------


def test_derived_day_index_and_ids(spark):
    schema = (
        "cust_ids string, time_censor timestamp, t0 double, xfd_good_cnt double, xfd_bad_cnt double, "
        "all_xfd_loan_cnt double, lag2_loan_card_time_diff_min int, query_loanmanage_24m bigint, "
        "query_selfquery_1m bigint, uq bigint"
    )
    epoch = datetime(1970, 1, 1, 15)
    rows = [
        ("123456198001011234", epoch, 0.625, 1.0, 2.0, 4.0, 3, 1, 2, 1),
        ("123456198001011235", epoch, 0.625, None, None, 1.0, None, None, None, 1),
    ]
    assembled = frame(spark, schema, rows)
    repay = frame(spark, "cust_ids string, suc_cnt double", [])
    got = by_key(op.derived_features(assembled, repay).collect())
    a, b = got["123456198001011234"], got["123456198001011235"]
    assert a.dow == 0.0 and a.hr == 15.0
    assert a.id_num == b.id_num  # 17 digits do not fit a double exactly
    assert a.id_head_1 == 34.0 and a.age == 1970.0 - 1980.0
    assert (a.good_ratio, a.bad_ratio) == (0.25, 0.5)
    cols = op.derived_features(assembled, repay).columns
    assert "uq" not in cols and "t0" not in cols


def test_no_consumer_loans_gives_loan_count_one(spark):
    import __spark_entry__ as entry

    df = entry.queries()["feature_assembly"](spark, "/root/testdata/sf0.001")
    rows = df.select("last_apply_term", "all_xfd_loan_cnt").collect()
    assert all(r.all_xfd_loan_cnt == 1.0 for r in rows if r.last_apply_term is None)
    assert any(r.all_xfd_loan_cnt > 1.0 for r in rows)


def test_principal_ratio_without_applications(spark):
    cohort = frame(spark, COHORT, [("c", CENSOR)])
    loans = frame(spark, LOANS, [])
    repaid = frame(spark, "cust_ids string, xfd_int_pay_sum double, xfd_p_pay_sum double", [("c", 0.0, 0.0)])
    r = op.principal_pay_ratio(cohort, loans, repaid).first()
    assert (r.xfd_apply_amt_cum, r.xfd_principal_pay_ratio) == (0.0, -0.1)


# --- hot right-side keys ----------------------------------------------------------


def test_left_join_many_equals_left_join(spark):
    from pitwise.functions.joins import left_join_many

    left = frame(spark, "k string, a int", [("hot", 1), ("cold", 2), ("none", 3), (None, 4), ("hot", 5)])
    right_rows = [("hot", i, f"v{i % 7}") for i in range(500)] + [("hot", 0, "same")] * 500 + [("cold", 1, "x"), ("cold", 1, "x"), (None, 9, "n")]
    right = frame(spark, "k string, b int, c string", right_rows)
    want = sorted(map(tuple, left.join(right, ["k"], "left").collect()), key=str)
    for heavy in (None, {}, {"hot": 7}, {"hot": 1200, "cold": 3}):
        got_df = left_join_many(left, right, ["k"], heavy)
        assert got_df.columns == ["k", "a", "b", "c"]
        assert sorted(map(tuple, got_df.collect()), key=str) == want
    distinct = right.distinct()
    want = sorted(map(tuple, left.join(distinct, ["k"], "left").collect()), key=str)
    got_df = left_join_many(left, distinct, ["k"], {"hot": 5}, place=F.xxhash64("k", "b", "c"))
    assert sorted(map(tuple, got_df.collect()), key=str) == want


def test_heavy_keys_are_found_and_their_rows_are_dealt(spark):
    from pitwise.functions.joins import heavy_keys, left_join_many

    right = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 999).cast("string"))).alias("k"), "id")
    right = right.unionByName(spark.range(9000).select(F.lit(None).cast("string").alias("k"), "id"))
    assert heavy_keys(right, "k", least=1000, share=1.0) == {"hot": 10}
    assert set(heavy_keys(right, "k", least=1000, share=0.1)) == {"hot"}
    assert heavy_keys(right, "k") == {} == heavy_keys(right.limit(0), "k", 1, 1.0)
    left = frame(spark, "k string, a int", [("hot", 1), ("k1", 2), ("none", 3)])
    joined = left_join_many(left, right, ["k"], {"hot": 10})
    assert "SortMergeJoin" in (plan := joined._jdf.queryExecution().executedPlan().toString()) and plan.count("Range (") == 2
    count = lambda df: dict(map(tuple, df.groupBy("k").count().collect()))
    assert count(joined) == count(left.join(right, "k", "left")) == {"hot": 10_000, "k1": 31, "none": 1}


def test_gen2_rows_of_tied_documents_coincide(spark):
    # Three documents at one instant that share identity, summary and enquiry
    # rows, against counting the distinct flattened rows.
    import random

    rng = random.Random(11)
    t = datetime(2020, 6, 1)
    s = lambda schema, rows: frame(spark, schema, rows)
    customers = [f"c{i}" for i in range(40)]
    docs = [(f"{c}d{k}", c) for i, c in enumerate(customers) for k in range(1 + i % 3 + (i % 7 == 0))]
    pick = lambda most, n: [rng.randrange(n) for _ in range(rng.randrange(most + 1))]
    main = s("id string, report_code string, create_time timestamp", [(d, "R", t) for d, _ in docs])
    pqo = s("id string, doc_id string", [("q" + d, d) for d, _ in docs if rng.random() < 0.8])
    units = [(f"s{d}{k}", "q" + d, k) for d, _ in docs for k in pick(3, 3)]
    pqo_pc05 = s("id string, pqo_id string", [(u, q) for u, q, _ in units])
    pc05a = s("id string, pqo_pc05_id string, pc05aq01 string, pc05ar01 timestamp, pc05ad01 string, pc05ai01 string", [])
    pc05b = s(
        "id string, pqo_pc05_id string, pc05bs01 bigint, pc05bs02 bigint, pc05bs03 bigint, pc05bs04 bigint, pc05bs05 bigint, pc05bs06 bigint",
        [("b", u, 1, 1, 1, 1, 4 + k, 9 - k) for u, _, k in units if k < 2],
    )
    poq = s("id string, doc_id string", [("p" + d, d) for d, _ in docs if rng.random() < 0.9])
    ph01 = s(
        "poq_id string, ph010r01 timestamp, ph010d01 string, ph010q02 string, ph010q03 string",
        [("p" + d, datetime(2020, 5, 1 + k) if k else None, "m", f"org{k % 2}", "23x"[k % 3]) for d, _ in docs for k in pick(5, 6)],
    )
    prh = s("id string, doc_id string", [("h" + d, d) for d, _ in docs])
    pa01 = s("id string, prh_id string", [("u" + d, "h" + d) for d, _ in docs])
    pa01b = s(
        "prh_pa01_id string, pa01bq01 string, pa01bd01 string, pa01bi01 string, pa01bi02 string, pa01bd02 string",
        [("u" + d, f"name{k}", "10", c, "q", "01") for d, c in docs for k in [0, *pick(3, 4)]] + [("u" + docs[0][0], "n", "10", "other", "q", "01")],
    )
    cohort = frame(spark, COHORT, [(c, CENSOR) for c in customers])
    tree = (pqo, pqo_pc05, pc05a, pc05b, poq, ph01)
    own = op.cohort_identity(cohort, prh, pa01, pa01b)
    assert own.where("id_card_num = 'other'").count() == 0
    got = {r.cust_ids: r for r in op.query_counts_gen2(op.latest_documents(cohort, main, own), *tree, own).collect()}
    flat = op.report_flatten(main, *tree, op.report_identity(prh, pa01, pa01b)).collect()
    assert set(got) == set(customers)
    for c, r in got.items():
        rows = [f for f in flat if f.id_card_num == c]
        days = [(t - f.query_date).days if f.query_date else None for f in rows]
        near = [f for f, d in zip(rows, days, strict=True) if d is not None and d <= 90]
        assert r.query_cnt_3m_2 == len(near), c
        assert r.query_loan_cnt_12m_2 == sum(f.query_reason == "2" for f in near)
        assert r.query_card_cnt_3m_2 == sum(f.query_reason == "3" for f in near)
        known = [f.query_loanmanage_24m for f in rows if f.query_loanmanage_24m is not None]
        assert r.query_loanmanage_24m_2 == max(known, default=None)
    plan = op.query_counts_gen2(op.latest_documents(cohort, main, own), *tree, own)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_cohort_selects_the_facts(spark):
    # The cohort is met by the loans, and these by the facts: in the plan, the
    # cohort's scan lies below the join with the fact table.
    from pitwise.plans.registry import fixture_job

    job = fixture_job(spark, "/root/testdata/sf0.001")
    for name, facts in (("repaid", "l_extendedprice"), ("od_strict", "l_quantity"), ("od_any", "l_quantity"), ("cohort_outcomes", "l_shipdate")):
        plan = getattr(job, name)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        cohort = max(depth(x) for x in plan if "Relation" in x and "o_custkey" in x)
        assert cohort > min(depth(x) for x in plan if "Relation" in x and facts in x), name


def test_distinct_counts_without_expand(spark):
    from pitwise.plans.registry import fixture_job

    job = fixture_job(spark, "/root/testdata/sf0.001")
    for name in ("device_peak", "settlement"):
        assert "Expand" not in job.__getattribute__(name)._jdf.queryExecution().executedPlan().toString()
    plan = job.settlement._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in x and "l_tax" in x for x in plan.splitlines()) == 1
    flat = job.report_flat._jdf.queryExecution().optimizedPlan().toString()
    assert flat.count("Relation [") == 10


def test_gen2_single_document_count_factorises(spark):
    # One latest document with two identity rows for the customer and two
    # summary rows: each distinct enquiry appears in 2 x 2 flattened rows.
    t = datetime(2020, 6, 1)
    q = datetime(2020, 5, 20)
    main, (pqo, pqo_pc05, pc05a, pc05b, poq, ph01, _) = _gen2(
        spark, [("d1", t, "c")], [("d1", q, "org1", "2"), ("d1", q, "org1", "2"), ("d1", q, "org2", "3")]
    )
    s = lambda schema, rows: frame(spark, schema, rows)
    pc05b = s(
        "id string, pqo_pc05_id string, pc05bs01 bigint, pc05bs02 bigint, pc05bs03 bigint, pc05bs04 bigint, "
        "pc05bs05 bigint, pc05bs06 bigint",
        [("b1", "cd1", 1, 1, 1, 1, 4, 9), ("b2", "cd1", 1, 1, 1, 1, 5, 2)],
    )
    prh = s("id string, doc_id string", [("hd1", "d1")])
    pa01 = s("id string, prh_id string", [("u1", "hd1"), ("u2", "hd1")])
    pa01b = s(
        "prh_pa01_id string, pa01bq01 string, pa01bd01 string, pa01bi01 string, pa01bi02 string, pa01bd02 string",
        [("u1", "name", "10", "c", "q", "01"), ("u2", "other name", "10", "c", "q", "01")],
    )
    ident = op.report_identity(prh, pa01, pa01b)
    cohort = frame(spark, COHORT, [("c", CENSOR)])
    r = op.query_counts_gen2(op.latest_documents(cohort, main, ident), pqo, pqo_pc05, pc05a, pc05b, poq, ph01, ident).first()
    flat = op.report_flatten(main, pqo, pqo_pc05, pc05a, pc05b, poq, ph01, ident)
    assert flat.count() == 2 * 2 * 2
    assert (r.query_cnt_3m_2, r.query_loan_cnt_3m_2, r.query_card_cnt_3m_2) == (8.0, 4.0, 4.0)
    assert (r.query_loanmanage_24m_2, r.query_selfquery_cnt_1m_2) == (9, 5)


def test_left_join_one_to_one_equals_join_chain(spark):
    from pitwise.functions.joins import left_join_one_to_one

    base = frame(spark, "cust_ids string, t double", [("a", 1.0), ("b", 2.0), ("c", None)])
    p1 = frame(spark, "cust_ids string, x double, y bigint", [("a", 0.5, 3), ("z", 9.0, 9), ("c", None, None)])
    p2 = frame(spark, "cust_ids string, `7w` double", [("b", float("nan")), ("a", 1.5)])
    want = base.join(p1, "cust_ids", "left").join(p2, "cust_ids", "left")
    got = left_join_one_to_one(base, [p1, p2])
    assert got.columns == want.columns
    norm = lambda rows: sorted((tuple("nan" if v != v else v for v in r) for r in rows), key=repr)
    assert norm(got.collect()) == norm(want.collect())


def test_flatten_keeps_documents_with_missing_branches(spark):
    # d2 has no summary, no enquiries and no identity: one null-padded row.
    t = datetime(2020, 6, 1)
    main, (pqo, pqo_pc05, pc05a, pc05b, poq, ph01, ident) = _gen2(
        spark, [("d1", t, "c")], [("d1", datetime(2020, 5, 1), "org1", "2")]
    )
    main2 = main.unionByName(frame(spark, "id string, report_code string, create_time timestamp", [("d2", "Rd2", t)]))
    rows = op.report_flatten(main2, pqo, pqo_pc05, pc05a, pc05b, poq, ph01, ident).collect()
    assert len(rows) == 2
    bare = [r for r in rows if r.id_card_num is None]
    assert len(bare) == 1 and bare[0].query_date is None and bare[0].query_loanmanage_24m is None
