"""DuckDB oracles: each registered query written independently in SQL.

The SQL follows the feature definitions literally (join-backs for latest
rows, the self theta-join for loan history, a brute-force window count for
device bursts, the joined product for bureau counts), so it checks the
Spark plans, which compute the same values differently. Input CTEs
``in_<name>`` come from the shared fixture adapters.

Conventions that keep the two engines bit-identical: money is summed as
decimal and cast to double once; counts that the features report as double
are integer sums cast to double; every ratio guards its divisor with
``nullif``; times are compared as typed values.
"""

from __future__ import annotations

from pitwise.sources import fixture

# Fixed values of the definitions, written out here and not shared with the
# operators, so that a wrong value on either side shows.
RXD_CHANNEL_MARK = "任性贷"
EVENT_TOTAL_CODES = ("LOGIN_POST", "E0906")
EVENT_RATE_CODES = ("E0506", "LOGIN_POST", "E0406", "E0906", "E0418", "E0129", "E0428", "E0424", "E0425", "E0434")
QUERY_WINDOWS = (90, 180, 365)
REASON_LOAN = "贷款审批"
REASON_CARD = "信用卡审批"
GEN2_REASON_LOAN = 2
GEN2_REASON_CARD = 3
EXCLUDED_LOAN_TYPES = ("个人汽车贷款", "个人商用房（包括商住两用）贷款", "个人住房贷款")
SETTLED = "结清"
SETTLEMENT_LOOKBACK_DAYS = 365

C = f"TIMESTAMP '{fixture.CENSOR}'"
DAY_US = 86_400_000_000
XFD = "partner_no = '10' AND product_no = 'RXD' AND quota_type = '02'"
VALID_LOAN = "loan_time IS NOT NULL AND length(cust_ids) > 0"


def _days(ts: str) -> str:
    return f"(CAST(epoch_us({ts}) AS DOUBLE) / {float(DAY_US)})"


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS DOUBLE)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# name -> (dependencies, body). Dependencies are CTE names or in_<input>.
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


cte(
    "cohort",
    ("in_credits",),
    f"SELECT DISTINCT card_no AS cust_ids, {C} AS time_censor FROM in_credits WHERE length(card_no) = 18",
)
cte(
    "accounts",
    ("cohort", "in_members"),
    "SELECT DISTINCT c.cust_ids, c.time_censor, m.acct_no FROM cohort c "
    "JOIN in_members m ON m.id_card = c.cust_ids WHERE length(m.acct_no) = 19 AND m.acct_no IS NOT NULL",
)
cte(
    "events_asof",
    ("accounts", "in_device_events"),
    "SELECT DISTINCT a.acct_no, a.cust_ids, a.time_censor, e.pay_time, e.event_code, e.device_id, e.city, "
    "e.pay_order_no FROM accounts a JOIN in_device_events e ON e.account_no = a.acct_no "
    "WHERE e.pay_time IS NOT NULL AND length(e.account_no) = 19 AND e.pay_time < a.time_censor",
)
cte(
    "payments",
    ("accounts", "in_orders", "in_order_lines"),
    f"""SELECT o.merchant_order_id, a.cust_ids, a.time_censor, a.acct_no, o.buyer_user_no, o.amount,
       o.pay_time, o.pay_order_id, l.pay_channel_name, l.pay_type, l.is_rxd_pay
FROM accounts a
JOIN (SELECT DISTINCT buyer_user_no, merchant_order_id, amount, pay_time, pay_order_id FROM in_orders
      WHERE amount < {fixture.AMOUNT_CAP} AND length(buyer_user_no) = 19 AND pay_order_id IS NOT NULL) o
  ON o.buyer_user_no = a.acct_no
JOIN (SELECT merchant_order_id, pay_channel_name, pay_type,
             CASE WHEN contains(pay_channel_name, {_q(RXD_CHANNEL_MARK)}) THEN 1 ELSE 0 END AS is_rxd_pay
      FROM in_order_lines) l
  ON l.merchant_order_id = o.merchant_order_id
WHERE o.pay_time < a.time_censor AND o.pay_time IS NOT NULL""",
)

_CREDIT = "coalesce(contains(pay_type, 'CREDIT'), false)"
cte(
    "d5",
    ("payments",),
    f"""SELECT cust_ids,
  CAST(sum(cn) AS DOUBLE) / nullif(CAST(sum(cn) + sum(nn) AS DOUBLE), 0) AS credit_pay_ratio_all,
  max(CAST(cn AS DOUBLE) / nullif(CAST(cn + nn AS DOUBLE), 0)) AS credit_pay_ratio_max,
  CAST(sum(ca) AS DOUBLE) / nullif(CAST(sum(ca) + sum(na) AS DOUBLE), 0) AS credit_pay_amount_ratio_all,
  max(CAST(ca AS DOUBLE) / nullif(CAST(ca + na AS DOUBLE), 0)) AS credit_pay_amount_ratio_max,
  max(CASE WHEN pay_month = censor_month THEN CAST(ca AS DOUBLE) / nullif(CAST(ca + na AS DOUBLE), 0)
           ELSE CAST(0.0 AS DOUBLE) END) AS credit_pay_amount_ratio_this_month
FROM (SELECT cust_ids, date_trunc('month', pay_time) AS pay_month,
        count(DISTINCT CASE WHEN {_CREDIT} THEN pay_order_id END) AS cn,
        count(DISTINCT CASE WHEN NOT {_CREDIT} THEN pay_order_id END) AS nn,
        sum(CASE WHEN {_CREDIT} THEN amount ELSE 0 END) AS ca,
        sum(CASE WHEN NOT {_CREDIT} THEN amount ELSE 0 END) AS na,
        min(date_trunc('month', time_censor)) AS censor_month
      FROM payments GROUP BY 1, 2) m
GROUP BY cust_ids""",
)
_RXD = f"coalesce(contains(pay_channel_name, {_q(RXD_CHANNEL_MARK)}), false)"
cte(
    "d6",
    ("payments",),
    f"""SELECT cust_ids, count(DISTINCT merchant_order_id) AS merchant_order_cnt,
  (CAST(sum(amount) AS DOUBLE) / 100.0) / nullif(CAST(count(amount) AS DOUBLE), 0) AS merchant_order_amt_avg,
  (CAST(sum(CASE WHEN {_CREDIT} THEN amount ELSE 0 END) AS DOUBLE) / 100.0)
      / nullif(CAST(count(*) AS DOUBLE), 0) AS merchant_order_credit_pay_amt_avg,
  (CAST(sum(CASE WHEN {_RXD} THEN amount ELSE 0 END) AS DOUBLE) / 100.0)
      / nullif(CAST(sum(amount) AS DOUBLE) / 100.0 + 0.1, 0) AS rxd_pay_amt_ratio
FROM payments GROUP BY cust_ids""",
)

_span = f"nullif({_days('censor_ts')} - {_days('first_ts')}, 0)"
cte(
    "d7",
    ("events_asof",),
    "SELECT cust_ids, "
    + ", ".join(f"{c} AS {c}_all" for c in EVENT_TOTAL_CODES)
    + ", "
    + ", ".join(f"{c} / {_span} AS {c}_avg" for c in EVENT_RATE_CODES)
    + " FROM (SELECT cust_ids, "
    + ", ".join(f"{_cnt(f'event_code = {_q(c)}')} AS {c}" for c in EVENT_RATE_CODES)
    + ", min(pay_time) AS first_ts, max(time_censor) AS censor_ts FROM (SELECT DISTINCT acct_no, cust_ids, "
    "time_censor, pay_time, event_code, device_id FROM events_asof WHERE pay_time < time_censor) e "
    "GROUP BY cust_ids) g",
)
cte(
    "d8",
    ("events_asof",),
    f"""SELECT cust_ids, CAST(CASE WHEN max(n) >= 4 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS "7days_device_cnt_more_than4"
FROM (SELECT a.cust_ids, a.us, count(DISTINCT x.dev) AS n
      FROM (SELECT DISTINCT cust_ids, epoch_us(pay_time) AS us FROM events_asof) a
      JOIN (SELECT DISTINCT cust_ids, coalesce(device_id, 'unknown') AS dev, epoch_us(pay_time) AS us
            FROM events_asof) x
        ON x.cust_ids = a.cust_ids AND x.us <= a.us AND x.us >= a.us - {7 * DAY_US}
      GROUP BY 1, 2) c
GROUP BY cust_ids""",
)
cte(
    "d9",
    ("events_asof",),
    f"""SELECT cust_ids, max(dn) AS month_machine_finger_loan_use_device_cnt_max,
       max(cn) AS month_machine_finger_loan_use_city_cnt_max
FROM (SELECT cust_ids, acct_no, date_trunc('{fixture.LOAN_USE_PERIOD}', pay_time) AS p,
             count(DISTINCT device_id) AS dn, count(DISTINCT city) AS cn
      FROM events_asof WHERE event_code IN ('E0418', 'E0406') GROUP BY 1, 2, 3) m
GROUP BY cust_ids""",
)

# Of an earlier loan, as seen from a later one taken at an instant: overdue by
# that day, or repaid before that instant and not (yet) overdue.
_OVERDUE = "coalesce(first_overdue <= CAST(seen_at AS DATE), false)"
_GOOD = f"(coalesce(first_paid < seen_at, false) AND NOT {_OVERDUE})"
cte(
    "d10",
    ("in_loans", "in_overdue", "in_repayments"),
    f"""WITH taken AS (
  SELECT cust_ids, loan_no, loan_time, coalesce({XFD}, false) AS consumer FROM in_loans WHERE {VALID_LOAN}
), outcome AS (
  SELECT t.*,
    (SELECT min(stat_date) FROM in_overdue o WHERE o.loan_no = t.loan_no) AS first_overdue,
    (SELECT min(apply_time) FROM in_repayments r WHERE r.loan_no = t.loan_no AND r.status = '200') AS first_paid
  FROM taken t
), pairs AS (
  SELECT earlier.*, later.loan_time AS seen_at
  FROM taken later JOIN outcome earlier USING (cust_ids)
  WHERE earlier.loan_no <> later.loan_no AND earlier.loan_time < later.loan_time
)
SELECT *, all_bad_cnt / (all_good_cnt + all_bad_cnt + 0.1) AS all_odds_ratio,
  xfd_bad_cnt / (xfd_good_cnt + xfd_bad_cnt + 0.1) AS xfd_odds_ratio
FROM (SELECT cust_ids, {_cnt(_GOOD)} AS all_good_cnt, {_cnt(_OVERDUE)} AS all_bad_cnt,
        {_cnt(f"consumer AND {_GOOD}")} AS xfd_good_cnt, {_cnt(f"consumer AND {_OVERDUE}")} AS xfd_bad_cnt
      FROM pairs GROUP BY cust_ids) counted""",
)
cte(
    "d11",
    ("cohort", "in_loans", "in_repayments"),
    f"""SELECT c.cust_ids, coalesce(CAST(s.i AS DOUBLE), 0.0) AS xfd_int_pay_sum,
       coalesce(CAST(s.p AS DOUBLE), 0.0) AS xfd_p_pay_sum
FROM cohort c LEFT JOIN (
  SELECT x.cust_ids,
    sum(CASE WHEN b.apply_time < c2.time_censor THEN coalesce(b.interest, 0) ELSE 0 END) AS i,
    sum(CASE WHEN b.apply_time < c2.time_censor THEN coalesce(b.principal, 0) ELSE 0 END) AS p
  FROM (SELECT DISTINCT loan_no, principal, interest, status, apply_time, debit_time FROM in_repayments
        WHERE loan_no IS NOT NULL AND apply_time IS NOT NULL AND status = '200') b
  JOIN (SELECT DISTINCT loan_no, cust_ids FROM in_loans WHERE {VALID_LOAN} AND {XFD}) x ON x.loan_no = b.loan_no
  JOIN cohort c2 ON c2.cust_ids = x.cust_ids
  GROUP BY x.cust_ids) s ON s.cust_ids = c.cust_ids""",
)
cte(
    "d12",
    ("cohort", "in_loans", "d11"),
    f"""SELECT cum.cust_ids, cum.xfd_apply_amt_cum, r.xfd_int_pay_sum, r.xfd_p_pay_sum,
  CASE WHEN cum.xfd_apply_amt_cum > 0.0 THEN r.xfd_p_pay_sum / cum.xfd_apply_amt_cum
       ELSE CAST(-0.1 AS DOUBLE) END AS xfd_principal_pay_ratio
FROM (SELECT c.cust_ids, CAST(sum(CASE WHEN ap.lt < c.time_censor THEN ap.loan_amount ELSE 0 END) AS DOUBLE)
             AS xfd_apply_amt_cum
      FROM cohort c
      LEFT JOIN (SELECT DISTINCT cust_ids, loan_time AS lt, loan_amount FROM in_loans
                 WHERE {VALID_LOAN} AND {XFD}) ap ON ap.cust_ids = c.cust_ids
      GROUP BY c.cust_ids) cum
LEFT JOIN d11 r ON r.cust_ids = cum.cust_ids""",
)
cte(
    "d13",
    ("cohort", "in_loans", "in_repayments"),
    f"""SELECT cust_ids, suc_cnt, fail_cnt, p_sum, fail_cnt / (fail_cnt + suc_cnt + 0.01) AS s_f_rate,
       coalesce(p_sum, 0.0) AS rxd_principal_pay_cum
FROM (SELECT c.cust_ids, {_cnt("d.status = '200'")} AS suc_cnt, {_cnt("d.status = '500'")} AS fail_cnt,
        CAST(sum(CASE WHEN d.status = '200' THEN d.p_amt ELSE 0 END) AS DOUBLE) AS p_sum
      FROM cohort c
      LEFT JOIN (SELECT ln.cust_ids, ln.loan_time AS lt, rp.status, coalesce(rp.principal, 0) AS p_amt,
                        rp.apply_time AS pt
                 FROM (SELECT DISTINCT loan_no, cust_ids, loan_time FROM in_loans WHERE {VALID_LOAN}) ln
                 LEFT JOIN (SELECT DISTINCT loan_no, principal, status, apply_time FROM in_repayments
                            WHERE apply_time IS NOT NULL AND status IS NOT NULL AND status IN ('200', '500')) rp
                   ON rp.loan_no = ln.loan_no) d
        ON d.cust_ids = c.cust_ids
      WHERE d.lt < c.time_censor AND d.pt < c.time_censor
      GROUP BY c.cust_ids) g""",
)
cte(
    "d14",
    ("cohort", "in_reports"),
    """SELECT j2.cust_ids, j2.cert_no, j2.report_sn, j2.report_create_time
FROM (SELECT j.* FROM (SELECT c.cust_ids, r.report_sn, r.cert_no, r.report_create_time
                       FROM cohort c JOIN (SELECT DISTINCT report_sn, cert_no, report_create_time FROM in_reports) r
                         ON r.cert_no = c.cust_ids
                       WHERE r.report_create_time < c.time_censor) j
      JOIN (SELECT c.cust_ids, max(r.report_create_time) AS t0
            FROM cohort c JOIN in_reports r ON r.cert_no = c.cust_ids
            WHERE r.report_create_time < c.time_censor GROUP BY c.cust_ids) t
        ON t.cust_ids = j.cust_ids AND j.report_create_time = t.t0) j2
JOIN (SELECT c.cust_ids, max(r.report_sn) AS id
      FROM cohort c JOIN in_reports r ON r.cert_no = c.cust_ids
      JOIN (SELECT c.cust_ids, max(r.report_create_time) AS t0
            FROM cohort c JOIN in_reports r ON r.cert_no = c.cust_ids
            WHERE r.report_create_time < c.time_censor GROUP BY c.cust_ids) t
        ON t.cust_ids = c.cust_ids AND r.report_create_time = t.t0
      GROUP BY c.cust_ids) s
  ON s.cust_ids = j2.cust_ids AND j2.report_sn = s.id""",
)


def _window_counts(reason: str, loan: str, card: str, suffix: str) -> str:
    w3, w6, w12 = QUERY_WINDOWS
    parts = [
        (f"no_days <= {w3}", "query_cnt_3m"),
        (f"no_days <= {w6}", "query_cnt_6m"),
        (f"no_days <= {w12}", "query_cnt_12m"),
        (f"no_days <= {w3} AND {reason} = {loan}", "query_loan_cnt_3m"),
        (f"no_days <= {w6} AND {reason} = {loan}", "query_loan_cnt_6m"),
        (f"no_days <= {w12} AND {reason} = {loan}", "query_loan_cnt_12m"),
        (f"no_days <= {w3} AND {reason} = {card}", "query_card_cnt_3m"),
        (f"no_days <= {w12} AND {reason} = {card}", "query_card_cnt_12m"),
    ]
    return ", ".join(f"{_cnt(cond)} AS {name}_{suffix}" for cond, name in parts)


cte(
    "d15",
    ("d14", "in_report_queries", "in_report_summary"),
    f"""SELECT cust_ids, {_window_counts("queryreason", _q(REASON_LOAN), _q(REASON_CARD), "1")},
  max(last2yearquery_loanmanage) AS query_loanmanage_24m_1,
  max(lastmonthquery_selfquery) AS query_selfquery_1m_1,
  count(DISTINCT lastmonthquery_selfquery) AS uq
FROM (SELECT rec.cust_ids, rec.no_days, rec.queryreason, s.lastmonthquery_selfquery, s.last2yearquery_loanmanage
      FROM (SELECT l.cust_ids, l.report_sn, q.queryreason,
                   date_diff('day', CAST(q.querydate AS DATE), CAST(l.report_create_time AS DATE)) AS no_days
            FROM d14 l LEFT JOIN in_report_queries q ON q.report_id = l.report_sn) rec
      LEFT JOIN (SELECT DISTINCT report_id, lastmonthquery_selfquery, last2yearquery_loanmanage
                 FROM in_report_summary) s
        ON s.report_id = rec.report_sn) x
GROUP BY cust_ids""",
)
cte(
    "flat",
    (
        "in_doc",
        "in_pqo",
        "in_pqo_pc05",
        "in_pc05a",
        "in_pc05b",
        "in_poq",
        "in_poq_ph01",
        "in_prh",
        "in_prh_pa01",
        "in_prh_pa01b",
    ),
    f"""SELECT DISTINCT m.create_time, rq.name, rq.id_type, rq.id_card_num, rq.query_ord_code, rq.query_reason_code,
  qr.query_date, qr.management_org_type, qr.query_org, qr.query_reason,
  qs.last_query_reason, qs.last_query_date, qs.last_query_org, qs.last_query_org_code,
  qs.query_loan_org_cnt_1m, qs.query_card_org_cnt_1m, qs.query_loan_cnt_1m, qs.query_card_cnt_1m,
  qs.query_selfquery_cnt_1m, qs.query_loanmanage_24m
FROM (SELECT DISTINCT id, report_code, create_time FROM in_doc
      WHERE create_time >= TIMESTAMP '{fixture.GEN2_MIN_CREATE} 00:00:00') m
LEFT JOIN (SELECT DISTINCT a.doc_id, a2.pc05aq01 AS last_query_reason, a2.pc05ar01 AS last_query_date,
             a2.pc05ad01 AS last_query_org, a2.pc05ai01 AS last_query_org_code,
             a3.pc05bs01 AS query_loan_org_cnt_1m, a3.pc05bs02 AS query_card_org_cnt_1m,
             a3.pc05bs03 AS query_loan_cnt_1m, a3.pc05bs04 AS query_card_cnt_1m,
             a3.pc05bs05 AS query_selfquery_cnt_1m, a3.pc05bs06 AS query_loanmanage_24m
           FROM (SELECT DISTINCT id, doc_id FROM in_pqo) a
           LEFT JOIN (SELECT DISTINCT id, pqo_id FROM in_pqo_pc05) a1 ON a.id = a1.pqo_id
           LEFT JOIN (SELECT DISTINCT * FROM in_pc05a) a2 ON a1.id = a2.pqo_pc05_id
           LEFT JOIN (SELECT DISTINCT * FROM in_pc05b) a3 ON a1.id = a3.pqo_pc05_id) qs ON m.id = qs.doc_id
LEFT JOIN (SELECT a.doc_id, a1.ph010r01 AS query_date, a1.ph010d01 AS management_org_type,
             a1.ph010q02 AS query_org, a1.ph010q03 AS query_reason
           FROM (SELECT DISTINCT * FROM in_poq) a
           LEFT JOIN (SELECT DISTINCT * FROM in_poq_ph01) a1 ON a.id = a1.poq_id) qr ON m.id = qr.doc_id
LEFT JOIN (SELECT DISTINCT a.doc_id, a1.id AS report_unit_id, a2.pa01bq01 AS name, a2.pa01bd01 AS id_type,
             a2.pa01bi01 AS id_card_num, a2.pa01bi02 AS query_ord_code, a2.pa01bd02 AS query_reason_code
           FROM (SELECT DISTINCT * FROM in_prh) a
           LEFT JOIN (SELECT DISTINCT * FROM in_prh_pa01) a1 ON a.id = a1.prh_id
           LEFT JOIN (SELECT DISTINCT * FROM in_prh_pa01b) a2 ON a1.id = a2.prh_pa01_id) rq ON m.id = rq.doc_id""",
)
cte(
    "d17",
    ("cohort", "flat"),
    f"""SELECT cust_ids,
  {_window_counts("TRY_CAST(query_reason AS INTEGER)", str(GEN2_REASON_LOAN), str(GEN2_REASON_CARD), "2")},
  max(query_loanmanage_24m) AS query_loanmanage_24m_2,
  max(query_selfquery_cnt_1m) AS query_selfquery_cnt_1m_2
FROM (SELECT lab.*, date_diff('day', CAST(lab.query_date AS DATE), CAST(lab.create_time AS DATE)) AS no_days
      FROM (SELECT c.cust_ids, c.time_censor, f.* FROM cohort c JOIN flat f ON f.id_card_num = c.cust_ids
            WHERE f.create_time < c.time_censor) lab
      JOIN (SELECT c.cust_ids, max(f.create_time) AS t0 FROM cohort c JOIN flat f ON f.id_card_num = c.cust_ids
            WHERE f.create_time < c.time_censor GROUP BY c.cust_ids) tm
        ON tm.cust_ids = lab.cust_ids AND lab.create_time = tm.t0) l2
GROUP BY cust_ids""",
)
_PAIRS = [
    ("query_cnt_3m", "query_cnt_3m_2", "query_cnt_3m_1"),
    ("query_cnt_6m", "query_cnt_6m_2", "query_cnt_6m_1"),
    ("query_cnt_12m", "query_cnt_12m_2", "query_cnt_12m_1"),
    ("query_loan_cnt_3m", "query_loan_cnt_3m_2", "query_loan_cnt_3m_1"),
    ("query_loan_cnt_6m", "query_loan_cnt_6m_2", "query_loan_cnt_6m_1"),
    ("query_loan_cnt_12m", "query_loan_cnt_12m_2", "query_loan_cnt_12m_1"),
    ("query_card_cnt_3m", "query_card_cnt_3m_2", "query_card_cnt_3m_1"),
    ("query_card_cnt_12m", "query_card_cnt_12m_2", "query_card_cnt_12m_1"),
    ("query_loanmanage_24m", "query_loanmanage_24m_2", "query_loanmanage_24m_1"),
    ("query_selfquery_1m", "query_selfquery_cnt_1m_2", "query_selfquery_1m_1"),
]
cte(
    "d18",
    ("cohort", "d15", "d17"),
    "SELECT c.cust_ids, c.time_censor, "
    + ", ".join(f"coalesce(g2.{b}, g1.{a}) AS {o}" for o, b, a in _PAIRS)
    + ", g1.uq FROM cohort c LEFT JOIN d15 g1 ON g1.cust_ids = c.cust_ids "
    "LEFT JOIN d17 g2 ON g2.cust_ids = c.cust_ids",
)
cte(
    "d19",
    ("cohort", "in_reports"),
    """SELECT g.cust_ids, max(b.report_sn) AS report_sn, max(g.cert_no) AS cert_no, max(g.time_censor) AS censor,
       max(g.rt) AS report_create_time
FROM (SELECT c.cust_ids, max(r.report_create_time) AS rt, max(r.cert_no) AS cert_no, max(c.time_censor) AS time_censor
      FROM cohort c JOIN (SELECT DISTINCT cert_no, report_create_time FROM in_reports) r ON r.cert_no = c.cust_ids
      WHERE date_trunc('second', r.report_create_time) < date_trunc('second', c.time_censor)
      GROUP BY c.cust_ids) g
JOIN (SELECT DISTINCT cert_no, report_create_time, report_sn FROM in_reports) b
  ON b.cert_no = g.cert_no AND b.report_create_time = g.rt
GROUP BY g.cust_ids""",
)
_EXCL = " AND ".join(f"loan_type <> {_q(t)}" for t in EXCLUDED_LOAN_TYPES)
_SETTLED = _q(SETTLED)
_RECENT = f"""SELECT DISTINCT * FROM (
    SELECT d.cust_ids, cl.loan_id, cl.start_date, cl.org_type, cl.organname, cl.loan_amount, cl.loan_type,
           cl.period, cl.payment_method, cl.end_date, cl.account_status, d.censor,
           date_diff('day', CAST(cl.start_date AS DATE), CAST(cl.end_date AS DATE)) AS loan_days
    FROM d19 d LEFT JOIN (SELECT DISTINCT * FROM in_report_loans) cl ON cl.report_id = d.report_sn) j
  WHERE CAST(start_date AS DATE) >= CAST(censor AS DATE) - {SETTLEMENT_LOOKBACK_DAYS} AND {_EXCL}"""
# Whole periods left of a loan without status that ends after the censor.
_PERIODS_LEFT = (
    "CAST(trunc(CAST(date_diff('day', CAST(censor AS DATE), CAST(end_date AS DATE)) AS DOUBLE)"
    " / nullif(loan_days, 0) * period) AS INTEGER)"
)
cte(
    "d20",
    ("d19", "in_report_loans"),
    f"""SELECT g.cust_ids,
  coalesce(CAST(sn AS DOUBLE) / nullif(CAST(sn + onn AS DOUBLE), 0), 0.0) AS settled_loan_cnt_ratio_1y,
  (samt + coalesce(ramt, 0.0)) / nullif(tamt, 0) AS settled_loan_amount_ratio_1y
FROM (SELECT cust_ids,
        count(DISTINCT CASE WHEN account_status = {_SETTLED} THEN loan_id END) AS sn,
        count(DISTINCT CASE WHEN account_status <> {_SETTLED} THEN loan_id END) AS onn,
        CAST(sum(CASE WHEN account_status = {_SETTLED} THEN loan_amount ELSE 0 END) AS DOUBLE) AS samt,
        CAST(sum(loan_amount) AS DOUBLE) AS tamt
      FROM ({_RECENT}) f GROUP BY cust_ids) g
LEFT JOIN (SELECT cust_ids, sum(amt / period ORDER BY period) AS ramt
           FROM (SELECT cust_ids, period, CAST(sum(loan_amount * {_PERIODS_LEFT}) AS DOUBLE) AS amt
                 FROM ({_RECENT}) f2
                 WHERE account_status IS NULL AND CAST(end_date AS DATE) > CAST(censor AS DATE)
                 GROUP BY cust_ids, period) p
           WHERE period <> 0 AND amt IS NOT NULL GROUP BY cust_ids) r ON r.cust_ids = g.cust_ids""",
)
cte(
    "d21",
    ("d19", "in_report_cards"),
    """SELECT cust_ids, CAST(min(gap) AS INTEGER) AS lag2_loan_card_time_diff_min
FROM (SELECT cust_ids,
        date_diff('day', CAST(lag(start_date, 2) OVER (PARTITION BY cust_ids ORDER BY start_date ASC NULLS FIRST) AS DATE),
                  CAST(start_date AS DATE)) AS gap
      FROM (SELECT DISTINCT d.cust_ids, c.start_date, c.org_type, c.organname, c.card_type, c.guarantee_type,
                   c.deadline, d.censor
            FROM d19 d LEFT JOIN in_report_cards c ON c.report_id = d.report_sn) cards) w
GROUP BY cust_ids""",
)
cte(
    "d22",
    ("cohort", "in_loans", "in_overdue"),
    f"""SELECT c.cust_ids, CAST(max(1.0) AS DOUBLE) AS od10_dummy
FROM cohort c
JOIN (SELECT b.cust_ids, o.t1
      FROM (SELECT DISTINCT loan_no, cust_ids FROM in_loans
            WHERE {VALID_LOAN} AND (partner_no <> '10' OR product_no <> 'RXD' OR quota_type <> '02')) b
      JOIN (SELECT loan_no, date_trunc('day', start_date) AS t1
            FROM (SELECT DISTINCT start_date, loan_no, overdue_days FROM in_overdue) WHERE overdue_days > 3.0) o
        ON o.loan_no = b.loan_no) bb
  ON bb.cust_ids = c.cust_ids
WHERE epoch_us(bb.t1) < epoch_us(c.time_censor) - {3 * DAY_US}
GROUP BY c.cust_ids""",
)
cte(
    "d23",
    ("cohort", "in_loans", "in_overdue"),
    f"""SELECT c.cust_ids, CAST(max(1.0) AS DOUBLE) AS overdue_record_new_dummy
FROM cohort c
JOIN (SELECT b.cust_ids, o.stat_date
      FROM (SELECT DISTINCT loan_no, cust_ids FROM in_loans WHERE {VALID_LOAN}) b
      JOIN (SELECT DISTINCT stat_date, loan_no, overdue_days FROM in_overdue WHERE overdue_days > 0.0) o
        ON o.loan_no = b.loan_no) bb
  ON bb.cust_ids = c.cust_ids
WHERE bb.stat_date < CAST(c.time_censor AS DATE)
GROUP BY c.cust_ids""",
)
cte(
    "d24",
    ("cohort", "in_loans"),
    f"""SELECT b2.cust_ids, CAST(b2.cnt AS DOUBLE) AS all_xfd_loan_cnt, CAST(x.loan_amount AS DOUBLE) AS last_apply_amount,
       CAST(x.loan_rate AS DOUBLE) AS last_apply_rate, CAST(x.loan_term AS DOUBLE) AS last_apply_term
FROM (SELECT c.cust_ids, count(*) AS cnt, max(x.loan_time) AS last_t
      FROM cohort c JOIN (SELECT DISTINCT loan_no AS ln, cust_ids, loan_time, loan_term, loan_rate, loan_amount
                          FROM in_loans WHERE {VALID_LOAN} AND {XFD}) x ON x.cust_ids = c.cust_ids
      WHERE x.loan_time < c.time_censor GROUP BY c.cust_ids) b2
JOIN (SELECT DISTINCT loan_no AS ln, cust_ids, loan_time, loan_term, loan_rate, loan_amount
      FROM in_loans WHERE {VALID_LOAN} AND {XFD}) x
  ON x.cust_ids = b2.cust_ids AND x.loan_time = b2.last_t""",
)
cte(
    "d25",
    ("cohort", "d5", "d6", "d7", "d8", "d10", "d18", "d12", "d20", "d21", "d9", "d22", "d23", "d24"),
    f"""SELECT c.cust_ids, c.time_censor, {_days("c.time_censor")} AS t0,
  d5.* EXCLUDE (cust_ids), CAST(d6.merchant_order_cnt AS DOUBLE) AS merchant_order_cnt,
  d6.* EXCLUDE (cust_ids, merchant_order_cnt), d7.* EXCLUDE (cust_ids), d8.* EXCLUDE (cust_ids),
  d10.* EXCLUDE (cust_ids), d18.* EXCLUDE (cust_ids, time_censor), d12.* EXCLUDE (cust_ids, xfd_p_pay_sum),
  d20.* EXCLUDE (cust_ids), d21.* EXCLUDE (cust_ids), d9.* EXCLUDE (cust_ids), d22.* EXCLUDE (cust_ids),
  d23.* EXCLUDE (cust_ids), d24.* EXCLUDE (cust_ids, all_xfd_loan_cnt),
  coalesce(d24.all_xfd_loan_cnt + 1.0, 1.0) AS all_xfd_loan_cnt
FROM cohort c
LEFT JOIN d5 ON d5.cust_ids = c.cust_ids LEFT JOIN d6 ON d6.cust_ids = c.cust_ids
LEFT JOIN d7 ON d7.cust_ids = c.cust_ids LEFT JOIN d8 ON d8.cust_ids = c.cust_ids
LEFT JOIN d10 ON d10.cust_ids = c.cust_ids LEFT JOIN d18 ON d18.cust_ids = c.cust_ids
LEFT JOIN d12 ON d12.cust_ids = c.cust_ids LEFT JOIN d20 ON d20.cust_ids = c.cust_ids
LEFT JOIN d21 ON d21.cust_ids = c.cust_ids LEFT JOIN d9 ON d9.cust_ids = c.cust_ids
LEFT JOIN d22 ON d22.cust_ids = c.cust_ids LEFT JOIN d23 ON d23.cust_ids = c.cust_ids
LEFT JOIN d24 ON d24.cust_ids = c.cust_ids""",
)
cte(
    "d26",
    ("d25", "d13"),
    """SELECT f.* EXCLUDE (uq, t0, lag2_loan_card_time_diff_min, query_loanmanage_24m, query_selfquery_1m),
  CAST(f.lag2_loan_card_time_diff_min AS DOUBLE) AS lag2_loan_card_time_diff_min,
  TRY_CAST(f.query_loanmanage_24m AS DOUBLE) AS query_loanmanage_24m,
  TRY_CAST(f.query_selfquery_1m AS DOUBLE) AS query_selfquery_1m,
  d13.* EXCLUDE (cust_ids),
  CAST(CAST(trunc(f.t0) AS INTEGER) % 7 AS DOUBLE) AS dow,
  TRY_CAST(substr(f.cust_ids, 1, 17) AS DOUBLE) AS id_num,
  TRY_CAST(substr(f.cust_ids, 3, 2) AS DOUBLE) AS id_head_1,
  CAST(hour(f.time_censor) AS DOUBLE) AS hr,
  TRY_CAST(substr(f.cust_ids, 7, 4) AS DOUBLE) * (-1.0) + CAST(year(f.time_censor) AS DOUBLE) AS age,
  f.xfd_good_cnt / nullif(f.all_xfd_loan_cnt + 0.0, 0) AS good_ratio,
  f.xfd_bad_cnt / nullif(f.all_xfd_loan_cnt + 0.0, 0) AS bad_ratio
FROM d25 f LEFT JOIN d13 ON d13.cust_ids = f.cust_ids""",
)
cte(
    "d27",
    ("d26", "in_loans"),
    f"""SELECT f.*, b.loan_no, b.loan_apply_amount, b.loan_apply_rate, b.loan_apply_term, b.loan_apply_time
FROM d26 f LEFT JOIN (SELECT cust_ids, loan_no, CAST(loan_amount AS DOUBLE) AS loan_apply_amount,
                             CAST(NULL AS DOUBLE) AS loan_apply_rate, CAST(loan_term AS DOUBLE) AS loan_apply_term,
                             loan_time AS loan_apply_time
                      FROM in_loans WHERE {XFD}) b ON b.cust_ids = f.cust_ids""",
)
def _age(grant: str, censor: str) -> str:
    return f"CASE WHEN {grant} < {censor} THEN {_days(censor)} - {_days(grant)} END"


cte(
    "d28",
    ("d26", "in_credits_alt", "in_credits"),
    f"""SELECT x.* EXCLUDE (credit_date, first_grant, credit_age0),
  coalesce(x.credit_age0, {_age("x.first_grant", "x.time_censor")}) AS credit_age
FROM (SELECT d.*, a.* EXCLUDE (card_no), {_age("a.credit_date", "d.time_censor")} AS credit_age0, s1.first_grant
      FROM d26 d
      LEFT JOIN (SELECT DISTINCT * FROM in_credits_alt) a ON a.card_no = d.cust_ids
      LEFT JOIN (SELECT card_no, min(credit_date) AS first_grant
                 FROM (SELECT DISTINCT card_no, credit_date FROM in_credits) WHERE length(card_no) = 18
                 GROUP BY card_no) s1 ON s1.card_no = d.cust_ids) x""",
)

# query name -> final CTE (or SELECT) to run
QUERY_CTE = {
    "cohort_censor": "cohort",
    "account_link": "accounts",
    "device_events_asof": "events_asof",
    "order_payments_asof": "payments",
    "credit_pay_ratios": "d5",
    "spend_summary": "d6",
    "event_code_rates": "d7",
    "device_burst_7d": "d8",
    "monthly_device_city_peak": "d9",
    "loan_history_counts": "d10",
    "repaid_by_censor": "d11",
    "principal_pay_ratio": "d12",
    "repay_outcome_rates": "d13",
    "latest_report": "d14",
    "query_counts_gen1": "d15",
    "report_flatten": "flat",
    "query_counts_gen2": "d17",
    "generation_merge": "d18",
    "latest_report_normalised": "d19",
    "loan_settlement_ratios": "d20",
    "min_gap_lag2": "d21",
    "overdue_flag_strict": "d22",
    "overdue_flag_any": "d23",
    "last_loan_profile": "d24",
    "feature_assembly": "d25",
    "derived_features": "d26",
    "attach_applications": "d27",
    "credit_age": "d28",
}

# Final projections where the oracle's CTE differs in presentation only.
FINAL_SELECT = {
    "payments": "SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount FROM payments",
}


def _ordered(name: str) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        if n.startswith("in_"):
            seen.append(n)
            return
        deps, _ = CTES[n]
        for d in deps:
            visit(d)
        seen.append(n)

    visit(name)
    return seen


def sql_for(query: str) -> str:
    target = QUERY_CTE[query]
    parts = []
    for n in _ordered(target):
        if n.startswith("in_"):
            parts.append(fixture.duckdb_ctes(n[3:]))
        else:
            parts.append(f"{n} AS (\n{CTES[n][1]}\n)")
    final = FINAL_SELECT.get(target, f"SELECT * FROM {target}")
    return "WITH " + ",\n".join(parts) + "\n" + final


# Several censors a customer: one run per censor, for the customers that have it.
CENSORS = (
    ("1999-01-20 10:30:00", "true"),
    ("1998-03-01 00:00:00", "CAST(substr(cust_ids, 18, 1) AS INTEGER) % 2 = 0"),
    ("1996-02-29 12:00:00", "CAST(substr(cust_ids, 18, 1) AS INTEGER) % 3 = 1"),
)


def at_censors(query: str) -> str:
    runs = []
    for time, who in CENSORS:
        run = sql_for(query).replace(C, f"TIMESTAMP '{time}'")
        runs.append(f"SELECT *, TIMESTAMP '{time}' AS time_censor FROM ({run}) WHERE {who}")
    return "\nUNION ALL\n".join(runs)


PARSE_REPORT = """
SELECT 'device_events' AS input, 'pay_time' AS "column", 'instant' AS kind, 'string' AS stored,
  count(*) AS given, count(*) FILTER (event_id % 50 = 0) AS unparsed FROM events
UNION ALL SELECT 'repayments', 'principal', 'money', 'string', count(*), count(*) FILTER (l_linenumber = 4) FROM lineitem
UNION ALL SELECT 'repayments', 'apply_time', 'instant', 'string', count(*) FILTER (l_suppkey % 10 <> 4), count(*) FILTER (l_suppkey % 10 = 3) FROM lineitem
UNION ALL SELECT 'overdue', 'stat_date', 'day8', 'int', count(*), count(*) FILTER (l_linenumber = 3) FROM lineitem
"""


def oracle_sql() -> dict[str, str]:
    added = {f"{q}_at_censors": at_censors(q) for q in ("event_code_rates", "spend_summary", "credit_pay_ratios", "repay_outcome_rates")}
    added |= {"loan_history_by_days": sql_for("loan_history_counts"), "input_parse_report": PARSE_REPORT}
    return {q: sql_for(q) for q in QUERY_CTE} | added
