"""Adapters from the generated test tables to the job's logical inputs.

The test data is a TPC-H-like star (customer, orders, lineitem, events,
...). Each logical input is a projection of one of those tables, written as
SQL expressions. The same text runs in
Spark (``selectExpr``) and in the DuckDB oracle, with a per-engine variant
where the dialects differ, so an oracle checks the feature logic against
exactly the inputs Spark saw. The expressions already produce the conformed
types (timestamps, ``decimal(18,2)`` money), so conforming is a no-op.

Mapping in short:

* customers get an 18-character id; two in five get a short (invalid) card
  number instead, so the cohort is a real subset;
* a customer's accounts are ``62`` + order-priority digit + padded key;
  priority 4 makes a 17-character (invalid) account and priority 5 none;
* orders are merchant orders, loans, bureau reports and gen-2 documents;
  lineitems are payment lines, repayments, overdue records, bureau
  enquiries, bureau loans and cards;
* events (January 2024) are device events moved back by ``EVENT_SHIFT_DAYS``
  so the one censor time (1999-01-20 10:30, mid-month and not at midnight)
  cuts through them too; a user has 1 to 6 devices, by user id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitwise.sources.inputs import Inputs

CENSOR = "1999-01-20 10:30:00"
# 2024-01-20 minus this many days is 1999-01-20: the censor cuts the events
# where it cuts the orders.
EVENT_SHIFT_DAYS = 9131
# Order totals in the test data run to 500,000; the cap keeps most of them.
AMOUNT_CAP = 400_000
GEN2_MIN_CREATE = "1996-01-01"
# Two thirds of the events are moved back by a month or two more, so device
# peaks have several calendar months to choose from.
LOAN_USE_PERIOD = "month"

RAW_TABLES = ("customer", "orders", "lineitem", "events")


def _id18(k: str) -> str:
    """18-character id: 2 + 4 region digits, 4-digit birth year, 8-digit key."""
    return (
        f"concat('11', lpad(cast({k} % 97 as string), 4, '0'), "
        f"cast(1950 + {k} % 50 as string), lpad(cast({k} as string), 8, '0'))"
    )


def _id18_spark(k: str) -> str:
    """``_id18`` of a key of up to 8 digits as one number, which is read once; of others as it is."""
    number = f"110000000000000000 + {k} % 97 * 1000000000000 + (1950 + {k} % 50) * 100000000 + {k}"
    return f"CASE WHEN {k} BETWEEN 0 AND 99999999 THEN cast({number} as string) ELSE {_id18(k)} END"


def _id18_column(alias: str, k: str) -> tuple[str, str, str]:
    return alias, _id18_spark(k), _id18(k)


def _account(k: str, prio: str) -> str:
    return (
        f"CASE WHEN {prio} = '5-LOW' THEN NULL "
        f"WHEN {prio} = '4-NOT SPECIFIED' THEN concat('6', lpad(cast({k} as string), 16, '0')) "
        f"ELSE concat('62', substr({prio}, 1, 1), lpad(cast({k} as string), 16, '0')) END"
    )


def _report_id(k: str) -> str:
    return f"lpad(cast({k} as string), 12, '0')"


def _ts(c: str) -> str:
    return f"cast({c} as timestamp)"


def _money(c: str) -> str:
    return f"cast({c} as decimal(18,2))"


@dataclass(frozen=True)
class Adapter:
    logical: str
    source: str
    # (alias, expression) or (alias, spark expression, duckdb expression)
    columns: tuple

    def _exprs(self, engine: str) -> list[str]:
        out = []
        for item in self.columns:
            alias, expr = item[0], item[1]
            if len(item) == 3 and engine == "duckdb":
                expr = item[2]
            out.append(f"{expr} AS {alias}")
        return out

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.read.parquet(f"{sf_dir}/{self.source}.parquet")
        return df.selectExpr(*self._exprs("spark"))

    def duckdb_cte(self) -> str:
        cols = ", ".join(self._exprs("duckdb"))
        return f"in_{self.logical} AS (SELECT {cols} FROM {self.source})"


_ORDER_KEY = "cast(o_orderkey as string)"

ADAPTERS = {
    a.logical: a
    for a in (
        Adapter(
            "credits",
            "orders",
            (
                (
                    "card_no",
                    f"CASE WHEN o_custkey % 5 < 2 THEN cast(o_custkey as string) ELSE {_id18_spark('o_custkey')} END",
                    f"CASE WHEN o_custkey % 5 < 2 THEN cast(o_custkey as string) ELSE {_id18('o_custkey')} END",
                ),
                ("credit_date", _ts("o_orderdate")),
            ),
        ),
        Adapter(
            "credits_alt",
            "customer",
            (
                (
                    "card_no",
                    f"CASE WHEN c_acctbal > 5000 THEN {_id18_spark('c_custkey')} END",
                    f"CASE WHEN c_acctbal > 5000 THEN {_id18('c_custkey')} END",
                ),
                ("credit_date", "cast(date '1996-01-01' + cast(c_custkey % 1500 as int) as timestamp)"),
                ("credit_quota", "c_acctbal"),
            ),
        ),
        Adapter(
            "members",
            "orders",
            (_id18_column("id_card", "o_custkey"), ("acct_no", _account("o_custkey", "o_orderpriority"))),
        ),
        Adapter(
            "device_events",
            "events",
            (
                (
                    "account_no",
                    "concat('62', cast(1 + event_id % 4 as string), lpad(cast(user_id as string), 16, '0'))",
                ),
                (
                    "pay_time",
                    f"cast(ts as timestamp) - INTERVAL {EVENT_SHIFT_DAYS} DAY - (event_id % 3) * INTERVAL 30 DAY",
                ),
                (
                    "event_code",
                    "CASE WHEN user_id % 2 = event_id % 2 THEN CASE event_type WHEN 'view' THEN 'LOGIN_POST' "
                    "WHEN 'click' THEN 'E0418' WHEN 'purchase' THEN 'E0406' WHEN 'error' THEN 'E0906' "
                    "WHEN 'signup' THEN 'E0506' END ELSE CASE event_type WHEN 'view' THEN 'E0129' "
                    "WHEN 'click' THEN 'E0428' WHEN 'purchase' THEN 'E0424' WHEN 'error' THEN 'E0425' "
                    "WHEN 'signup' THEN 'E0434' END END",
                ),
                (
                    "device_id",
                    "CASE WHEN value > 20 THEN concat('dev', "
                    "cast(cast(get_json_object(props, '$.k') as int) % (1 + user_id % 6) as string)) END",
                    "CASE WHEN value > 20 THEN concat('dev', "
                    "cast(cast(json_extract_string(props, '$.k') as int) % (1 + user_id % 6) as string)) END",
                ),
                ("city", "concat('city', cast(cast(floor(value / 50) as bigint) as string))"),
                ("pay_order_no", "concat('P', cast(event_id as string))"),
            ),
        ),
        Adapter(
            "orders",
            "orders",
            (
                ("buyer_user_no", _account("o_custkey", "o_orderpriority")),
                ("merchant_order_id", _ORDER_KEY),
                ("amount", _money("o_totalprice")),
                ("pay_time", _ts("o_orderdate")),
                ("pay_order_id", "concat('P', cast(o_orderkey as string))"),
            ),
        ),
        Adapter(
            "order_lines",
            "lineitem",
            (
                ("merchant_order_id", "cast(l_orderkey as string)"),
                (
                    "pay_channel_name",
                    "CASE WHEN l_returnflag = 'R' THEN concat('任性贷-', l_linestatus) "
                    "ELSE concat('bank-', l_returnflag) END",
                ),
                ("pay_type", "CASE WHEN l_linestatus = 'F' THEN 'CREDIT_PAY' ELSE 'QUICK_PAY' END"),
            ),
        ),
        Adapter(
            "loans",
            "orders",
            (
                ("loan_no", _ORDER_KEY),
                _id18_column("cust_ids", "o_custkey"),
                ("loan_time", _ts("o_orderdate")),
                ("loan_amount", f"CASE WHEN o_custkey % 11 > 0 THEN {_money('o_totalprice')} END"),
                ("loan_term", "cast(3 * (1 + o_orderkey % 4) as double)"),
                ("loan_rate", "cast(5 + o_orderkey % 10 as double) / 100"),
                ("partner_no", "CASE WHEN o_orderstatus = 'F' THEN '10' ELSE '20' END"),
                ("product_no", "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'RXD' ELSE 'CASH' END"),
                ("quota_type", "CASE WHEN o_orderkey % 3 = 0 THEN '01' ELSE '02' END"),
            ),
        ),
        Adapter(
            "overdue",
            "lineitem",
            (
                ("loan_no", "CASE WHEN l_returnflag = 'R' THEN cast(l_orderkey as string) END"),
                ("start_date", _ts("l_shipdate")),
                (
                    "stat_date",
                    "cast(cast(l_shipdate as date) + 3 as date)",
                ),
                ("overdue_days", "l_quantity - 45"),
            ),
        ),
        Adapter(
            "repayments",
            "lineitem",
            (
                ("loan_no", "cast(l_orderkey as string)"),
                ("principal", _money("l_extendedprice")),
                ("interest", _money("l_tax * 100")),
                ("status", "CASE WHEN l_linestatus = 'F' THEN '200' ELSE '500' END"),
                ("apply_time", _ts("l_shipdate")),
                ("debit_time", _ts("l_shipdate")),
            ),
        ),
        Adapter(
            "reports",
            "orders",
            (
                ("report_sn", _report_id("o_orderkey")),
                _id18_column("cert_no", "o_custkey"),
                ("report_create_time", _ts("date_trunc('month', o_orderdate)")),
            ),
        ),
        Adapter(
            "report_queries",
            "lineitem",
            (
                ("report_id", _report_id("l_orderkey")),
                ("querydate", _ts("l_shipdate")),
                (
                    "queryreason",
                    "CASE l_returnflag WHEN 'A' THEN '贷款审批' WHEN 'R' THEN '信用卡审批' ELSE 'self-check' END",
                ),
            ),
        ),
        Adapter(
            "report_summary",
            "lineitem",
            (
                ("report_id", _report_id("l_orderkey")),
                ("lastmonthquery_selfquery", "cast(l_quantity as bigint) % 4"),
                ("last2yearquery_loanmanage", "l_suppkey % 9"),
            ),
        ),
        Adapter(
            "report_loans",
            "lineitem",
            (
                ("report_id", _report_id("l_orderkey")),
                ("loan_id", "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))"),
                ("start_date", _ts("l_shipdate")),
                ("end_date", "cast(cast(l_shipdate as date) + cast(30 * l_quantity as int) as timestamp)"),
                ("org_type", "'bank'"),
                ("organname", "concat('org', cast(l_suppkey as string))"),
                ("loan_amount", _money("l_quantity * 1000")),
                (
                    "loan_type",
                    "CASE WHEN l_returnflag = 'N' THEN '个人住房贷款' ELSE '个人消费贷款' END",
                ),
                ("period", "l_quantity"),
                ("payment_method", "l_linestatus"),
                (
                    "account_status",
                    "CASE WHEN l_linestatus = 'F' THEN '结清' WHEN l_tax > 0.04 THEN NULL ELSE '正常' END",
                ),
            ),
        ),
        Adapter(
            "report_cards",
            "lineitem",
            (
                ("report_id", _report_id("l_orderkey")),
                ("start_date", _ts("l_shipdate")),
                ("org_type", "l_returnflag"),
                ("organname", "concat('org', cast(l_suppkey % 20 as string))"),
                ("card_type", "l_linestatus"),
                ("guarantee_type", "cast(l_linenumber % 3 as string)"),
                ("deadline", "cast(cast(l_quantity as bigint) as string)"),
            ),
        ),
        Adapter(
            "doc",
            "orders",
            (
                ("id", _ORDER_KEY),
                ("report_code", "concat('R', cast(o_orderkey as string))"),
                ("create_time", _ts("o_orderdate")),
            ),
        ),
        Adapter("pqo", "orders", (("id", "concat('Q', cast(o_orderkey as string))"), ("doc_id", _ORDER_KEY))),
        # A document has up to two summaries: its first two lines.
        Adapter(
            "pqo_pc05",
            "lineitem",
            (
                ("id", "concat('C', cast(l_orderkey as string), '-', cast(l_linenumber as string))"),
                ("pqo_id", "CASE WHEN l_linenumber <= 2 THEN concat('Q', cast(l_orderkey as string)) END"),
            ),
        ),
        Adapter(
            "pc05a",
            "orders",
            (
                ("id", "concat('A', cast(o_orderkey as string))"),
                ("pqo_pc05_id", "concat('C', cast(o_orderkey as string), '-1')"),
                ("pc05aq01", "o_orderpriority"),
                ("pc05ar01", _ts("o_orderdate")),
                ("pc05ad01", "o_orderstatus"),
                ("pc05ai01", "cast(o_custkey % 50 as string)"),
            ),
        ),
        Adapter(
            "pc05b",
            "lineitem",
            (
                ("id", "concat('B', cast(l_orderkey as string), '-', cast(l_linenumber as string))"),
                ("pqo_pc05_id", "concat('C', cast(l_orderkey as string), '-', cast(l_linenumber as string))"),
                ("pc05bs01", "l_orderkey % 3"),
                ("pc05bs02", "l_orderkey % 4"),
                ("pc05bs03", "l_suppkey % 5"),
                ("pc05bs04", "l_suppkey % 6"),
                ("pc05bs05", "l_partkey % 5"),
                ("pc05bs06", "l_partkey % 11"),
            ),
        ),
        Adapter("poq", "orders", (("id", "concat('P', cast(o_orderkey as string))"), ("doc_id", _ORDER_KEY))),
        Adapter(
            "poq_ph01",
            "lineitem",
            (
                ("poq_id", "concat('P', cast(l_orderkey as string))"),
                ("ph010r01", _ts("l_shipdate")),
                ("ph010d01", "l_returnflag"),
                ("ph010q02", "concat('org', cast(l_suppkey % 10 as string))"),
                (
                    "ph010q03",
                    "CASE l_returnflag WHEN 'A' THEN '02' WHEN 'R' THEN '3' ELSE concat('x', l_linestatus) END",
                ),
            ),
        ),
        Adapter("prh", "orders", (("id", "concat('H', cast(o_orderkey as string))"), ("doc_id", _ORDER_KEY))),
        Adapter(
            "prh_pa01",
            "orders",
            (
                ("id", "concat('U', cast(o_orderkey as string))"),
                ("prh_id", "concat('H', cast(o_orderkey as string))"),
            ),
        ),
        Adapter(
            "prh_pa01b",
            "orders",
            (
                ("prh_pa01_id", "concat('U', cast(o_orderkey as string))"),
                ("pa01bq01", "concat('Customer#', lpad(cast(o_custkey as string), 9, '0'))"),
                ("pa01bd01", "'10'"),
                _id18_column("pa01bi01", "o_custkey"),
                ("pa01bi02", "concat('Q', cast(o_custkey % 25 as string))"),
                ("pa01bd02", "'01'"),
            ),
        ),
    )
}


def fixture_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Logical inputs built from the test tables under ``sf_dir``."""
    return Inputs({name: (lambda a=a: a.spark(spark, sf_dir)) for name, a in ADAPTERS.items()})


# Inputs as a source might store them: times, days and money as text or
# numbers, of which some are malformed (the report of ``sources.audit``).
TEXT_INPUTS = {
    "device_events": (
        "events",
        (
            "CASE WHEN event_id % 50 = 0 THEN 'n/a' WHEN event_id % 7 = 0 THEN date_format(ts, 'yyyy.MM.dd HH:mm:ss') "
            "ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss') END AS pay_time",
        ),
    ),
    "repayments": (
        "lineitem",
        (
            "CASE WHEN l_linenumber = 4 THEN concat(cast(l_extendedprice as string), ' yuan') "
            "ELSE cast(cast(l_extendedprice as decimal(18,2)) as string) END AS principal",
            "CASE WHEN l_suppkey % 10 = 3 THEN '1997-13-45' WHEN l_suppkey % 10 = 4 THEN NULL "
            "ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS APPLY_TIME",
        ),
    ),
    "overdue": (
        "lineitem",
        ("CASE WHEN l_linenumber = 3 THEN 19991399 ELSE cast(date_format(l_shipdate, 'yyyyMMdd') as int) END AS stat_date",),
    ),
}


def text_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Some inputs of the test tables, stored as text."""
    read = lambda source, columns: spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*columns)
    return Inputs({name: (lambda t=t: read(*t)) for name, t in TEXT_INPUTS.items()})


def duckdb_ctes(*names: str) -> str:
    """``WITH`` body defining ``in_<name>`` for each named input over the raw views."""
    return ",\n".join(ADAPTERS[n].duckdb_cte() for n in names)
