"""Logical inputs of the feature job and their edge conversion.

Each input is named by the columns the features read. ``conform`` selects
those columns (case-insensitively, as Spark resolves names), parses times to
``timestamp`` and money to ``decimal(18,2)`` once, so every operator sees
typed values. Extra columns are dropped unless the spec keeps them, which
also lets Catalyst prune them from the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwise.functions.time import as_compact_day, as_instant

MONEY = "decimal(18,2)"


@dataclass(frozen=True)
class Spec:
    name: str
    columns: dict[str, str] = field(default_factory=dict)
    keep_extra: bool = False


def _money(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return c.try_cast(MONEY)
    return c.cast(MONEY)


def typed(df: DataFrame, name: str, kind: str) -> Column:
    """Stored column ``name`` as ``kind``; null where it does not parse."""
    if kind == "str":
        return F.col(name).cast("string")
    if kind == "instant":
        return as_instant(df, name)
    if kind == "day8":
        return as_compact_day(df, name)
    if kind == "money":
        return _money(df, name)
    if kind == "double":
        return F.col(name).try_cast("double")
    if kind == "any":
        return F.col(name)
    raise ValueError(f"unknown column kind {kind!r}")


def conform(df: DataFrame, spec: Spec) -> DataFrame:
    """Typed projection of ``df`` onto ``spec``; raises on a missing column."""
    by_lower = {f.name.lower(): f.name for f in df.schema.fields}
    missing = [c for c in spec.columns if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"input {spec.name!r} lacks columns {missing}")
    out = []
    for col_name, kind in spec.columns.items():
        actual = by_lower[col_name.lower()]
        out.append(typed(df, actual, kind).alias(col_name))
    if spec.keep_extra:
        wanted = {c.lower() for c in spec.columns}
        out.extend(F.col(f.name) for f in df.schema.fields if f.name.lower() not in wanted)
    return df.select(*out)


CREDITS = Spec("credits", {"card_no": "str", "credit_date": "instant"})
# The second copy of the credit grants is read whole: its other columns
# travel into the final table.
CREDITS_ALT = Spec("credits_alt", {"card_no": "str", "credit_date": "instant"}, keep_extra=True)
MEMBERS = Spec("members", {"id_card": "str", "acct_no": "str"})
DEVICE_EVENTS = Spec(
    "device_events",
    {
        "account_no": "str",
        "pay_time": "instant",
        "event_code": "str",
        "device_id": "str",
        "city": "str",
        "pay_order_no": "str",
    },
)
ORDERS = Spec(
    "orders",
    {
        "buyer_user_no": "str",
        "merchant_order_id": "str",
        "amount": "money",
        "pay_time": "instant",
        "pay_order_id": "str",
    },
)
ORDER_LINES = Spec(
    "order_lines",
    {"merchant_order_id": "str", "pay_channel_name": "str", "pay_type": "str"},
)
LOANS = Spec(
    "loans",
    {
        "loan_no": "str",
        "cust_ids": "str",
        "loan_time": "instant",
        "loan_amount": "money",
        "loan_term": "double",
        "loan_rate": "double",
        "partner_no": "str",
        "product_no": "str",
        "quota_type": "str",
    },
)
OVERDUE = Spec(
    "overdue",
    {"loan_no": "str", "start_date": "instant", "stat_date": "day8", "overdue_days": "double"},
)
REPAYMENTS = Spec(
    "repayments",
    {
        "loan_no": "str",
        "principal": "money",
        "interest": "money",
        "status": "str",
        "apply_time": "instant",
        "debit_time": "instant",
    },
)
REPORTS = Spec("reports", {"report_sn": "str", "cert_no": "str", "report_create_time": "instant"})
REPORT_QUERIES = Spec("report_queries", {"report_id": "str", "querydate": "instant", "queryreason": "str"})
REPORT_SUMMARY = Spec(
    "report_summary",
    {"report_id": "str", "lastmonthquery_selfquery": "any", "last2yearquery_loanmanage": "any"},
)
REPORT_LOANS = Spec(
    "report_loans",
    {
        "report_id": "str",
        "loan_id": "str",
        "start_date": "instant",
        "end_date": "instant",
        "org_type": "str",
        "organname": "str",
        "loan_amount": "money",
        "loan_type": "str",
        "period": "double",
        "payment_method": "str",
        "account_status": "str",
    },
)
REPORT_CARDS = Spec(
    "report_cards",
    {
        "report_id": "str",
        "start_date": "instant",
        "org_type": "str",
        "organname": "str",
        "card_type": "str",
        "guarantee_type": "str",
        "deadline": "str",
    },
)

# Second-generation bureau report: a document tree over ten tables.
DOC = Spec("doc", {"id": "str", "report_code": "str", "create_time": "instant"})
PQO = Spec("pqo", {"id": "str", "doc_id": "str"})
PQO_PC05 = Spec("pqo_pc05", {"id": "str", "pqo_id": "str"})
PC05A = Spec(
    "pc05a",
    {
        "id": "str",
        "pqo_pc05_id": "str",
        "pc05aq01": "str",
        "pc05ar01": "any",
        "pc05ad01": "str",
        "pc05ai01": "str",
    },
)
PC05B = Spec(
    "pc05b",
    {
        "id": "str",
        "pqo_pc05_id": "str",
        "pc05bs01": "any",
        "pc05bs02": "any",
        "pc05bs03": "any",
        "pc05bs04": "any",
        "pc05bs05": "any",
        "pc05bs06": "any",
    },
)
POQ = Spec("poq", {"id": "str", "doc_id": "str"})
POQ_PH01 = Spec(
    "poq_ph01",
    {"poq_id": "str", "ph010r01": "instant", "ph010d01": "str", "ph010q02": "str", "ph010q03": "str"},
)
PRH = Spec("prh", {"id": "str", "doc_id": "str"})
PRH_PA01 = Spec("prh_pa01", {"id": "str", "prh_id": "str"})
PRH_PA01B = Spec(
    "prh_pa01b",
    {
        "prh_pa01_id": "str",
        "pa01bq01": "str",
        "pa01bd01": "str",
        "pa01bi01": "str",
        "pa01bi02": "str",
        "pa01bd02": "str",
    },
)

ALL_SPECS = (
    CREDITS,
    CREDITS_ALT,
    MEMBERS,
    DEVICE_EVENTS,
    ORDERS,
    ORDER_LINES,
    LOANS,
    OVERDUE,
    REPAYMENTS,
    REPORTS,
    REPORT_QUERIES,
    REPORT_SUMMARY,
    REPORT_LOANS,
    REPORT_CARDS,
    DOC,
    PQO,
    PQO_PC05,
    PC05A,
    PC05B,
    POQ,
    POQ_PH01,
    PRH,
    PRH_PA01,
    PRH_PA01B,
)
SPECS = {s.name: s for s in ALL_SPECS}
