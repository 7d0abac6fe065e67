"""Credit-bureau report features.

Latest-report choices are aggregates of ``max(struct(time, serial))``:
distributive, combined map-side, one pass, no window over a customer's
reports. Counting features aggregate the child rows per report before the
join that brings in the report's customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwise.functions import codes
from pitwise.functions.exprs import flag_sum, no_money, not_equal_all, ratio
from pitwise.functions.joins import heavy_keys, left_join_many, looked_up
from pitwise.functions.time import as_datetime, instant_literal
from pitwise.operators.asof import Censor


#: The flattened report's columns by branch of the tree.
IDENTITY_COLUMNS = ("name", "id_type", "id_card_num", "query_ord_code", "query_reason_code")
ENQUIRY_COLUMNS = ("query_date", "management_org_type", "query_org", "query_reason")
SUMMARY_COLUMNS = (
    "last_query_reason",
    "last_query_date",
    "last_query_org",
    "last_query_org_code",
    "query_loan_org_cnt_1m",
    "query_card_org_cnt_1m",
    "query_loan_cnt_1m",
    "query_card_cnt_1m",
    "query_selfquery_cnt_1m",
    "query_loanmanage_24m",
)

GEN1_COLUMNS = (
    "query_cnt_3m",
    "query_cnt_6m",
    "query_cnt_12m",
    "query_loan_cnt_3m",
    "query_loan_cnt_6m",
    "query_loan_cnt_12m",
    "query_card_cnt_3m",
    "query_card_cnt_12m",
)


def _window_specs(reason_col: Column, loan: Column, card: Column, windows: tuple[int, int, int]):
    """(name, condition-on-no_days-and-reason) for the eight query counts."""
    w3, w6, w12 = windows
    nd = F.col("no_days")
    return (
        ("query_cnt_3m", nd <= w3),
        ("query_cnt_6m", nd <= w6),
        ("query_cnt_12m", nd <= w12),
        ("query_loan_cnt_3m", (nd <= w3) & (reason_col == loan)),
        ("query_loan_cnt_6m", (nd <= w6) & (reason_col == loan)),
        ("query_loan_cnt_12m", (nd <= w12) & (reason_col == loan)),
        ("query_card_cnt_3m", (nd <= w3) & (reason_col == card)),
        ("query_card_cnt_12m", (nd <= w12) & (reason_col == card)),
    )


# --- D14 -------------------------------------------------------------------


def latest_report(cohort: DataFrame, reports: DataFrame, censor: Censor = None) -> DataFrame:
    """A customer's latest report created before the censor; among
    reports of that time the largest serial. Customers whose latest reports
    all lack a serial get no row.

    Output: ``cust_ids, cert_no, report_sn, report_create_time``.
    """
    r = reports.select("report_sn", "cert_no", "report_create_time")
    if censor is not None:
        r = r.filter(F.col("report_create_time") < instant_literal(censor))
    j = cohort.select("cust_ids", "time_censor").join(
        r,
        F.col("cust_ids") == F.col("cert_no"),
        "inner",
    ).filter(F.col("report_create_time") < F.col("time_censor"))
    best = j.groupBy("cust_ids").agg(F.max(F.struct("report_create_time", "report_sn")).alias("b"))
    return best.filter(F.col("b.report_sn").isNotNull()).select(
        "cust_ids",
        F.col("cust_ids").alias("cert_no"),
        F.col("b.report_sn").alias("report_sn"),
        F.col("b.report_create_time").alias("report_create_time"),
    )


# --- D15 -------------------------------------------------------------------


def query_counts_gen1(
    latest: DataFrame,
    queries: DataFrame,
    summary: DataFrame,
    windows: tuple[int, int, int] = codes.QUERY_WINDOWS,
) -> DataFrame:
    """Enquiries on the latest gen-1 report within 90/180/365 days
    before it (no lower bound: later enquiries count too), in total, for
    loan approval and for card approval; summary maxima and ``uq``, the
    number of distinct self-query summary values.

    Every enquiry row counts once per distinct summary row of the report
    (the definition joins the two). That product is computed, not
    materialised: a report's enquiries are counted and multiplied by its
    summary row count. Enquiries and summaries of other reports go at the
    join, before anything is counted.
    """
    rep = latest.select("cust_ids", "report_sn", F.to_date("report_create_time").alias("report_day"))
    q = queries.select("report_id", F.to_date("querydate").alias("qday"), "queryreason")
    j = q.join(looked_up(rep), rep["report_sn"] == q["report_id"], "inner").withColumn(
        "no_days", F.datediff("report_day", "qday")
    )
    specs = _window_specs(F.col("queryreason"), F.lit(codes.REASON_LOAN), F.lit(codes.REASON_CARD), windows)
    # Inner join then aggregate (a report with very many enquiries stays
    # splittable); reports without enquiries count 0 after the left join.
    sums = j.groupBy("cust_ids").agg(
        *[F.count(F.when(cond, F.lit(1))).alias(name) for name, cond in specs]
    )
    counts = rep.select("cust_ids", "report_sn").join(sums, "cust_ids", "left")
    own = latest.select(F.col("report_sn").alias("report_id")).distinct()
    s = (
        summary.select("report_id", "lastmonthquery_selfquery", "last2yearquery_loanmanage")
        .join(looked_up(own), "report_id")
        .distinct()
        .groupBy("report_id")
        .agg(
            F.count(F.lit(1)).alias("n_s"),
            F.max("last2yearquery_loanmanage").alias("lm"),
            F.max("lastmonthquery_selfquery").alias("sq"),
            F.count_distinct("lastmonthquery_selfquery").alias("uq"),
        )
    )
    out = counts.join(s, counts["report_sn"] == s["report_id"], "left")
    mult = F.greatest(F.coalesce(F.col("n_s"), F.lit(0)), F.lit(1))
    return out.select(
        "cust_ids",
        *[(F.coalesce(F.col(name), F.lit(0)) * mult).cast("double").alias(f"{name}_1") for name, _ in specs],
        F.col("lm").alias("query_loanmanage_24m_1"),
        F.col("sq").alias("query_selfquery_1m_1"),
        F.coalesce(F.col("uq"), F.lit(0)).alias("uq"),
    )


# --- D16 -------------------------------------------------------------------


def _query_summary(headers, pqo_pc05, pc05a, pc05b, few: bool = False) -> DataFrame:
    """Summary rows of the documents of ``headers`` (``id, doc_id``), null ones for headers without any.

    ``few`` says that the headers are a small share of all.
    """
    held = looked_up if few else lambda df: df
    a = headers.select("id", "doc_id")
    a1 = pqo_pc05.select(F.col("id").alias("pc05_id"), F.col("pqo_id").alias("id"))
    a2 = pc05a.select(
        F.col("pqo_pc05_id").alias("a_pc05_id"),
        F.col("pc05ar01").alias("last_query_date"),
        F.col("pc05aq01").alias("last_query_reason"),
        F.col("pc05ad01").alias("last_query_org"),
        F.col("pc05ai01").alias("last_query_org_code"),
    )
    a3 = pc05b.select(
        F.col("pqo_pc05_id").alias("b_pc05_id"),
        F.col("pc05bs01").alias("query_loan_org_cnt_1m"),
        F.col("pc05bs02").alias("query_card_org_cnt_1m"),
        F.col("pc05bs03").alias("query_loan_cnt_1m"),
        F.col("pc05bs04").alias("query_card_cnt_1m"),
        F.col("pc05bs05").alias("query_selfquery_cnt_1m"),
        F.col("pc05bs06").alias("query_loanmanage_24m"),
    )
    return (
        held(held(held(a).join(a1, "id", "left")).join(a2, F.col("pc05_id") == F.col("a_pc05_id"), "left"))
        .join(a3, F.col("pc05_id") == F.col("b_pc05_id"), "left")
        .select("doc_id", *SUMMARY_COLUMNS)
    )


def _enquiries(poq_ph01: DataFrame) -> DataFrame:
    return poq_ph01.select(
        F.col("poq_id").alias("id"),
        F.col("ph010r01").alias("query_date"),
        F.col("ph010d01").alias("management_org_type"),
        F.col("ph010q02").alias("query_org"),
        F.col("ph010q03").alias("query_reason"),
    )


def report_identity(prh, prh_pa01, prh_pa01b, of: DataFrame | None = None) -> DataFrame:
    """Identity units of gen-2 documents: (doc_id, unit, name, id number...).

    A bag, not a set: its consumers (the flattening and the latest-report
    search) are insensitive to repeated rows. With ``of``, some rows of
    ``prh_pa01b``, only their units come.
    """
    a = prh.select("id", "doc_id")
    a1 = prh_pa01.select(F.col("id").alias("report_unit_id"), "prh_id")
    a2 = (prh_pa01b if of is None else of).select(
        "prh_pa01_id",
        F.col("pa01bq01").alias("name"),
        F.col("pa01bd01").alias("id_type"),
        F.col("pa01bi01").alias("id_card_num"),
        F.col("pa01bi02").alias("query_ord_code"),
        F.col("pa01bd02").alias("query_reason_code"),
    )
    unit, head = F.col("report_unit_id") == F.col("prh_pa01_id"), F.col("id") == F.col("prh_id")
    joined = a.join(a1, head, "left").join(a2, unit, "left") if of is None else a2.join(a1, unit).join(a, head)
    return joined.select("doc_id", "report_unit_id", *IDENTITY_COLUMNS)


def gen2_documents(doc: DataFrame, min_create: str = codes.GEN2_MIN_CREATE) -> DataFrame:
    """Gen-2 document headers created on or after ``min_create``'s day.

    Not deduplicated: every consumer is insensitive to repeated headers.
    """
    return (
        doc.filter(F.col("create_time") >= instant_literal(min_create))
        .select("id", "report_code", "create_time")
    )


def cohort_identity(cohort: DataFrame, prh: DataFrame, prh_pa01: DataFrame, prh_pa01b: DataFrame) -> DataFrame:
    """``report_identity`` of the cohort's customers only.

    The customers select the identity rows, these the units, these the
    documents: each table meets what the one before it left, by inner joins.
    """
    ids = cohort.select(F.col("cust_ids").alias("pa01bi01"))
    rows = prh_pa01b.join(ids, "pa01bi01", "left_semi")
    return report_identity(prh, prh_pa01, prh_pa01b, rows)


FLAT_COLUMNS = ("create_time", *IDENTITY_COLUMNS, *ENQUIRY_COLUMNS, *SUMMARY_COLUMNS)


def heavy_documents(poq: DataFrame, poq_ph01: DataFrame) -> tuple[dict[str, int], dict[str, int]]:
    """Headers and documents with very many enquiries (``joins.heavy_keys``)."""
    headers = heavy_keys(poq_ph01, "poq_id")
    documents = heavy_keys(poq, "doc_id")
    if headers:
        for r in poq.where(F.col("id").isin(list(headers))).select("id", "doc_id").collect():
            documents[r.doc_id] = documents.get(r.doc_id, 0) + headers[r.id]
    documents.pop(None, None)
    return headers, documents


def report_flatten(
    main: DataFrame,
    pqo: DataFrame,
    pqo_pc05: DataFrame,
    pc05a: DataFrame,
    pc05b: DataFrame,
    poq: DataFrame,
    poq_ph01: DataFrame,
    identity: DataFrame,
    heavy: tuple[dict[str, int], dict[str, int]] = ({}, {}),
) -> DataFrame:
    """Gen-2 document trees as flat distinct rows (20 columns).

    ``main`` is the document headers (``gen2_documents``), ``identity`` the
    output of ``report_identity``. Headers are left-joined to their query
    summary, query records and identity units on the document id; every table
    is read once. ``heavy`` (``heavy_documents``) names the headers and the
    documents whose enquiries are dealt to several tasks.

    Only the final ``distinct`` is applied: left joins of bags followed by a
    distinct give the same rows as left joins of sets, so deduplicating each
    branch first would add a shuffle per branch and change nothing. Equal rows
    of a document go where the last join has put them; then the shuffle goes by
    all columns but the enquiry's: a document's rows stay beside each other,
    where what they share is compressed. Those of the times of heavy documents
    are dealt by all columns to as many parts.
    """
    headers, documents = heavy
    qs = _query_summary(pqo, pqo_pc05, pc05a, pc05b).withColumnRenamed("doc_id", "id")
    qr = left_join_many(poq.select("id", "doc_id"), _enquiries(poq_ph01), ["id"], headers)
    qr = qr.select(F.col("doc_id").alias("id"), *ENQUIRY_COLUMNS)
    rq = identity.select(F.col("doc_id").alias("id"), *IDENTITY_COLUMNS)
    flat = main.join(qs, "id", "left")
    flat = left_join_many(flat, qr, ["id"], documents)  # many enquiries per document
    flat = flat.join(rq, "id", "left")
    flat = flat.select("id", *FLAT_COLUMNS).distinct().select(*FLAT_COLUMNS)
    document = [c for c in FLAT_COLUMNS if c not in ENQUIRY_COLUMNS]
    if not documents:
        return flat.repartition(*document).distinct()
    times = main.where(F.col("id").isin(list(documents))).select("id", F.unix_micros("create_time").alias("t")).collect()
    parts = F.lit(1)
    for t in sorted({r.t for r in times if r.t is not None}):
        parts = F.when(F.unix_micros("create_time") == t, max(documents[r.id] for r in times if r.t == t)).otherwise(parts)
    dealt = flat.withColumn("_part", F.pmod(F.xxhash64(*FLAT_COLUMNS), parts))
    return dealt.repartition(*document, "_part").distinct().drop("_part")


# --- D17 -------------------------------------------------------------------


def documents_asof(cohort: DataFrame, main: DataFrame, identity: DataFrame, censor: Censor = None) -> DataFrame:
    """``cust_ids, id, create_time``: the gen-2 documents of each customer before the censor, distinct."""
    heads = main.select("id", "create_time")
    if censor is not None:
        heads = heads.filter(F.col("create_time") < instant_literal(censor))
    links = identity.select(F.col("doc_id").alias("id"), F.col("id_card_num").alias("cust_ids"))
    own = cohort.select("cust_ids", "time_censor").join(links, "cust_ids").join(heads, "id")
    return own.filter(F.col("create_time") < F.col("time_censor")).select("cust_ids", "id", "create_time").distinct()


def latest_of(documents: DataFrame) -> DataFrame:
    """Of ``documents_asof``, each customer's documents of the latest time, all that are tied.

    The documents at that time come from an equi join on (customer, time),
    which spreads one customer's documents over partitions.
    """
    last = documents.groupBy("cust_ids").agg(F.max("create_time").alias("create_time"))
    return documents.join(last, ["cust_ids", "create_time"]).select("id", "cust_ids", "create_time")


def latest_documents(cohort: DataFrame, main: DataFrame, identity: DataFrame, censor: Censor = None) -> DataFrame:
    """``id, cust_ids, create_time``: each customer's gen-2 documents of the latest time before the censor."""
    return latest_of(documents_asof(cohort, main, identity, censor))


def _held_by(rows: DataFrame, values: tuple[str, ...], *extra: Column) -> DataFrame:
    """A customer's distinct tuples of ``values`` grouped by the documents that hold them.

    ``cust_ids, docs, n``: ``n`` tuples are in just the documents ``docs`` (in
    order). A customer has one document in all but rare cases, several only if
    they are tied at one instant.
    """
    tuples = rows.groupBy("cust_ids", *values).agg(F.array_sort(F.collect_set("id")).alias("docs"))
    return tuples.groupBy("cust_ids", "docs").agg(F.count(F.lit(1)).alias("n"), *extra)


def _meeting(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of a row of ``a`` and a row of ``b`` (``docs``) of one customer that share a document, each once."""
    each = lambda df, docs: df.withColumn("doc", F.explode(docs))
    pairs = each(a.withColumnRenamed("docs", "docs_a"), "docs_a").join(each(b.withColumnRenamed("docs", "docs_b"), "docs_b"), ["cust_ids", "doc"])
    both = F.array_intersect("docs_a", "docs_b")
    return pairs.withColumn("docs", both).where(F.col("doc") == F.array_min("docs"))


def query_counts_gen2(
    latest: DataFrame,
    pqo: DataFrame,
    pqo_pc05: DataFrame,
    pc05a: DataFrame,
    pc05b: DataFrame,
    poq: DataFrame,
    poq_ph01: DataFrame,
    identity: DataFrame,
    windows: tuple[int, int, int] = codes.QUERY_WINDOWS,
) -> DataFrame:
    """The D15 counts on a customer's latest gen-2 report before the
    censor (``latest``, of ``latest_documents``), with reason codes 2 (loan) and 3 (card); all reports of that
    latest time count (ties kept). Counted over distinct flattened rows, so
    equal enquiries collapse.

    A flattened row is (identity, enquiry, summary) of one document, and rows
    of tied documents may coincide. The product is never built. An enquiry
    held by the documents D adds as many rows as there are distinct pairs of
    an identity tuple and a summary tuple that share a document of D; whether a
    pair does depends only on the documents that hold either. So tuples are
    counted by the set of documents that hold them: sets of identity tuples
    meet sets of summary tuples, the products of their counts are summed by
    the documents they share, and these meet the sets of enquiries. With one
    document each of these is one row. Every table is read once, and meets the
    latest documents before anything is made distinct.
    """
    reason = F.col("query_reason").try_cast("int")
    specs = _window_specs(reason, F.lit(codes.GEN2_REASON_LOAN), F.lit(codes.GEN2_REASON_CARD), windows)
    maxima = ("query_loanmanage_24m", "query_selfquery_cnt_1m")
    latest = latest.select("id", "cust_ids", "create_time")

    units = identity.select(F.col("doc_id").alias("id"), F.col("id_card_num").alias("cust_ids"), *IDENTITY_COLUMNS)
    people = _held_by(latest.join(units, ["id", "cust_ids"]), IDENTITY_COLUMNS)

    docs = latest.select(F.col("id").alias("doc_id")).distinct()
    summary = _query_summary(pqo.join(looked_up(docs), "doc_id", "left_semi"), pqo_pc05, pc05a, pc05b, few=True).withColumnRenamed("doc_id", "id")
    # A document without a summary has a null one, as in the left joins.
    summaries = _held_by(latest.join(summary, "id", "left"), SUMMARY_COLUMNS, *[F.max(c).alias(c) for c in maxima])

    headers = poq.select(F.col("id").alias("poq_id"), F.col("doc_id").alias("id")).join(looked_up(latest), "id")
    enquiries = _enquiries(poq_ph01).withColumnRenamed("id", "poq_id").join(looked_up(headers), "poq_id")
    no_days = F.datediff(F.to_date("create_time"), F.to_date("query_date"))
    asked = _held_by(
        enquiries.withColumn("no_days", no_days), (*ENQUIRY_COLUMNS, "no_days"), *[flag_sum(cond).alias(name) for name, cond in specs]
    )

    pairs = _meeting(people, summaries.select("cust_ids", "docs", F.col("n").alias("n_summaries")))
    pairs = pairs.groupBy("cust_ids", "docs").agg(F.sum(F.col("n") * F.col("n_summaries")).alias("pairs"))
    counts = _meeting(pairs, asked.drop("n")).groupBy("cust_ids").agg(*[F.sum(F.col(name) * F.col("pairs")).alias(name) for name, _ in specs])
    most = summaries.groupBy("cust_ids").agg(*[F.max(c).alias(c) for c in maxima])
    return most.join(counts, "cust_ids", "left").select(
        "cust_ids",
        *[F.coalesce(F.col(name), F.lit(0.0)).alias(f"{name}_2") for name, _ in specs],
        *[F.col(c).alias(f"{c}_2") for c in maxima],
    )


# --- D18 -------------------------------------------------------------------


def generation_merge(cohort: DataFrame, gen1: DataFrame, gen2: DataFrame) -> DataFrame:
    """The ten bureau query features, gen-2 value when present, else gen-1."""
    pairs = [(c, f"{c}_2", f"{c}_1") for c in GEN1_COLUMNS] + [
        ("query_loanmanage_24m", "query_loanmanage_24m_2", "query_loanmanage_24m_1"),
        ("query_selfquery_1m", "query_selfquery_cnt_1m_2", "query_selfquery_1m_1"),
    ]
    j = cohort.select("cust_ids", "time_censor").join(gen1, "cust_ids", "left").join(gen2, "cust_ids", "left")
    return j.select(
        "cust_ids",
        "time_censor",
        *[F.coalesce(F.col(second), F.col(first)).alias(out) for out, second, first in pairs],
        "uq",
    )


# --- D19 -------------------------------------------------------------------


def latest_report_normalised(cohort: DataFrame, reports: DataFrame, censor: Censor = None) -> DataFrame:
    """Latest gen-1 report whose time, cut to the second, is before the
    censor cut to the second; the largest serial among reports of that time
    (null when none has one: the row is kept).

    Output: ``cust_ids, report_sn, cert_no, censor, report_create_time``.
    """
    r = reports.select("report_sn", "cert_no", "report_create_time")
    if censor is not None:
        # t cut to the second < c cut to the second  <=>  t < c cut to the second
        r = r.filter(F.col("report_create_time") < F.date_trunc("second", instant_literal(censor)))
    j = cohort.select("cust_ids", "time_censor").join(
        r,
        F.col("cust_ids") == F.col("cert_no"),
        "inner",
    ).filter(F.date_trunc("second", "report_create_time") < F.date_trunc("second", "time_censor"))
    best = j.groupBy("cust_ids").agg(
        F.max(F.struct("report_create_time", "report_sn")).alias("b"),
        F.max("time_censor").alias("censor"),
    )
    return best.select(
        "cust_ids",
        F.col("b.report_sn").alias("report_sn"),
        F.col("cust_ids").alias("cert_no"),
        "censor",
        F.col("b.report_create_time").alias("report_create_time"),
    )


# --- D20 -------------------------------------------------------------------


def loan_settlement_ratios(
    latest: DataFrame,
    report_loans: DataFrame,
    lookback_days: int = codes.SETTLEMENT_LOOKBACK_DAYS,
    excluded_types: tuple[str, ...] = codes.EXCLUDED_LOAN_TYPES,
    settled: str = codes.SETTLED,
    censor: Censor = None,
) -> DataFrame:
    """Bureau loans opened within ``lookback_days`` of the censor
    (excluded types left out): settled share by distinct count (0.0 when
    nothing has a status) and settled-plus-repaid share by amount.

    "Repaid" prorates a loan without status that ends after the censor:
    amount per period times the whole number of periods left, as defined.
    It is summed as decimals per number of periods, and these few sums in
    order, so it does not depend on the order of rows.
    """
    loans = report_loans
    if censor is not None:
        # When all customers share a censor, the look-back reaches the scan.
        first_day = F.date_sub(F.lit(as_datetime(censor).date()), lookback_days + 1)
        loans = loans.filter(F.col("start_date") >= first_day.cast("timestamp"))
    base = latest.select("cust_ids", "report_sn", "censor")
    # Inner join: rows without a loan fail the date filter below anyway.
    j = loans.join(looked_up(base), base["report_sn"] == loans["report_id"], "inner").select(
        "cust_ids",
        "loan_id",
        "start_date",
        "org_type",
        "organname",
        "loan_amount",
        "loan_type",
        "period",
        "payment_method",
        "end_date",
        "account_status",
        "censor",
        F.datediff(F.to_date("end_date"), F.to_date("start_date")).alias("loan_days"),
    )
    censor_day = F.to_date("censor")
    j = j.filter(
        (F.to_date("start_date") >= F.date_sub(censor_day, lookback_days))
        & not_equal_all(F.col("loan_type"), excluded_types)
    ).distinct()
    status = F.col("account_status")
    periods_left = (
        ratio(F.datediff(F.to_date("end_date"), censor_day), F.col("loan_days")) * F.col("period")
    ).try_cast("int")
    open_end = status.isNull() & (F.to_date("end_date") > censor_day)
    prorated = (F.col("loan_amount") * periods_left).cast("decimal(38,2)")
    # One pass: sums per loan and number of periods; a loan's statuses go to
    # the first of its rows, so that loans are counted where amounts are summed.
    own = j.groupBy("cust_ids", "loan_id", "period").agg(
        F.max(status == settled).alias("settled"),
        F.max(status != settled).alias("open"),
        F.sum(F.when(status == settled, F.col("loan_amount")).otherwise(no_money())).alias("settled_amt"),
        F.sum("loan_amount").alias("total_amt"),
        F.sum(F.when(open_end, prorated)).alias("prorated"),
    )
    sums = F.struct("period", "settled_amt", "total_amt", "prorated")
    is_loan = F.col("loan_id").isNotNull()
    loans = own.groupBy("cust_ids", "loan_id").agg(
        (F.max("settled") & is_loan).alias("settled"), (F.max("open") & is_loan).alias("open"), F.collect_list(sums).alias("sums")
    )
    rows = loans.select("cust_ids", "settled", "open", F.posexplode("sums").alias("pos", "of"))
    first = F.col("pos") == 0
    by_period = rows.groupBy("cust_ids", F.col("of.period").alias("period")).agg(
        F.count_if(first & F.col("settled")).alias("settled_n"),
        F.count_if(first & F.col("open")).alias("open_n"),
        F.sum("of.settled_amt").alias("settled_amt"),
        F.sum("of.total_amt").alias("total_amt"),
        F.sum("of.prorated").cast("double").alias("prorated"),
    )
    repaid = F.struct("period", ratio(F.col("prorated"), F.col("period")).alias("repaid"))
    in_order = F.transform(F.array_sort(F.collect_list(repaid)), lambda s: F.coalesce(s["repaid"], F.lit(0.0)))
    agg = by_period.groupBy("cust_ids").agg(
        F.sum("settled_n").alias("settled_n"),
        F.sum("open_n").alias("open_n"),
        F.sum("settled_amt").cast("double").alias("settled_amt"),
        F.sum("total_amt").cast("double").alias("total_amt"),
        F.aggregate(in_order, F.lit(0.0), lambda a, x: a + x).alias("repaid_amt"),
    )
    return agg.select(
        "cust_ids",
        F.coalesce(ratio(F.col("settled_n"), F.col("settled_n") + F.col("open_n")), F.lit(0.0)).alias(
            "settled_loan_cnt_ratio_1y"
        ),
        ratio(F.col("settled_amt") + F.col("repaid_amt"), F.col("total_amt")).alias("settled_loan_amount_ratio_1y"),
    )


# --- D21 -------------------------------------------------------------------


def min_gap_lag2(latest: DataFrame, report_cards: DataFrame) -> DataFrame:
    """Fewest days in which a customer opened three cards: the minimum,
    over cards sorted by start date, of the days between a card and the one
    two places before it. Null with fewer than three dated cards.

    Cards are first deduplicated and counted per (customer, day); the window
    then runs over one row per distinct day of a customer, a calendar bound
    that does not grow with the number of cards.
    """
    base = latest.select("cust_ids", "report_sn", "censor")
    cards = report_cards.join(looked_up(base), base["report_sn"] == report_cards["report_id"], "inner").select(
        "cust_ids", "start_date", "org_type", "organname", "card_type", "guarantee_type", "deadline", "censor"
    )
    per_day = (
        cards.distinct()
        .filter(F.col("start_date").isNotNull())
        .groupBy("cust_ids", F.to_date("start_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy("cust_ids").orderBy("day")
    prev1, prev2 = F.lag("day", 1).over(w), F.lag("day", 2).over(w)
    prev_n = F.lag("n", 1).over(w)
    cand = F.least(
        F.when(F.col("n") >= 3, F.lit(0)),
        F.when((F.col("n") >= 2) | (prev_n >= 2), F.datediff("day", prev1)),
        F.datediff("day", prev2),
    )
    gaps = per_day.select("cust_ids", cand.alias("gap")).groupBy("cust_ids").agg(
        F.min("gap").cast("int").alias("lag2_loan_card_time_diff_min")
    )
    return base.select("cust_ids").join(gaps, "cust_ids", "left")
