"""The whole feature job as one lazily built set of stages.

``FeatureJob`` wires the operators D1-D28 over one set of inputs and one
censor. Stages are built on first use and memoised, so a stage used by
several features (the cohort, the accounts, the as-of events and payments,
the latest reports, the assembled row) is one sub-plan object.

With ``materialize=True`` those shared stages are written as parquet under
the session's ``spark.checkpoint.dir`` and read back. That cuts lineage
(a lost executor re-runs one stage, not the job) and stops Spark from
recomputing a shared stage once per consumer. The directory must be a
shared file system on a cluster; it is read from the session, never
invented here. Finished stages are recorded (``plans.manifest``): a job with
the ``run_id`` of one that was ended reads them and goes on from there, and
``publish`` shows its tables to readers all at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise import operators as op
from pitwise.functions import codes
from pitwise.functions.joins import sieved
from pitwise.functions.time import instant_literal
from pitwise.plans.manifest import Manifest, Records, delete_folder
from pitwise.plans.session import ensure_checkpoint_dir
from pitwise.sources.audit import check_parsed, parse_report
from pitwise.sources.inputs import Inputs


@dataclass(frozen=True)
class JobParams:
    # The censor of every cohort row. Without a caller-supplied cohort it
    # defines the cohort (D1); with one it must not be before any row's.
    censor: str | None
    amount_cap: float = codes.AMOUNT_CAP
    loan_use_period: str = "month"
    gen2_min_create: str = codes.GEN2_MIN_CREATE
    history_bucket_days: int = 1
    # Values per text column that may fail to parse before a write is refused.
    max_unparsed: int | None = None


class FeatureJob:
    """All stages of the job over one set of inputs.

    ``cohort`` may be given as a DataFrame ``(cust_ids, time_censor)`` with a
    censor per customer. Features are keyed by customer, so a customer must
    be in it once: for several censors of one customer run one job each. The
    cohort is read once to check this, that no censor is null, and for the
    first and last censor, which bound the scans. ``params.censor`` may be
    None; one before the last censor is refused.
    """

    def __init__(
        self,
        inputs: Inputs,
        params: JobParams,
        materialize: bool = False,
        run_id: str | None = None,
        cohort: DataFrame | None = None,
    ):
        if cohort is None and params.censor is None:
            raise ValueError("give params.censor, or a cohort with a censor per row")
        self.inputs = inputs
        self.p = params
        self.materialize = materialize
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self._new_run = run_id is None
        self._given_cohort = cohort
        # Scan-side bounds: no row's censor is after the one or before the other.
        self.censor = self.first_censor = params.censor
        if cohort is not None:
            self.first_censor, self.censor = self._checked(cohort)

    def _checked(self, cohort: DataFrame) -> tuple[datetime | None, datetime | None]:
        """The first and last censor of ``cohort``; raises if it breaks the contract."""
        t = F.col("time_censor")
        per_customer = cohort.groupBy("cust_ids").agg(
            F.count(F.lit(1)).alias("n"), F.count(t).alias("known"), F.min(t).alias("first"), F.max(t).alias("last")
        )
        got = per_customer.agg(
            F.max("n").alias("most"),
            F.coalesce(F.sum(F.col("n") - F.col("known")), F.lit(0)).alias("unknown"),
            F.unix_micros(F.min("first")).alias("first"),
            F.unix_micros(F.max("last")).alias("last"),
            F.unix_micros(F.lit(None).cast("timestamp") if self.p.censor is None else instant_literal(self.p.censor)).alias("given"),
        ).first()
        if (got["most"] or 0) > 1:
            raise ValueError("the cohort has a customer twice; features are keyed by cust_ids")
        if got["unknown"]:
            raise ValueError(f"the cohort has {got['unknown']} rows without a censor")
        if got["last"] is None:
            return None, None
        if got["given"] is not None and got["given"] < got["last"]:
            raise ValueError("params.censor is before a censor of the cohort")
        epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
        return epoch + timedelta(microseconds=got["first"]), epoch + timedelta(microseconds=got["last"])

    # -- materialisation ------------------------------------------------------

    @cached_property
    def spark(self) -> SparkSession:
        return self.inputs.raw("credits").sparkSession if self._given_cohort is None else self._given_cohort.sparkSession

    @cached_property
    def scratch(self) -> str:
        """The run's folder for stages, in the session's checkpoint directory."""
        return f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/pitwise/{self.run_id}"

    @cached_property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, self.scratch, self.run_id, self._identity(), new=self._new_run)

    def _identity(self) -> str:
        return f"{self.p}{'' if self._given_cohort is None else ' with a cohort'}"

    def _stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage as written by this run; built and written if the run has not got so far."""
        if not self.materialize:
            return build()
        path = self.manifest.finished.get(name)
        if path is None:
            path = f"{self.scratch}/{name}"
            build().write.mode("overwrite").parquet(path)
            self.manifest.add(name, path)
        return self.spark.read.parquet(path)

    def cleanup(self) -> None:
        """Delete the run's stages. What was read from them can no longer be computed."""
        delete_folder(self.spark, self.scratch)

    def _before(self, name: str, column: str) -> DataFrame:
        return self.inputs.before(name, column, self.censor)

    def _sieved(self, name: str, key: str, few: DataFrame, of: str) -> DataFrame:
        """Input ``name`` without most rows that ``few`` does not select, once it is written.

        Written rows are read with their keys as they are: what a join asks of
        a key, such as that it is not null, is not computed for all rows again.
        """
        if not self.materialize:
            return self.inputs[name]
        return self._stage(f"latest_{name}", lambda: sieved(self.inputs[name], key, few, of))

    def _write_shared(self) -> None:
        """Write the stages that several features read, those of one depth at a time.

        They do not depend on each other, so their Spark jobs run side by
        side and fill the cluster together.
        """
        if not self.materialize:
            return
        shared = (
            "device_events_raw",
            "payments",
            "cohort_outcomes",
            "gen1_children",
            "normalised_children",
            "latest_tree",
        )
        for names in (("cohort",), ("accounts", "cohort_identity", "cohort_loans"), ("cohort_overdue",), shared):
            with ThreadPoolExecutor(len(names)) as pool:
                list(pool.map(lambda name: getattr(self, name), names))

    # -- D1-D4 ----------------------------------------------------------------

    @cached_property
    def cohort(self) -> DataFrame:
        if self._given_cohort is not None:
            return self._stage("cohort", lambda: self._given_cohort.select("cust_ids", "time_censor"))
        return self._stage("cohort", lambda: op.cohort_censor(self.inputs["credits"], self.p.censor))

    @cached_property
    def accounts(self) -> DataFrame:
        return self._stage("accounts", lambda: op.account_link(self.cohort, self.inputs["members"]))

    @cached_property
    def device_events(self) -> DataFrame:
        return op.device_events_asof(self.accounts, self._before("device_events", "pay_time"), censor=self.censor)

    @cached_property
    def device_events_raw(self) -> DataFrame:
        """As-of events without the row dedup; for duplicate-insensitive uses."""
        return self._stage(
            "device_events",
            lambda: op.device_events_asof(self.accounts, self._before("device_events", "pay_time"), censor=self.censor, dedupe=False),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self._stage(
            "payments",
            lambda: op.order_payments_asof(
                self.accounts,
                self._before("orders", "pay_time"),
                self.inputs["order_lines"],
                amount_cap=self.p.amount_cap,
                censor=self.censor,
            ),
        )

    # -- D5-D9 ----------------------------------------------------------------

    @cached_property
    def pay_ratios(self) -> DataFrame:
        return op.credit_pay_ratios(self.payments)

    @cached_property
    def spend(self) -> DataFrame:
        return op.spend_summary(self.payments)

    @cached_property
    def event_rates(self) -> DataFrame:
        return op.event_code_rates(self.device_events_raw)

    @cached_property
    def burst(self) -> DataFrame:
        return op.device_burst_7d(self.device_events_raw)

    @cached_property
    def event_features(self) -> DataFrame:
        """The event rates with the burst flag, one row per customer."""
        return self.event_rates.join(self.burst, "cust_ids", "left")

    @cached_property
    def device_peak(self) -> DataFrame:
        return op.monthly_device_city_peak(self.device_events_raw, period=self.p.loan_use_period)

    # -- D10-D13, D22-D24 -----------------------------------------------------

    @cached_property
    def loan_outcomes(self) -> DataFrame:
        i = self.inputs
        return self._stage("loan_outcomes", lambda: op.loan_outcomes(i["loans"], i["overdue"], i["repayments"]))

    @cached_property
    def history(self) -> DataFrame:
        """Of all customers, as D10 is defined."""
        return op.loan_history_counts(self.loan_outcomes, bucket_days=self.p.history_bucket_days)

    @cached_property
    def cohort_loans(self) -> DataFrame:
        """The cohort's valid loans, once they are written: all that the cohort's features read of the loans."""
        if not self.materialize:
            return self.inputs["loans"]
        return self._stage("cohort_loans", lambda: op.cohort_loans(self.cohort, self.inputs["loans"]))

    @cached_property
    def cohort_overdue(self) -> DataFrame:
        """The overdue records of the cohort's loans, once they are written."""
        if not self.materialize:
            return self.inputs["overdue"]
        return self._stage("cohort_overdue", lambda: op.of_loans(self.inputs["overdue"], self.cohort_loans))

    @cached_property
    def cohort_outcomes(self) -> DataFrame:
        def build() -> DataFrame:
            repayments = self.inputs["repayments"]
            if not self.materialize:
                return op.loan_outcomes(self.cohort_loans, self.cohort_overdue, repayments, self.cohort)
            return op.loan_outcomes(self.cohort_loans, self.cohort_overdue, op.of_loans(repayments, self.cohort_loans))

        return self._stage("cohort_outcomes", build)

    @cached_property
    def cohort_history(self) -> DataFrame:
        """The history of the cohort's customers, all that the assembled row needs."""
        return op.loan_history_counts(self.cohort_outcomes, bucket_days=self.p.history_bucket_days)

    def _loans_before(self) -> DataFrame:
        return self.cohort_loans if self.materialize else self._before("loans", "loan_time")

    @cached_property
    def repaid(self) -> DataFrame:
        return op.repaid_by_censor(self.cohort, self.cohort_loans, self._before("repayments", "apply_time"), censor=self.censor)

    @cached_property
    def xfd(self) -> DataFrame:
        return op.principal_pay_ratio(self.cohort, self.cohort_loans, self.repaid)

    @cached_property
    def repay_outcomes(self) -> DataFrame:
        return op.repay_outcome_rates(
            self.cohort, self._loans_before(), self._before("repayments", "apply_time"), censor=self.censor
        )

    @cached_property
    def od_strict(self) -> DataFrame:
        overdue = self.cohort_overdue if self.materialize else self._before("overdue", "start_date")
        return op.overdue_flag_strict(self.cohort, self.cohort_loans, overdue, censor=self.censor)

    @cached_property
    def od_any(self) -> DataFrame:
        return op.overdue_flag_any(self.cohort, self.cohort_loans, self.cohort_overdue, censor=self.censor)

    @cached_property
    def last_loan(self) -> DataFrame:
        return op.last_loan_profile(self.cohort, self._loans_before(), censor=self.censor)

    # -- D14-D21 --------------------------------------------------------------

    @cached_property
    def latest_report(self) -> DataFrame:
        return self._stage("latest_report", lambda: op.latest_report(self.cohort, self._before("reports", "report_create_time"), censor=self.censor))

    @cached_property
    def gen1_children(self) -> list[DataFrame]:
        """Enquiries and summaries of the latest reports."""
        return [self._sieved(name, "report_id", self.latest_report, "report_sn") for name in ("report_queries", "report_summary")]

    @cached_property
    def gen1_counts(self) -> DataFrame:
        return op.query_counts_gen1(self.latest_report, *self.gen1_children)

    @cached_property
    def gen2_main(self) -> DataFrame:
        return op.gen2_documents(self.inputs["doc"], self.p.gen2_min_create)

    @cached_property
    def gen2_identity(self) -> DataFrame:
        i = self.inputs
        return op.report_identity(i["prh"], i["prh_pa01"], i["prh_pa01b"])

    @cached_property
    def cohort_identity(self) -> DataFrame:
        """The identity units of the cohort's customers."""
        i = self.inputs
        return self._stage("cohort_identity", lambda: op.cohort_identity(self.cohort, i["prh"], i["prh_pa01"], i["prh_pa01b"]))

    def _gen2_tree(self) -> tuple:
        i = self.inputs
        return (i["pqo"], i["pqo_pc05"], i["pc05a"], i["pc05b"], i["poq"], i["poq_ph01"])

    @cached_property
    def report_flat(self) -> DataFrame:
        heavy = op.heavy_documents(self.inputs["poq"], self.inputs["poq_ph01"])
        return op.report_flatten(self.gen2_main, *self._gen2_tree(), self.gen2_identity, heavy=heavy)

    @cached_property
    def documents(self) -> DataFrame:
        return self._stage(
            "documents", lambda: op.documents_asof(self.cohort, self.gen2_main, self.cohort_identity, censor=self.censor)
        )

    @cached_property
    def latest_documents(self) -> DataFrame:
        return self._stage("latest_documents", lambda: op.latest_of(self.documents))

    @cached_property
    def latest_tree(self) -> tuple:
        """The tree of the latest documents: the children of a table are sieved by what is written of it."""
        if not self.materialize:
            return self._gen2_tree()
        pqo, poq = (self._sieved(name, "doc_id", self.latest_documents, "id") for name in ("pqo", "poq"))
        pc05 = self._sieved("pqo_pc05", "pqo_id", pqo, "id")
        of_pc05 = [self._sieved(name, "pqo_pc05_id", pc05, "id") for name in ("pc05a", "pc05b")]
        return (pqo, pc05, *of_pc05, poq, self._sieved("poq_ph01", "poq_id", poq, "id"))

    @cached_property
    def gen2_counts(self) -> DataFrame:
        tree, identity = self.latest_tree, self.cohort_identity
        if self.materialize:
            identity = sieved(identity, "doc_id", self.latest_documents, "id")
        return op.query_counts_gen2(self.latest_documents, *tree, identity)

    @cached_property
    def bureau(self) -> DataFrame:
        return op.generation_merge(self.cohort, self.gen1_counts, self.gen2_counts)

    @cached_property
    def latest_report_normalised(self) -> DataFrame:
        return self._stage(
            "latest_report_normalised", lambda: op.latest_report_normalised(self.cohort, self._before("reports", "report_create_time"), censor=self.censor)
        )

    @cached_property
    def normalised_children(self) -> list[DataFrame]:
        """Loans and cards of the latest reports by D19."""
        return [self._sieved(name, "report_id", self.latest_report_normalised, "report_sn") for name in ("report_loans", "report_cards")]

    @cached_property
    def settlement(self) -> DataFrame:
        return op.loan_settlement_ratios(
            self.latest_report_normalised, self.normalised_children[0], censor=self.first_censor
        )

    @cached_property
    def card_gap(self) -> DataFrame:
        return op.min_gap_lag2(self.latest_report_normalised, self.normalised_children[1])

    # -- D25-D28 --------------------------------------------------------------

    @cached_property
    def assembled(self) -> DataFrame:
        def assemble() -> DataFrame:
            self._write_shared()
            return op.feature_assembly(
                self.cohort,
                self.pay_ratios,
                self.spend,
                self.event_rates,
                self.burst,
                self.cohort_history,
                self.bureau,
                self.xfd,
                self.settlement,
                self.card_gap,
                self.device_peak,
                self.od_strict,
                self.od_any,
                self.last_loan,
            )

        return self._stage("assembled", assemble)

    @cached_property
    def features(self) -> DataFrame:
        return self._stage("features", lambda: op.derived_features(self.assembled, self.repay_outcomes))

    @cached_property
    def applications(self) -> DataFrame:
        return op.attach_applications(self.features, self.inputs["loans"])

    @cached_property
    def final(self) -> DataFrame:
        return op.credit_age(self.features, self.inputs["credits_alt"], self.inputs["credits"])

    # -- sinks ----------------------------------------------------------------

    # Stages written by ``write``, each after those it reads: the step tables
    # and feature tables that the job publishes.
    PUBLISHED = (
        "cohort",
        "accounts",
        "device_events",
        "payments",
        "pay_ratios",
        "spend",
        "event_rates",
        "burst",
        "event_features",
        "device_peak",
        "history",
        "xfd",
        "repay_outcomes",
        "latest_report",
        "gen1_counts",
        "gen2_counts",
        "bureau",
        "settlement",
        "card_gap",
        "assembled",
        "features",
        "applications",
        "final",
    )

    def write(self, target: str, stages: tuple[str, ...] = PUBLISHED, fmt: str = "parquet") -> dict[str, str]:
        """Overwrite one output per stage and return where each went.

        ``target`` is a directory (``<target>/<stage>`` in ``fmt``) or, with
        ``fmt="table"``, a table-name prefix (``<target><stage>`` via
        ``saveAsTable``). A written stage is read back where later ones use
        it, so nothing is computed twice.
        """
        self.check_inputs()
        out = {}
        for name in stages:
            df = getattr(self, name)
            if fmt == "table":
                dest = f"{target}{name}"
                df.write.mode("overwrite").saveAsTable(dest)
                written = self.spark.table(dest)
            else:
                dest = f"{target.rstrip('/')}/{name}"
                df.write.mode("overwrite").format(fmt).save(dest)
                written = self.spark.read.schema(df.schema).format(fmt).load(dest)
            self.__dict__[name] = written
            out[name] = dest
        return out

    def publish(self, target: str, stages: tuple[str, ...] = PUBLISHED, fmt: str = "parquet", cleanup: bool = True) -> dict[str, str]:
        """Write the stages of this run below ``target``, then make all of them visible at once.

        Tables go to ``<target>/<run_id>/<stage>``; readers find them with
        ``manifest.published``, which sees a run only when its last table is
        written. A run of the same id that was ended before goes on after the
        last table that it finished. At the end the run's scratch is deleted.
        """
        self.check_inputs()
        folder = f"{target.rstrip('/')}/{self.run_id}"
        done = Manifest(self.spark, folder, self.run_id, self._identity(), new=self._new_run)
        for name in stages:
            dest = done.finished.get(name)
            if dest is None:
                df, dest = getattr(self, name), f"{folder}/{name}"
                df.write.mode("overwrite").format(fmt).save(dest)
                done.add(name, dest)
            self.__dict__[name] = self.spark.read.format(fmt).load(dest)
        records = [{"run_id": self.run_id, "stage": n, "path": done.finished[n], "format": fmt, "params": self._identity()} for n in stages]
        Records(self.spark, f"{target.rstrip('/')}/published").add(records)
        if cleanup and self.materialize:
            self.cleanup()
        return {n: done.finished[n] for n in stages}

    # -- input checks -----------------------------------------------------------

    @cached_property
    def parse_report(self) -> DataFrame:
        """Values of the inputs that cannot be read (``sources.audit``)."""
        return parse_report(self.inputs)

    def check_inputs(self) -> None:
        """Raise if a column has more unparsed values than ``params.max_unparsed`` (None: not checked)."""
        if self.p.max_unparsed is not None:
            check_parsed(self.parse_report, self.p.max_unparsed)
