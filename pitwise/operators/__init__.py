"""Feature operators D1-D28: pure DataFrame -> DataFrame functions."""

from pitwise.operators.asof import (
    account_link,
    cohort_censor,
    device_events_asof,
    order_payments_asof,
)
from pitwise.operators.assemble import attach_applications, credit_age, derived_features, feature_assembly
from pitwise.operators.events import device_burst_7d, event_code_rates, monthly_device_city_peak
from pitwise.operators.loans import (
    cohort_loans,
    last_loan_profile,
    loan_history_counts,
    loan_outcomes,
    of_loans,
    overdue_flag_any,
    overdue_flag_strict,
    principal_pay_ratio,
    repaid_by_censor,
    repay_outcome_rates,
)
from pitwise.operators.ratios import credit_pay_ratios, spend_summary
from pitwise.operators.reports import (
    cohort_identity,
    documents_asof,
    gen2_documents,
    generation_merge,
    heavy_documents,
    latest_documents,
    latest_of,
    latest_report,
    latest_report_normalised,
    loan_settlement_ratios,
    min_gap_lag2,
    query_counts_gen1,
    query_counts_gen2,
    report_flatten,
    report_identity,
)

__all__ = [
    "account_link",
    "attach_applications",
    "cohort_censor",
    "cohort_identity",
    "credit_age",
    "credit_pay_ratios",
    "derived_features",
    "device_burst_7d",
    "device_events_asof",
    "documents_asof",
    "event_code_rates",
    "feature_assembly",
    "gen2_documents",
    "generation_merge",
    "heavy_documents",
    "last_loan_profile",
    "latest_documents",
    "latest_of",
    "latest_report",
    "latest_report_normalised",
    "loan_history_counts",
    "loan_outcomes",
    "cohort_loans",
    "of_loans",
    "loan_settlement_ratios",
    "min_gap_lag2",
    "monthly_device_city_peak",
    "order_payments_asof",
    "overdue_flag_any",
    "overdue_flag_strict",
    "principal_pay_ratio",
    "query_counts_gen1",
    "query_counts_gen2",
    "repaid_by_censor",
    "repay_outcome_rates",
    "report_flatten",
    "report_identity",
    "spend_summary",
]
