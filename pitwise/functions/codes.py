"""Fixed values of the feature definitions.

These literals must equal the values the original job compares against, or
the features change meaning. They are kept together, as plain text, in the
order the job uses them.
"""

# --- fixed values (do not edit: they define the features) -------------------

# Identity and account validity.
ID_LENGTH = 18
ACCOUNT_LENGTH = 19

# Merchant orders above this amount (in cents) are ignored.
AMOUNT_CAP = 10_000_000

# Payment channel and payment type markers.
RXD_CHANNEL_MARK = "任性贷"
CREDIT_PAY_MARK = "CREDIT"

# Device event codes counted per customer, in output order of the counts.
EVENT_CODES = (
    "E0906",
    "LOGIN_POST",
    "E0506",
    "E0406",
    "E0129",
    "E0418",
    "E0428",
    "E0424",
    "E0425",
    "E0434",
)
# Codes whose plain totals are also reported.
EVENT_TOTAL_CODES = ("LOGIN_POST", "E0906")
# Order of the per-day rate columns in the output.
EVENT_RATE_ORDER = (
    "E0506",
    "LOGIN_POST",
    "E0406",
    "E0906",
    "E0418",
    "E0129",
    "E0428",
    "E0424",
    "E0425",
    "E0434",
)
# Codes of the loan-use events whose devices and cities are counted per month.
LOAN_USE_CODES = ("E0418", "E0406")
# Device id used when the event has none.
UNKNOWN_DEVICE = "unknown"
# Burst rule: this many distinct devices within this many days.
BURST_DEVICES = 4
BURST_DAYS = 7

# The consumer-loan ("XFD") product is this partner, product and quota type.
XFD_PARTNER_NO = "10"
XFD_PRODUCT_NO = "RXD"
XFD_QUOTA_TYPE = "02"

# Repayment status codes.
REPAY_OK = "200"
REPAY_FAIL = "500"

# First-generation bureau query reasons.
REASON_LOAN = "贷款审批"
REASON_CARD = "信用卡审批"
# Second-generation bureau query reason codes (numeric).
GEN2_REASON_LOAN = 2
GEN2_REASON_CARD = 3
# Second-generation reports are read only after this day.
GEN2_MIN_CREATE = "2020-01-20"

# Bureau query windows in days.
QUERY_WINDOWS = (90, 180, 365)

# Bureau loan account status meaning "settled".
SETTLED = "结清"
# Bureau loan types left out of the settlement ratios.
EXCLUDED_LOAN_TYPES = (
    "个人汽车贷款",
    "个人商用房（包括商住两用）贷款",
    "个人住房贷款",
)
# Look-back of the settlement ratios, in days.
SETTLEMENT_LOOKBACK_DAYS = 365

# Overdue thresholds.
OVERDUE_STRICT_DAYS = 3.0
OVERDUE_STRICT_LEAD_DAYS = 3.0

# Smoothing constants of the ratios.
SPEND_RATIO_SMOOTH = 0.1
ODDS_SMOOTH = 0.1
FAIL_RATE_SMOOTH = 0.01
NO_APPLICATION_RATIO = -0.1
