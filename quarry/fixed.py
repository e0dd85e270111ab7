"""Literals whose exact text decides the results.

They are the warehouse's published contract (accepted domains, status sets,
report labels) and the exact recipes of two derived values (the SCD2 change
sentinels and the surrogate-key text). Kept here together, in natural order.
"""

# Fixed values ---------------------------------------------------------------
# Accepted domains of the conformed categoricals (checks K11-K13, K18-K19, K24-K25).
PRODUCT_LINES = ("LIFE", "MICRO", "HEALTH", "GENERAL")
CURRENCIES = ("IDR", "USD")
POLICY_STATUSES = ("ACTIVE", "LAPSED", "MATURED", "CANCELLED")
PAYMENT_METHODS = ("TRANSFER", "AUTODEBIT", "CASH", "VA")
CLAIM_STATUSES = ("FILED", "APPROVED", "REJECTED", "PAID")
CLAIM_TYPES = ("DEATH", "HOSPITAL", "ACCIDENT", "MATURITY", "SURRENDER")

# Claim statuses: paid, and the ones that count as assessed.
PAID_STATUS = "PAID"
ASSESSED_STATUSES = ("PAID", "APPROVED", "REJECTED")

# SCD2 change test: coalesce(current, '') != coalesce(previous, '~').
CURRENT_SENTINEL = ""
PREVIOUS_SENTINEL = "~"

# Surrogate key: md5(coalesce(text(a), NULL_TOKEN) || '-' || coalesce(text(b), NULL_TOKEN)).
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"

# Reconciliation stream labels and the scorecard's metrics, in report order.
STREAM_PAYMENTS = "premium_payments"
STREAM_CLAIMS = "claims"
SCORECARD_UNIT = "rows"
SCORECARD_METRICS = (
    "payments_total",
    "payments_unpaid",
    "payments_invalid_amount",
    "payments_paid_before_due",
    "payments_late_arrival",
    "claims_total",
    "claims_late_arrival",
    "customers_scd_rows",
    "customers_current",
    "customers_with_history",
)
