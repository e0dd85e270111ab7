"""Declared schemas: the five raw extracts and the layer outputs.

Raw schemas are passed to ``spark.read.schema(...)`` so a landing folder is never
inferred. The two contract schemas (C01, C02) are enforced before a write.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*cols: tuple[str, DataType]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


S, D, F8, L, I, B, TS = (
    StringType(),
    DateType(),
    DoubleType(),
    LongType(),
    IntegerType(),
    BooleanType(),
    TimestampNTZType(),
)

# ---------------------------------------------------------------- raw extracts
RAW_AGENTS = _struct(
    ("agent_id", S), ("agent_name", S), ("branch", S), ("region", S), ("hire_date", D)
)
RAW_CUSTOMER_SNAPSHOTS = _struct(
    ("customer_id", S),
    ("snapshot_month", D),
    ("full_name", S),
    ("birth_date", D),
    ("gender", S),
    ("occupation", S),
    ("city", S),
    ("income_band", S),
    ("risk_class", S),
)
RAW_POLICIES = _struct(
    ("policy_id", S),
    ("customer_id", S),
    ("agent_id", S),
    ("product_line", S),
    ("premium_amount", F8),
    ("sum_assured", F8),
    ("currency", S),
    ("start_date", D),
    ("term_months", L),
    ("status", S),
)
RAW_PREMIUM_PAYMENTS = _struct(
    ("payment_id", S),
    ("policy_id", S),
    ("due_date", D),
    ("paid_date", D),
    ("amount", F8),
    ("currency", S),
    ("method", S),
    ("_ingested_at", TS),
    ("_batch", L),
)
RAW_CLAIMS = _struct(
    ("claim_id", S),
    ("policy_id", S),
    ("claim_type", S),
    ("filed_date", D),
    ("assessed_date", D),
    ("claim_amount", F8),
    ("paid_amount", F8),
    ("currency", S),
    ("status", S),
    ("_ingested_at", TS),
    ("_batch", L),
)

RAW_SCHEMAS: dict[str, StructType] = {
    "agents": RAW_AGENTS,
    "customer_snapshots": RAW_CUSTOMER_SNAPSHOTS,
    "policies": RAW_POLICIES,
    "premium_payments": RAW_PREMIUM_PAYMENTS,
    "claims": RAW_CLAIMS,
}

# ------------------------------------------------------------------- contracts
# silver_dim_customer (birth_date precedes valid_from, as built).
DIM_CUSTOMER = _struct(
    ("customer_sk", S),
    ("customer_id", S),
    ("scd_version", I),
    ("full_name", S),
    ("gender", S),
    ("occupation", S),
    ("city", S),
    ("income_band", S),
    ("risk_class", S),
    ("birth_date", D),
    ("valid_from", D),
    ("valid_to", D),
    ("is_current", B),
)

# gold_rpt_reconciliation.
RECONCILIATION = _struct(
    ("stream", S),
    ("bronze_rows", L),
    ("silver_rows", L),
    ("duplicates_removed", L),
    ("late_arrival_rows", L),
)

CONTRACTS: dict[str, StructType] = {
    "silver_dim_customer": DIM_CUSTOMER,
    "gold_rpt_reconciliation": RECONCILIATION,
}
