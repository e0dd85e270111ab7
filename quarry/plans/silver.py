"""Silver layer (M06-M10): conformed dimensions and deduplicated facts.

Inputs are bronze DataFrames; outputs are lazy plans. Flags on the facts are
those of the row that survives deduplication, so a re-send that lands in a later
batch can turn an on-time row late. They follow from the row's other columns, which
alone decide ties: rows are sorted and shuffled without them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.fixed import ASSESSED_STATUSES, PAID_STATUS
from quarry.functions.normalize import clean, days_between, token, yyyymm
from quarry.operators.dedup import keep_latest
from quarry.operators.scd2 import scd2_from_snapshots
from quarry.operators.contracts import enforce
from quarry.schemas import DIM_CUSTOMER

DIM_TRACKED = ["full_name", "gender", "occupation", "city", "income_band", "risk_class"]
DIM_CARRIED = ["birth_date"]
FACT_LATEST_BY = ["_ingested_at", "_batch"]


def silver_agents(bronze_agents: DataFrame) -> DataFrame:  # M06
    return bronze_agents.select(
        "agent_id",
        clean("agent_name").alias("agent_name"),
        token("branch").alias("branch"),
        token("region").alias("region"),
        "hire_date",
    )


def silver_policies(bronze_policies: DataFrame) -> DataFrame:  # M08
    return bronze_policies.select(
        "policy_id",
        "customer_id",
        "agent_id",
        token("product_line").alias("product_line"),
        F.col("premium_amount").cast("double").alias("premium_amount"),
        F.col("sum_assured").cast("double").alias("sum_assured"),
        token("currency").alias("currency"),
        "start_date",
        "term_months",
        token("status").alias("status"),
    )


def canonical_payments(bronze_payments: DataFrame) -> DataFrame:
    """M09 before flags and dedup: canonical tokens."""
    return bronze_payments.select(
        "payment_id",
        "policy_id",
        "due_date",
        "paid_date",
        F.col("amount").cast("double").alias("amount"),
        token("currency").alias("currency"),
        token("method").alias("method"),
        "_ingested_at",
        "_batch",
    )


def payment_flags(payments: DataFrame) -> DataFrame:
    """The five flags (P04-P08) of canonical payments."""
    paid = F.col("paid_date").isNotNull()
    return payments.select(
        "*",
        paid.alias("is_paid"),
        F.when(paid, days_between("due_date", "paid_date")).alias("days_to_pay"),
        (F.col("amount") <= 0).alias("is_invalid_amount"),
        (paid & (F.col("paid_date") < F.col("due_date"))).alias("is_paid_before_due"),
        (F.col("_batch") > yyyymm("due_date")).alias("is_late_arrival"),
    )


def normalized_payments(bronze_payments: DataFrame) -> DataFrame:
    """M09 before dedup: canonical tokens and the five flags."""
    return payment_flags(canonical_payments(bronze_payments))


def silver_premium_payments(bronze_payments: DataFrame) -> DataFrame:  # M09
    return payment_flags(keep_latest(canonical_payments(bronze_payments), ["payment_id"], FACT_LATEST_BY))


def canonical_claims(bronze_claims: DataFrame) -> DataFrame:
    """M10 before derived columns and dedup: canonical tokens."""
    return bronze_claims.select(
        "claim_id",
        "policy_id",
        token("claim_type").alias("claim_type"),
        "filed_date",
        "assessed_date",
        F.col("claim_amount").cast("double").alias("claim_amount"),
        F.col("paid_amount").cast("double").alias("paid_amount"),
        token("currency").alias("currency"),
        token("status").alias("status"),
        "_ingested_at",
        "_batch",
    )


def claim_flags(claims: DataFrame) -> DataFrame:
    """The four derived columns (P09-P11, P08) of canonical claims."""
    status = F.col("status")
    return claims.select(
        "*",
        (status == PAID_STATUS).alias("is_paid_claim"),
        status.isin(list(ASSESSED_STATUSES)).alias("is_assessed"),
        F.when(
            F.col("assessed_date").isNotNull(), days_between("filed_date", "assessed_date")
        ).alias("settlement_days"),
        (F.col("_batch") > yyyymm("filed_date")).alias("is_late_arrival"),
    )


def normalized_claims(bronze_claims: DataFrame) -> DataFrame:
    """M10 before dedup: canonical tokens and four derived columns."""
    return claim_flags(canonical_claims(bronze_claims))


def silver_claims(bronze_claims: DataFrame) -> DataFrame:  # M10
    return claim_flags(keep_latest(canonical_claims(bronze_claims), ["claim_id"], FACT_LATEST_BY))


def normalized_snapshots(bronze_snapshots: DataFrame) -> DataFrame:
    """M07 step 1: name/occupation trimmed only; categoricals upper(trim())."""
    return bronze_snapshots.select(
        "customer_id",
        "snapshot_month",
        clean("full_name").alias("full_name"),
        token("gender").alias("gender"),
        clean("occupation").alias("occupation"),
        token("city").alias("city"),
        token("income_band").alias("income_band"),
        token("risk_class").alias("risk_class"),
        "birth_date",
    )


def silver_dim_customer(bronze_snapshots: DataFrame, null_safe: bool = False) -> DataFrame:  # M07
    dim = scd2_from_snapshots(
        normalized_snapshots(bronze_snapshots),
        key="customer_id",
        period="snapshot_month",
        tracked=DIM_TRACKED,
        carried=DIM_CARRIED,
        null_safe=null_safe,
    )
    return enforce(dim, DIM_CUSTOMER, "silver_dim_customer")
