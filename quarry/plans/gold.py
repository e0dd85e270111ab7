"""Gold layer (M11-M16): enriched facts, policy mart, reports.

Plan shapes chosen for scale:

* Facts are enriched through one *policy context* (policy ⟕ agent ⟕ current
  customer, one row per policy). The chain of left joins only references policy
  columns, so it is associative: the big fact is shuffled once (on
  ``policy_id``) instead of once per dimension. Policies are not shuffled on
  ``agent_id``, a key of few values and NULLs: agents are broadcast once measured.
* The policy mart aggregates each fact by ``policy_id`` first (partial
  aggregation before the shuffle), so the joins see one row per policy on every
  side: no fan-out and no skew from a hot policy.
* Reports build each count in one aggregate per source (``count_if``) and
  stack them; no cross join of one-row frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.fixed import SCORECARD_METRICS, SCORECARD_UNIT, STREAM_CLAIMS, STREAM_PAYMENTS
from quarry.operators.contracts import enforce
from quarry.operators.joins import enrich_measured, left_enrich
from quarry.operators.scd2 import current_rows
from quarry.schemas import RECONCILIATION

MONEY_SCALE = 2
RATIO_SCALE = 4

FCT_PAYMENTS_COLUMNS = [
    "payment_id", "policy_id", "customer_id", "agent_id", "branch", "region", "product_line",
    "customer_income_band", "customer_city", "due_date", "paid_date", "amount", "currency",
    "method", "is_paid", "days_to_pay", "is_invalid_amount", "is_paid_before_due",
    "is_late_arrival", "_batch", "_ingested_at",
]
FCT_CLAIMS_COLUMNS = [
    "claim_id", "policy_id", "customer_id", "agent_id", "branch", "region", "product_line",
    "claim_type", "filed_date", "assessed_date", "claim_amount", "paid_amount", "currency",
    "status", "is_paid_claim", "is_assessed", "settlement_days", "is_late_arrival", "_batch",
]


def policy_context(
    policies: DataFrame, agents: DataFrame, dim_customer: DataFrame | None = None
) -> DataFrame:
    """One row per policy: customer, agent, branch/region, product line and,
    with ``dim_customer``, the *current* customer attributes (J02/J03/J05)."""
    ctx = policies.select("policy_id", "customer_id", "agent_id", "product_line")
    ctx = enrich_measured(ctx, agents, "agent_id", ["branch", "region"])
    if dim_customer is not None:
        cur = current_rows(dim_customer).select(
            "customer_id",
            F.col("income_band").alias("customer_income_band"),
            F.col("city").alias("customer_city"),
        )
        ctx = left_enrich(ctx, cur, "customer_id", ["customer_income_band", "customer_city"])
    return ctx


def gold_fct_premium_payments(
    payments: DataFrame, policies: DataFrame, agents: DataFrame, dim_customer: DataFrame
) -> DataFrame:  # M11
    ctx = policy_context(policies, agents, dim_customer)
    j = payments.join(ctx, on="policy_id", how="left")  # J01
    return j.select(*FCT_PAYMENTS_COLUMNS)


def gold_fct_claims(claims: DataFrame, policies: DataFrame, agents: DataFrame) -> DataFrame:  # M12
    ctx = policy_context(policies, agents)
    j = claims.join(ctx, on="policy_id", how="left")  # J04
    return j.select(*FCT_CLAIMS_COLUMNS)


def money_sum(c: Column) -> Column:
    """Sum of money, rounded to cents (engine-independent result)."""
    return F.round(F.sum(c), MONEY_SCALE)


def gold_policy_performance(
    policies: DataFrame, payments: DataFrame, claims: DataFrame
) -> DataFrame:  # M13
    collected = F.when(F.col("is_paid") & ~F.col("is_invalid_amount"), F.col("amount")).otherwise(
        F.lit(0.0)
    )
    pay = payments.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("premiums_due"),
        F.count_if(F.col("is_paid")).alias("premiums_paid"),
        money_sum(collected).alias("premium_collected"),
    )
    clm = claims.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("claims_filed"),
        money_sum(F.coalesce(F.col("paid_amount"), F.lit(0.0))).alias("claims_paid"),
    )
    j = policies.join(pay, "policy_id", "left").join(clm, "policy_id", "left")  # J06
    collected_total = F.coalesce(F.col("premium_collected"), F.lit(0.0))
    claims_total = F.coalesce(F.col("claims_paid"), F.lit(0.0))
    return j.select(
        "policy_id",
        "customer_id",
        "product_line",
        "status",
        "currency",
        "premium_amount",
        "sum_assured",
        F.coalesce(F.col("premiums_due"), F.lit(0).cast("long")).alias("premiums_due"),
        F.coalesce(F.col("premiums_paid"), F.lit(0).cast("long")).alias("premiums_paid"),
        collected_total.alias("premium_collected"),
        F.coalesce(F.col("claims_filed"), F.lit(0).cast("long")).alias("claims_filed"),
        claims_total.alias("claims_paid"),
        F.when(
            collected_total > 0, F.round(claims_total / F.col("premium_collected"), RATIO_SCALE)
        ).alias("loss_ratio"),  # R09: guarded division, NULL otherwise
    )


def _stream_counts(bronze: DataFrame, silver: DataFrame, stream: str) -> DataFrame:
    """One row of counts per stream, zeros for an empty one (J07): a global aggregate
    over bronze and silver rows, whose name is added after it."""
    b = bronze.select(F.lit(True).alias("_bronze"), F.lit(False).alias("_late"))
    s = silver.select(F.lit(False).alias("_bronze"), F.col("is_late_arrival").alias("_late"))
    counts = b.unionByName(s).agg(
        F.count_if("_bronze").alias("bronze_rows"),
        F.count_if(~F.col("_bronze")).alias("silver_rows"),
        F.count_if("_late").alias("late_arrival_rows"),
    )
    return counts.withColumn("stream", F.lit(stream))


def gold_rpt_reconciliation(
    bronze_payments: DataFrame,
    silver_payments: DataFrame,
    bronze_claims: DataFrame,
    silver_claims: DataFrame,
) -> DataFrame:  # M14
    agg = _stream_counts(bronze_payments, silver_payments, STREAM_PAYMENTS).unionByName(
        _stream_counts(bronze_claims, silver_claims, STREAM_CLAIMS)
    )
    out = agg.select(
        "stream",
        "bronze_rows",
        "silver_rows",
        (F.col("bronze_rows") - F.col("silver_rows")).alias("duplicates_removed"),
        "late_arrival_rows",
    ).orderBy("stream")
    return enforce(out, RECONCILIATION, "gold_rpt_reconciliation")


def _metric_rows(agg: DataFrame, metrics: list[tuple[int, str]]) -> DataFrame:
    """Stack named columns of a one-row aggregate into (ord, metric, value) rows."""
    items = [
        F.struct(
            F.lit(o).alias("ord"), F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")
        )
        for o, m in metrics
    ]
    return agg.select(F.explode(F.array(*items)).alias("r")).select("r.*")




def gold_rpt_data_quality(
    payments: DataFrame, claims: DataFrame, dim_customer: DataFrame, keep_ord: bool = False
) -> DataFrame:  # M15
    ordinal = {m: i + 1 for i, m in enumerate(SCORECARD_METRICS)}
    pay = payments.agg(
        F.count(F.lit(1)).alias("payments_total"),
        F.count_if(~F.col("is_paid")).alias("payments_unpaid"),
        F.count_if(F.col("is_invalid_amount")).alias("payments_invalid_amount"),
        F.count_if(F.col("is_paid_before_due")).alias("payments_paid_before_due"),
        F.count_if(F.col("is_late_arrival")).alias("payments_late_arrival"),
    )
    clm = claims.agg(
        F.count(F.lit(1)).alias("claims_total"),
        F.count_if(F.col("is_late_arrival")).alias("claims_late_arrival"),
    )
    # One pass over the dimension: per customer (already clustered by
    # customer_id, so no shuffle) then a global roll-up.
    per_customer = dim_customer.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("is_current")).alias("_current"),
        F.max("scd_version").alias("_mv"),
    )
    dim = per_customer.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("customers_scd_rows"),
        F.coalesce(F.sum("_current"), F.lit(0)).cast("long").alias("customers_current"),
        F.count_if(F.col("_mv") > 1).alias("customers_with_history"),
    )
    parts = [
        _metric_rows(df, [(ordinal[c], c) for c in df.columns]) for df in (pay, clm, dim)
    ]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.withColumn("unit", F.lit(SCORECARD_UNIT)).orderBy("ord")  # O01
    return rows if keep_ord else rows.select("metric", "value", "unit")


def sample_history(dim_customer: DataFrame, min_versions: int = 3) -> DataFrame:  # M16
    """All versions of the first customer (by id) with ``>= min_versions`` spans.

    Versions are numbered from 1 without gaps, so such a customer has a row of version
    ``min_versions`` (A10) and the smallest id among those rows (O03) is one aggregate of
    one row, which is broadcast to pick that customer's rows (P19). Nothing is gathered
    per customer, and a stored dimension is filtered before anything is shuffled.
    """
    cols = ["customer_id", "scd_version", "city", "income_band", "risk_class",
            "valid_from", "valid_to", "is_current"]
    enough = dim_customer.filter(F.col("scd_version") == min_versions)
    first = enough.agg(F.min("customer_id").alias("customer_id"))  # one row
    return dim_customer.select(*cols).join(F.broadcast(first), "customer_id", "left_semi").orderBy("scd_version")


def gold_layer(bronze: dict[str, DataFrame], silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    pay, clm = silver["silver_premium_payments"], silver["silver_claims"]
    pol, agt, dim = silver["silver_policies"], silver["silver_agents"], silver["silver_dim_customer"]
    return {
        "gold_fct_premium_payments": gold_fct_premium_payments(pay, pol, agt, dim),
        "gold_fct_claims": gold_fct_claims(clm, pol, agt),
        "gold_policy_performance": gold_policy_performance(pol, pay, clm),
        "gold_rpt_reconciliation": gold_rpt_reconciliation(
            bronze["premium_payments"], pay, bronze["claims"], clm
        ),
        "gold_rpt_data_quality": gold_rpt_data_quality(pay, clm, dim),
    }
