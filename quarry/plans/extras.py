"""Operators the pipeline's documentation promises beyond its core models.

X01 as-of SCD2 join, X04 fuzzy categorical repair, X05 freshness, X06 fact
currency against policy currency. All are plain DataFrame plans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.normalize import days_between, token


# ------------------------------------------------------------------ X01
def asof_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    prefix: str = "",
) -> DataFrame:
    """Left join each fact to the dimension span valid at ``facts[at]``.

    Span test: ``valid_from <= at < valid_to`` (open end when ``valid_to`` is
    NULL). Planned as an equi join on ``key`` with a range residual: each fact
    row is tested only against its own key's spans (a handful per key), and a
    skewed key is split by AQE's skew-join handling of the left side.
    """
    spans = dim.select(
        F.col(key).alias("_dk"),
        F.col("valid_from").alias("_vf"),
        F.col("valid_to").alias("_vt"),
        *[F.col(c).alias(prefix + c) for c in columns],
    )
    cond = (
        (F.col(key) == F.col("_dk"))
        & (F.col(at) >= F.col("_vf"))
        & (F.col("_vt").isNull() | (F.col(at) < F.col("_vt")))
    )
    return facts.join(spans, cond, "left").drop("_dk", "_vf", "_vt")


def payments_asof_customer(
    payments: DataFrame, policies: DataFrame, dim: DataFrame, join=asof_join
) -> DataFrame:
    """Payments with the customer attributes in force on the due date.

    ``join``: ``asof_join``, or ``operators.asof.asof_sweep`` for keys of many spans.
    """
    facts = payments.select("payment_id", "policy_id", "due_date").join(
        policies.select("policy_id", "customer_id"), "policy_id", "left"
    )
    out = join(
        facts,
        dim,
        key="customer_id",
        at="due_date",
        columns=["scd_version", "city", "income_band", "risk_class"],
        prefix="asof_",
    )
    return out.select(
        "payment_id", "policy_id", "customer_id", "due_date",
        "asof_scd_version", "asof_city", "asof_income_band", "asof_risk_class",
    )


# ------------------------------------------------------------------ X04
def best_match(value: Column, domain: Sequence[str], max_distance: int) -> Column:
    """Closest domain value by Levenshtein distance of ``upper(trim(value))``.

    Returns ``struct(distance, repaired)``; ``repaired`` is NULL when the best
    distance exceeds ``max_distance`` or a third of the token's length, so that
    blank and short tokens are not turned into values they do not resemble. Ties
    go to the alphabetically first value. The domain is a literal array, so no
    join is needed.
    """
    tok = token(value)
    cands = F.array(
        *[F.struct(F.levenshtein(tok, F.lit(d)).alias("distance"), F.lit(d).alias("value")) for d in domain]
    )
    best = F.array_min(cands)
    return F.struct(
        best["distance"].alias("distance"),
        F.when(
            (best["distance"] <= max_distance) & (best["distance"] * 3 <= F.length(tok)), best["value"]
        ).alias("repaired"),
    )


def fuzzy_repair_report(
    sources: Sequence[tuple[str, DataFrame, str, Sequence[str]]], max_distance: int = 2
) -> DataFrame:
    """Per (column, raw value): repaired token, distance and row count.

    ``sources`` holds ``(label, frame, column, domain)``. Raw values are
    reduced by ``groupBy`` first (partial aggregation), so the string distance
    is computed once per distinct value, not per row.
    """
    parts = []
    for label, df, col, domain in sources:
        counts = df.groupBy(F.col(col).alias("raw_value")).agg(F.count(F.lit(1)).alias("rows"))
        m = best_match(F.col("raw_value"), domain, max_distance)
        parts.append(
            counts.select(
                F.lit(label).alias("column_name"),
                "raw_value",
                m["repaired"].alias("repaired_value"),
                m["distance"].cast("long").alias("distance"),
                "rows",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def repair_column(df: DataFrame, col: str, domain: Sequence[str], max_distance: int = 2) -> DataFrame:
    """``df`` with ``col`` repaired where a value is close enough; the raw value stays in ``<col>_raw``.

    A value that nothing is close to is left as it is.
    """
    repaired = best_match(F.col(col), domain, max_distance)["repaired"]
    return df.withColumns({f"{col}_raw": F.col(col), col: F.coalesce(repaired, F.col(col))})


# ------------------------------------------------------------------ X05
def freshness(streams: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Per stream: rows, rows ingested before their event day, lag range in days.

    ``streams`` holds ``(name, bronze frame, event date column)``; lag is
    ``ingest day - event day``.
    """
    parts = []
    for name, df, event in streams:
        lag = days_between(F.col(event), F.to_date("_ingested_at"))
        parts.append(
            df.agg(
                F.lit(name).alias("stream"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(lag < 0).alias("ingested_before_event"),
                F.min(lag).alias("min_lag_days"),
                F.max(lag).alias("max_lag_days"),
                F.count_if(F.col("_batch") > F.year(event) * 100 + F.month(event)).alias(
                    "late_batch_rows"
                ),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ X06
def currency_match(facts: DataFrame, policies: DataFrame) -> DataFrame:
    """Fact rows by (fact currency, policy currency); a mismatch is a defect.

    Facts are reduced to ``(policy_id, currency) -> rows`` before the join
    (partial aggregation), so a hot policy is one row per map task.
    """
    per_policy = facts.groupBy("policy_id", F.col("currency").alias("fact_currency")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    j = per_policy.join(
        policies.select("policy_id", F.col("currency").alias("policy_currency")), "policy_id", "left"
    )
    return j.groupBy("fact_currency", "policy_currency").agg(
        F.sum("_rows").cast("long").alias("rows"),
    ).withColumn(
        "is_match", F.coalesce(F.col("fact_currency") == F.col("policy_currency"), F.lit(False))
    )
