"""Join helpers: left enrichment and referential checks.

Spark picks the physical join: the planner's own size estimate in bytes and AQE's
run-time statistics decide (``autoBroadcastJoinThreshold``), and AQE splits skewed
partitions of a sort-merge join (``spark.sql.adaptive.skewJoin.enabled``). Only
``enrich_measured`` hints a broadcast, of a side whose size it has measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What may be broadcast, and what a row takes beside its values.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64


def left_enrich(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    right_cols: Sequence[str],
) -> DataFrame:
    """``left ⟕ right`` on equal keys, adding ``right_cols`` (already aliased)."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right.select(*keys, *right_cols), on=keys, how="left")


def measured_bytes(df: DataFrame) -> int:
    """About the bytes that the rows of ``df`` take: one aggregate over its columns."""
    values = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    row = sum(values[1:], values[0]) + F.lit(ROW_BYTES)
    return df.agg(F.sum(row.cast("bigint"))).first()[0] or 0


def enrich_measured(
    left: DataFrame,
    right: DataFrame,
    on: str,
    right_cols: Sequence[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``left_enrich`` for a key of few values, by which ``left`` had better not be shuffled.

    ``right`` is measured by a job of its own. Up to ``limit`` bytes it is broadcast and the
    rows of ``left`` stay where they are, hot and NULL keys included. Beyond that it is a
    shuffle join, whose skewed partitions AQE splits on the left.
    """
    right = right.select(on, *right_cols)
    if measured_bytes(right) <= limit:
        right = F.broadcast(right)
    return left.join(right, on=[on], how="left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child keys with no parent (NULL child keys are not orphans).

    Children are first reduced to distinct keys with a row count (partial
    aggregation, so a hot key is one row per map task), then anti-joined: the
    join input is at most one row per key on both sides, whatever the skew.
    """
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("_k"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
    return keys.join(parents, on="_k", how="left_anti")
