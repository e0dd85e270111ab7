"""Keep the latest row per business key.

``row_number() over (partition by key order by ...) = 1`` is planned by Spark as
a partial ``WindowGroupLimit`` *before* the shuffle and a final one after it, so
each map task forwards at most one row per key: a key re-sent millions of times
is collapsed map-side and cannot pile up in one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RN = "_rn"


def latest_order(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], total: bool = True) -> list[Column]:
    """Sort spec: ``latest_by`` descending (NULLs last), then every other column.

    The trailing columns make the winner deterministic when the business order
    ties on rows that differ; rows that tie on everything are identical, so
    either one is the same output.
    """
    spec = [F.col(c).desc_nulls_last() for c in latest_by]
    if total:
        used = set(keys) | set(latest_by)
        spec += [F.col(c).asc_nulls_first() for c in df.columns if c not in used]
    return spec


def keep_latest(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], total: bool = True
) -> DataFrame:
    """One row per ``keys``: the newest under ``latest_by`` (e.g. ingest time, batch)."""
    w = Window.partitionBy(*keys).orderBy(*latest_order(df, keys, latest_by, total))
    return df.withColumn(RN, F.row_number().over(w)).filter(F.col(RN) == 1).drop(RN)
