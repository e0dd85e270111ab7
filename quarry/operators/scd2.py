"""Type-2 slowly changing dimension from periodic full snapshots.

Steps, all over one window partitioning (``key``), so the plan shuffles the
snapshots exactly once:

1. flag a row when any tracked attribute differs from the previous snapshot
   (``lag``; the first row always flags, so versions start at 1);
2. running ``sum`` of the flags = version number;
3. collapse each ``(key, version)`` to one span (``min`` of the period start
   and of every attribute, over rows that a hash aggregate has made few); already
   clustered by ``key``, so no new exchange;
4. close spans with ``lead(valid_from)``; the open span is current.

A window partition holds one key's snapshots, bounded by the number of
periods (keys are unique per period), never a whole table.

Change test, default (``null_safe=False``): ``coalesce(x, '') !=
coalesce(lag(x), '~')`` per tracked column, OR-ed. A NULL attribute therefore
counts as a change every period; NULL -> '' flags, '' -> NULL does not.
``null_safe=True`` compares with null-safe equality plus a first-row flag;
both agree whenever no tracked value is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.fixed import CURRENT_SENTINEL, PREVIOUS_SENTINEL
from quarry.functions.normalize import surrogate_key



def change_flag(tracked: Sequence[str], w: Window, null_safe: bool = False) -> Column:
    """1 when any tracked attribute differs from the previous row, else 0."""
    if null_safe:
        first = F.lag(F.lit(1)).over(w).isNull()
        diffs = [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in tracked]
        cond = reduce(lambda a, b: a | b, diffs, first)
    else:
        diffs = [
            F.coalesce(F.col(c), F.lit(CURRENT_SENTINEL))
            != F.coalesce(F.lag(c).over(w), F.lit(PREVIOUS_SENTINEL))
            for c in tracked
        ]
        cond = reduce(lambda a, b: a | b, diffs)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def _spans(
    df: DataFrame,
    key: str,
    period: str,
    tracked: Sequence[str],
    carried: Sequence[str],
    null_safe: bool,
    version_col: str,
    sk_col: str | None,
    order: Sequence[str],
    base_col: str | None = None,
) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    flagged = df.withColumn("_chg", change_flag(tracked, w, null_safe))
    running = F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if base_col:
        # Versions continue from a stored history: the seed row (the key's
        # current span) is version `base`, so offset the running count by base-1.
        base = F.max(base_col).over(Window.partitionBy(key))
        running = running + F.coalesce(base, F.lit(1)) - 1
    versioned = flagged.withColumn("_ver", running)
    values = list(dict.fromkeys([*tracked, *carried]))
    # Equal rows of a version are put together by hash first: minima of strings sort their
    # input, which then is about a row per span instead of one per snapshot.
    few = versioned.groupBy(key, "_ver", *values).agg(F.min(period).alias("_from"))
    spans = few.groupBy(key, "_ver").agg(
        F.min("_from").alias("valid_from"), *[F.min(c).alias(c) for c in values]
    )
    spans = spans.withColumn(version_col, F.col("_ver").cast("int")).drop("_ver")
    w2 = Window.partitionBy(key).orderBy(version_col)
    nxt = F.lead("valid_from").over(w2)
    out = spans.withColumn("valid_to", nxt).withColumn("is_current", nxt.isNull())
    cols = [key, version_col, *tracked, *carried, "valid_from", "valid_to", "is_current"]
    if sk_col:
        out = out.withColumn(sk_col, surrogate_key(key, version_col))
        cols = [sk_col, *cols]
    return out.select(*cols)


def scd2_from_snapshots(
    df: DataFrame,
    key: str,
    period: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
    null_safe: bool = False,
    version_col: str = "scd_version",
    sk_col: str | None = "customer_sk",
    order: Sequence[str] | None = None,
    segments: int | None = None,
) -> DataFrame:
    """Spans ``[valid_from, valid_to)`` per ``key``; ``valid_to`` NULL when current.

    ``order`` (default ``[period]``) sorts the snapshots of one key; pass extra
    columns to break ties when a key may repeat within a period.

    Default plan: windows per ``key`` (one shuffle), right when a key's
    snapshots are bounded (unique ``(key, period)``). ``segments=n`` switches to
    the skew-safe segmented scan of ``operators.sequential`` for keys whose row
    count has no bound (sentinel change test only).
    """
    if segments:
        if null_safe:
            raise ValueError("segments= supports the sentinel change test only")
        from quarry.operators.sequential import change_versions, version_spans

        v = change_versions(df, key, list(order or [period]), tracked, segments, start=period)
        out = version_spans(v, key, period, tracked, carried)
        out = out.withColumn(version_col, F.col("version").cast("int"))
        cols = [key, version_col, *tracked, *carried, "valid_from", "valid_to", "is_current"]
        if sk_col:
            out = out.withColumn(sk_col, surrogate_key(key, version_col))
            cols = [sk_col, *cols]
        return out.select(*cols)
    return _spans(
        df, key, period, tracked, carried, null_safe, version_col, sk_col, list(order or [period])
    )


def scd2_merge(
    history: DataFrame,
    snapshots: DataFrame,
    key: str,
    period: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
    null_safe: bool = False,
    version_col: str = "scd_version",
    sk_col: str | None = "customer_sk",
) -> DataFrame:
    """Merge new snapshot periods (all later than the history) into an SCD2 history.

    Closed spans pass through untouched. Each key's current span is re-seeded
    as a pseudo-snapshot (period = its ``valid_from``, its attributes, its
    version) and the same change/version/collapse steps run over seed + new
    periods, continuing the version numbers. Any number of new periods merges
    in one job; the result equals a full rebuild over all periods. A key
    absent from the new periods keeps its open span (gaps are bridged).
    """
    cols = [key, period, *tracked, *carried]
    closed = history.filter(~F.col("is_current"))
    seed = history.filter(F.col("is_current")).select(
        key,
        F.col("valid_from").alias(period),
        *tracked,
        *carried,
        F.col(version_col).alias("_base"),
    )
    new = snapshots.select(*cols, F.lit(None).cast("int").alias("_base"))
    reopened = _spans(
        seed.unionByName(new),
        key,
        period,
        tracked,
        carried,
        null_safe,
        version_col,
        sk_col,
        [period],
        base_col="_base",
    )
    return closed.select(*reopened.columns).unionByName(reopened)


def current_rows(dim: DataFrame, flag: str = "is_current") -> DataFrame:
    """The open span of every key (J03's right side, pre-filtered)."""
    return dim.filter(F.col(flag))
