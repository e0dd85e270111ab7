"""Skew-safe sequential scans per key: lag-change flags, running versions, spans.

``Window.partitionBy(key)`` puts every row of a key in one task. That is fine
when a key's group has a known bound (one customer's monthly snapshots) but not
for raw streams such as events per user, where one user may own a large share
of all rows. Here a key's rows are cut into *segments* instead:

1. ``repartitionByRange(n, key, *order)`` gives each partition a contiguous
   slice of the ``(key, order)`` sequence (bounds come from a sample), so a hot
   key spans several partitions; the partition id is the segment. The rows are
   stored with their segment (a reliable checkpoint), because a second
   evaluation may sample other bounds: rows and summaries must see the same.
2. A window over ``(key, segment)`` computes local lags, local change flags and
   local running counts (a segment is at most ~1/n of the data).
3. A per-segment summary (first row, last row, local change count) gets, over
   a window per key *on the summary* (at most n rows per key), the previous
   segment's last row and the number of changes before the segment.
4. Rows are joined back to their summary on ``(key, segment)`` to correct the first row of each
   segment and offset the running version.

For spans, every row also carries ``next_start``: the start of the first change
row after it (found inside its segment, else from the following segments'
summaries). All rows of a version share it, so one ``groupBy(key, version)``
(partial aggregation: a long span of a hot key is pre-aggregated map-side)
yields ``valid_from``, ``valid_to`` and the attributes together; no window over
a key's spans and no self join are needed.

The change test is the same sentinel test as ``scd2.change_flag``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.fixed import CURRENT_SENTINEL, PREVIOUS_SENTINEL
from quarry.session import ensure_checkpoint_dir, task_count

SEG = "_seg"


def _changed(cur: Sequence[Column], prev: Sequence[Column]) -> Column:
    diffs = [
        F.coalesce(c, F.lit(CURRENT_SENTINEL)) != F.coalesce(p, F.lit(PREVIOUS_SENTINEL))
        for c, p in zip(cur, prev)
    ]
    return F.when(reduce(lambda a, b: a | b, diffs), F.lit(1)).otherwise(F.lit(0))


def change_versions(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    tracked: Sequence[str],
    segments: int | None = None,
    start: str | None = None,
) -> DataFrame:
    """``df`` plus ``prev_<c>`` for each tracked column, ``is_change`` (0/1) and
    ``version`` (running count of changes per key, in ``order``); with ``start``
    also ``next_start``, the ``start`` value of the next change row (NULL if none).

    ``order`` must be a total order within a key (add a unique id to break ties).
    """
    spark = df.sparkSession
    order = list(order)
    ensure_checkpoint_dir(spark)
    # As many segments as asked for, or more if one would hold more rows than a task should sort.
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = task_count(spark, df.count())
    n = max(segments or session, parts if parts > session else 0)
    seg = df.repartitionByRange(n, key, *order).withColumn(SEG, F.spark_partition_id()).checkpoint()
    if parts > session:
        seg = seg.repartition(parts, key, SEG)

    w = Window.partitionBy(key, SEG).orderBy(*order)
    lags = [F.lag(c).over(w) for c in tracked]
    local = seg.select(
        "*",
        *[lag.alias(f"_lag_{c}") for lag, c in zip(lags, tracked)],
        F.row_number().over(w).alias("_pos"),
    )
    local = local.withColumn(
        "_chg", _changed([F.col(c) for c in tracked], [F.col(f"_lag_{c}") for c in tracked])
    ).withColumn("_run", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    if start:
        # Rows after the first of a segment have exact local flags, so the next
        # change inside the segment is found locally.
        local = local.withColumn(
            "_next_local",
            F.first(F.when(F.col("_chg") == 1, F.col(start)), ignorenulls=True).over(
                w.rowsBetween(1, Window.unboundedFollowing)
            ),
        )

    # Segment summaries: first/last tracked values and the local change count.
    order_struct = F.struct(*order)
    vals = F.struct(*[F.col(c).alias(c) for c in tracked])
    extra = []
    if start:
        inner_change = F.when((F.col("_chg") == 1) & (F.col("_pos") >= 2), order_struct)
        extra = [
            F.min_by(F.col(start), order_struct).alias("_first_start"),
            F.min_by(F.col(start), inner_change).alias("_inner_change_start"),
        ]
    summ = local.groupBy(key, SEG).agg(
        F.min_by(vals, order_struct).alias("_first"),
        F.max_by(vals, order_struct).alias("_last"),
        F.sum("_chg").alias("_cnt"),
        *extra,
    )
    ws = Window.partitionBy(key).orderBy(SEG)
    summ = summ.withColumn("_prev_last", F.lag("_last").over(ws))
    first_local = _changed([F.col("_first")[c] for c in tracked], [F.lit(None)] * len(tracked))
    first_fixed = _changed(
        [F.col("_first")[c] for c in tracked], [F.col("_prev_last")[c] for c in tracked]
    )
    summ = summ.withColumn("_delta", first_fixed - first_local).withColumn(
        "_first_fixed", first_fixed
    )
    summ = summ.withColumn(
        "_offset",
        F.coalesce(
            F.sum(F.col("_cnt") + F.col("_delta")).over(
                ws.rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
    keep = [key, SEG, "_prev_last", "_delta", "_first_fixed", "_offset"]
    if start:
        seg_change = F.when(F.col("_first_fixed") == 1, F.col("_first_start")).otherwise(
            F.col("_inner_change_start")
        )
        summ = summ.withColumn(
            "_next_seg_change",
            F.first(seg_change, ignorenulls=True).over(ws.rowsBetween(1, Window.unboundedFollowing)),
        )
        keep.append("_next_seg_change")
    summ = summ.select(*keep)

    j = local.join(summ, [key, SEG], "left")
    first = F.col("_pos") == 1
    out = j.select(
        *df.columns,
        *[
            F.when(first, F.col("_prev_last")[c]).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}")
            for c in tracked
        ],
        F.when(first, F.col("_first_fixed")).otherwise(F.col("_chg")).alias("is_change"),
        (F.col("_offset") + F.col("_run") + F.col("_delta")).cast("long").alias("version"),
        *(
            [F.coalesce(F.col("_next_local"), F.col("_next_seg_change")).alias("next_start")]
            if start
            else []
        ),
    )
    return out


def version_spans(
    versioned: DataFrame,
    key: str,
    start: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
) -> DataFrame:
    """Collapse ``(key, version)`` into spans ``[valid_from, valid_to)``.

    ``versioned`` comes from ``change_versions(..., start=start)``; every row of
    a version carries the next version's start as ``next_start``, so one
    aggregate gives both ends of the span.
    """
    values = list(dict.fromkeys([*tracked, *carried]))
    # Equal rows of a version are put together by hash first: minima of strings sort their input.
    few = versioned.groupBy(key, "version", *values).agg(
        F.min(start).alias("_from"), F.min("next_start").alias("_to")
    )
    spans = few.groupBy(key, "version").agg(
        F.min("_from").alias("valid_from"), F.min("_to").alias("valid_to"), *[F.min(c).alias(c) for c in values]
    )
    return spans.select(
        key, "version", *tracked, *carried, "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
