"""Late snapshots spliced into a Type-2 history (X03), without the old snapshots.

Kept state: the history's spans, and per key the periods that it has a snapshot for
(dates only). A late snapshot row can change its own change flag and that of the next
snapshot of its key, and no other: every other row keeps its predecessor. So the spans of
a key follow from a short sequence of rows: its span starts, the late rows, and for each
late row the next period that the key has a snapshot for, with the attributes of the span
that holds it. Spans of keys without late rows pass through; for the others, the span that
holds a late month is split, or merged with its neighbours, and versions are renumbered.

A late row replaces what the key had for that period, if anything; of several late rows
for one period, the first in the order of their columns stays. Carried attributes (not
tracked) must not vary within a key, as a span keeps only one value of them.

Work is that of the late keys' spans; neither snapshots nor other keys' spans are shuffled
with them (the history is filtered by the late keys' join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.scd2 import _spans


def periods_of(snapshots: DataFrame, key: str, period: str) -> DataFrame:
    """(key, periods): the sorted periods of each key; bounded by the number of periods."""
    return snapshots.groupBy(key).agg(F.array_sort(F.collect_set(period)).alias("periods"))


def with_periods(known: DataFrame, more: DataFrame, key: str) -> DataFrame:
    """``known`` (key, periods) with the periods of ``more``."""
    both = known.withColumnRenamed("periods", "old").join(more.withColumnRenamed("periods", "new"), key, "full")
    none = F.array().cast(known.schema["periods"].dataType)
    return both.select(
        key, F.array_sort(F.array_union(F.coalesce("old", none), F.coalesce("new", none))).alias("periods")
    )


def splice_late(
    history: DataFrame,
    periods: DataFrame,
    late: DataFrame,
    key: str,
    period: str,
    tracked: Sequence[str],
    carried: Sequence[str] = (),
    null_safe: bool = False,
    version_col: str = "scd_version",
    sk_col: str | None = "customer_sk",
) -> tuple[DataFrame, DataFrame]:
    """The history and periods with the ``late`` snapshot rows in their places."""
    values = [*tracked, *carried]
    one = Window.partitionBy(key, period).orderBy(*values)
    late = late.select(key, period, *values).withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n")
    came = periods_of(late, key, period)
    known = with_periods(periods, came, key)

    late_keys = came.select(key)
    touched = history.join(late_keys, key, "left_semi")
    rest = history.join(late_keys, key, "left_anti")

    # The period after each late one, where the key has a snapshot that isn't late itself.
    both = known.join(came.withColumnRenamed("periods", "came"), key)
    after = both.select(key, "periods", "came", F.explode("came").alias("_late")).select(
        key, "came", F.array_min(F.filter("periods", lambda p: p > F.col("_late"))).alias("_next")
    )
    after = after.filter(F.col("_next").isNotNull() & ~F.array_contains("came", F.col("_next")))
    after = after.select(key, "_next").distinct()
    spans = touched.select(key, "valid_from", "valid_to", *values)
    inside = (F.col("_next") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("_next") < F.col("valid_to")))
    successors = after.join(spans, key).filter(inside).select(key, F.col("_next").alias(period), *values)

    starts = spans.select(key, F.col("valid_from").alias(period), *values)
    old = starts.unionByName(successors).dropDuplicates([key, period])
    old = old.join(late.select(key, period), [key, period], "left_anti")
    again = _spans(old.unionByName(late), key, period, tracked, carried, null_safe, version_col, sk_col, [period])
    return rest.select(*again.columns).unionByName(again), known
