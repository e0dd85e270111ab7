"""As-of join by a sweep (X01): each fact takes the last span that began before it.

Facts and span starts are united into one sequence per key, ordered by time, a start
before the facts of its own instant. The sequence is cut into *segments* by range
partitions of ``(key, time, ...)``: a hot key, or a hot instant of a key, spans several
of them. Within a segment the last span seen is carried forward by one window; what a
segment's first facts need from before it is the last span of the segments before, known
from one summary row per key and segment. Only a key that crosses a segment's border
takes anything over, so at most one row per segment is broadcast.

Work is that of one sort, facts + spans, whatever the number of spans of a key; an equi
join with a range test would compare every fact with all spans of its key.

The sequence is stored with its segments (a reliable checkpoint): range bounds are
sampled, and the window and the summary must see the same ones.

Spans of one key must not overlap, as those of a Type-2 dimension; spans without any
time in them (``valid_to`` <= ``valid_from``) hold nothing and are left out. Facts without
a key or a time match nothing and are returned as they are, as are those that lie before
the first span, in a gap, or after the last closed one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def asof_sweep(
    facts: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    prefix: str = "",
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    segments: int | None = None,
) -> DataFrame:
    """``facts`` plus ``columns`` of the span valid at ``facts[at]`` (``valid_from <= at < valid_to``)."""
    spark = facts.sparkSession
    ensure_checkpoint_dir(spark)
    n = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))

    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    timed = F.col(key).isNotNull() & F.col(at).isNotNull()
    # Facts of one instant are told apart by a hash, so that range bounds may lie between them.
    arrivals = facts.filter(timed).select(
        F.col(key).alias("key"), F.col(at).alias("time"), F.lit(1).alias("kind"),
        F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]).alias("tie"), fact.alias("fact"),
    )
    held = F.struct(F.col(valid_to).alias("until"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])
    lasting = F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to))
    starts = spans.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull() & lasting).select(
        F.col(key).alias("key"), F.col(valid_from).alias("time"), F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias("tie"), held.alias("span"),
    )
    # Range bounds are sampled, so that whatever comes after the last shuffle is computed twice.
    # That of a dimension may be all of it, and its starts are few.
    starts = starts.checkpoint()
    order = ["time", "kind", "tie"]
    sequence = (
        arrivals.unionByName(starts, allowMissingColumns=True)
        .repartitionByRange(n, "key", *order)
        .withColumn("segment", F.spark_partition_id())
        .checkpoint()
    )

    so_far = Window.partitionBy("key", "segment").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = sequence.withColumn("here", F.last("span", ignorenulls=True).over(so_far)).filter("kind = 1")
    swept = swept.join(F.broadcast(carried_over(sequence)), ["key", "segment"], "left")
    span = F.coalesce("here", "before")
    valid = span["until"].isNull() | (F.col("time") < span["until"])
    matched = swept.select(
        "fact.*", *[F.when(valid, span[f"c{i}"]).alias(prefix + c) for i, c in enumerate(columns)]
    )
    return matched.unionByName(facts.filter(~timed), allowMissingColumns=True)


def carried_over(sequence: DataFrame) -> DataFrame:
    """(key, segment, before): the last span of the segments before, where there is one.

    Segments are contiguous, so only the first key of a segment can have begun before it:
    at most one row per segment.
    """
    # Facts say only which keys a segment holds: none of them is sorted for the last span.
    held = sequence.select("key", "segment").distinct()
    lasts = sequence.filter("kind = 0").groupBy("key", "segment").agg(F.max_by("span", "time").alias("last"))
    summary = held.join(lasts, ["key", "segment"], "left")
    earlier = Window.partitionBy("key").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("last", ignorenulls=True).over(earlier)
    return summary.select("key", "segment", before.alias("before")).filter(F.col("before").isNotNull())
