"""Incremental silver with late-arrival backfill; X03: SCD2 snapshot merge.

Incremental keep-latest silver
------------------------------
The stored silver table is partitioned so that every copy of a key, early or
late, lives in one partition folder. The default partition is a hash bucket of
the key (``pmod(xxhash64(key), n)``; ``n`` is stored beside the table and stays,
whatever a later caller asks for): always correct, but a batch with more keys
than buckets touches every bucket. When the key determines the event date (a
re-send repeats the same business event), pass ``partition=`` an event-month
expression instead: a monthly batch then touches only the few months it
carries (on-time plus late arrivals), which is what makes the merge incremental
at scale. A new batch is merged by

1. normalising it, keeping its latest row per key (a key re-sent many times is
   reduced before any shuffle) and storing that with its buckets, once per batch;
2. reading only the stored partitions whose bucket occurs in the batch (the
   touched bucket ids, at most ``n`` small ints, become a partition filter);
3. ``keep_latest`` over stored + new rows (a total order, so merging batch by
   batch equals one global rebuild). Now a key has two rows at most: rows are
   shuffled once, to *slots* of one bucket and some of its keys each, of about
   ``TASK_ROWS`` rows, and a slot is what one task sorts and writes;
4. overwriting just those partitions (dynamic partition overwrite): the new files are
   written beside the table and put in place when the job that reads the old ones is over.

``stream_silver`` drives the same merge from a Structured Streaming file source
over the landing folder with ``foreachBatch``: each micro-batch is one merge,
and the stream's checkpoint makes a restart resume after the last committed
batch. A re-run of a micro-batch after a failure rewrites the same partitions
with the same rows (idempotent).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.operators.dedup import keep_latest
from quarry.operators.scd2 import scd2_from_snapshots, scd2_merge
from quarry.session import TASK_ROWS, ensure_checkpoint_dir, shared_dir
from quarry.sources import parquet

BUCKET = "_bucket"  # storage partition column of an incremental table
SLOT = "_slot"  # what one task of a merge sorts and writes


def bucket_of(key: str, n: int):
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n)).cast("int")


def in_slots(df: DataFrame, key: str, counts: dict, per_slot: int = TASK_ROWS) -> DataFrame:
    """``df`` with a column ``SLOT``, dealt by it: the rows of a bucket go to as many slots as
    ``counts`` asks for, by a hash of their key, and each slot is one partition."""
    kind = df.schema[BUCKET].dataType
    slots = {b: max(1, -(-n // per_slot)) for b, n in counts.items()}
    first, total = {}, 0
    for b, n in slots.items():
        first[b], total = total, total + n

    def of(values: dict) -> Column:
        known = [x for b, v in values.items() if b is not None for x in (F.lit(b).cast(kind), F.lit(v))]
        here = F.element_at(F.create_map(*known), F.col(BUCKET)) if known else F.lit(None)
        return F.coalesce(here, F.lit(values.get(None, 0)))

    # Another seed than that of `bucket_of`, whose hash is the same for all keys of a bucket.
    own = F.pmod(F.xxhash64(F.lit(1), F.col(key)), of(slots)).cast("int")
    return df.withColumn(SLOT, of(first) + own).repartitionById(max(1, total), SLOT)


class IncrementalSilver:
    """A keep-latest silver table maintained batch by batch."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        latest_by: Sequence[str],
        normalize: Callable[[DataFrame], DataFrame],
        buckets: int = 64,
        partition=None,
    ) -> None:
        """``partition``: optional Column giving a row's storage partition; it must
        be a function of the key (all copies of a key in one partition)."""
        self.spark, self.path, self.key = spark, path, key
        self.latest_by, self.normalize = list(latest_by), normalize
        ensure_checkpoint_dir(spark)
        self.buckets = self._stored_buckets(buckets)
        self.partition = partition if partition is not None else bucket_of(key, self.buckets)

    def _stored_buckets(self, wanted: int) -> int:
        """The number of buckets that the table was created with; ``wanted`` for a new one."""
        layout = f"{self.path.rstrip('/')}_layout"
        if not self._exists(layout):
            self.spark.createDataFrame([(wanted,)], "buckets int").write.mode("overwrite").parquet(layout)
        return self.spark.read.parquet(layout).first()["buckets"]

    def _exists(self, path: str | None = None) -> bool:
        """True once the path has been written (a missing path is the only
        error treated as "not yet"; anything else propagates)."""
        try:
            self.spark.read.parquet(path or self.path).schema
            return True
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
                return False
            raise

    def read(self) -> DataFrame:
        """The current silver table (without the bucket column)."""
        return self.spark.read.parquet(self.path).drop(BUCKET)

    def merge(self, bronze_batch: DataFrame) -> None:
        batch = keep_latest(self.normalize(bronze_batch), [self.key], self.latest_by)
        staged = shared_dir(self.spark, "batches")
        batch.withColumn(BUCKET, self.partition).write.parquet(staged)  # read twice below
        new = rows = self.spark.read.parquet(staged)
        # The touched partition ids (at most `buckets`, or the months a batch
        # carries: a small bound) become a partition filter, so only touched
        # folders are read and rewritten.
        merge = self._exists()
        if merge:
            touched = [r[0] for r in new.select(BUCKET).distinct().collect()]
            stored = self.spark.read.parquet(self.path).filter(F.col(BUCKET).isin(touched))
            rows = stored.select(*new.columns).unionByName(new)
        counts = {r[0]: r[1] for r in rows.groupBy(BUCKET).agg(F.count(F.lit(1))).collect()}
        dealt = in_slots(rows, self.key, counts)
        if merge:
            dealt = keep_latest(dealt, [BUCKET, SLOT, self.key], self.latest_by)
        (
            dealt.drop(SLOT).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
        parquet.delete_folder(self.spark, staged)


def stream_silver(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: IncrementalSilver,
    checkpoint: str,
    files_per_trigger: int = 12,
) -> int:
    """Run the file-source stream over ``landing`` until all files are merged.

    Returns the number of micro-batches committed in this run.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(landing)
    )
    count = {"n": 0}

    def apply(batch: DataFrame, epoch_id: int) -> None:
        table.merge(batch)
        count["n"] += 1

    q = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()
    return count["n"]


def disagreeing_keys(
    history: DataFrame, late: DataFrame, key: str, period: str, tracked: Sequence[str]
) -> DataFrame:
    """Keys with a late snapshot row that the history does not already say."""
    spans = history.select(key, "valid_from", "valid_to", *[F.col(c).alias(f"_h_{c}") for c in tracked])
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    p = F.col(period)
    holds = (p >= F.col("valid_from")) & (F.col("valid_to").isNull() | (p < F.col("valid_to")))
    # One join by key; its rows are put together where they are.
    said = late.join(spans, key, "left").groupBy(key, period).agg(F.max(holds & same).alias("_said"))
    return said.filter(~F.coalesce("_said", F.lit(False))).select(key).distinct()


def merge_snapshot_periods(
    history: DataFrame,
    snapshots: DataFrame,
    period: str,
    slices: Sequence[tuple[str, str | None]],
    through: str | None = None,
    **scd2_args,
) -> DataFrame:
    """Merge snapshot periods into a stored history in consecutive slices.

    A slice is ``[start, end)`` (``YYYY-MM-DD``; no end: open). ``through`` is the last
    period that the history holds; without it the first slice's start is taken to follow
    the history. Closed spans never change when later periods come, so a step carries
    only the open spans forward (plus the spans it closes, which are appended to the
    closed set): it costs O(keys + changes), not O(history). Each step is checkpointed
    into the shared folder, so lineage stays one step deep, as between scheduled runs.

    Periods up to the last merged one are not merged again. Rows of such a late or
    repeated period that the history already says change nothing, so merging a slice
    twice equals merging it once; customers for whom it says otherwise are rebuilt from
    all their snapshots so far.
    """
    ensure_checkpoint_dir(history.sparkSession)
    key, tracked = scd2_args["key"], scd2_args["tracked"]
    d = F.col(period)
    closed = history.filter(~F.col("is_current"))
    current = history.filter(F.col("is_current"))
    for start, end in slices:
        part = snapshots.filter(d >= F.lit(start).cast("date"))
        if end:
            part = part.filter(d < F.lit(end).cast("date"))
        new = part
        if through is not None:
            last = F.lit(through).cast("date")
            new, late = part.filter(d > last), part.filter(d <= last)
            known = closed.select(*current.columns).unionByName(current)
            wrong = disagreeing_keys(known, late, key, period, tracked).checkpoint(eager=True)
            if not wrong.isEmpty():
                again = scd2_from_snapshots(
                    snapshots.filter(d <= last).join(wrong, key, "left_semi"), period=period, **scd2_args
                ).select(*current.columns)
                known = known.join(wrong, key, "left_anti").unionByName(again).checkpoint(eager=True)
                closed, current = known.filter(~F.col("is_current")), known.filter(F.col("is_current"))
        merged_to = new.agg(F.max(d).cast("string")).first()[0]  # one date
        if merged_to is None:
            continue
        step = scd2_merge(current, new, period=period, **scd2_args).checkpoint(eager=True)
        closed = closed.select(*step.columns).unionByName(step.filter(~F.col("is_current")))
        current = step.filter(F.col("is_current"))
        through = merged_to
    return closed.select(*current.columns).unionByName(current)
