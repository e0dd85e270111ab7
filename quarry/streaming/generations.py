"""X02 by generations: keep-latest silver whose batches append what they bring.

A table is a *base* and a list of *deltas*, one per merged batch:

* ``merge`` normalises a batch, keeps its latest row per key and writes that as a new
  delta; the base is not read or rewritten. The first delta is the base. When the deltas together hold more than
  ``fold_share`` of the base's rows, base and deltas are folded into a new base.
* ``read`` keeps the latest over base and deltas (a total order, so this equals a
  rebuild from all batches, in whatever order they came).

Writes are in proportion to what comes in, whatever the size of the table: a row is
written once as a delta, and a fold of base B and deltas D > fold_share * B writes
B + D < D * (1 + 1 / fold_share) rows, so all folds together write less than that many
times the rows that all batches brought. With the default share that is at most 4 rows
written per row merged, against a rewrite of every bucket per batch.

The state of the table is the newest row of its log (one small file per commit, kept in
a folder of Parquet files): version, base, deltas and the last batch. A commit appears
with that file, after everything that it names is complete. A batch that fails before
its commit leaves the table as it was, and is written over when it is run again; a batch
whose number is not above the last committed one was merged before and is skipped.
Streams pass their epoch, which grows by one per micro-batch. There is one writer at a
time, as a streaming query is; a reader may hold the old state while a new one is
committed, as nothing is overwritten. ``stale`` names what no state uses any more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.dedup import keep_latest
from quarry.session import ensure_checkpoint_dir
from quarry.sources import parquet

LOG_SCHEMA = "version long, base string, base_rows long, deltas array<struct<path:string,rows:long>>, batch long"


@dataclass(frozen=True)
class State:
    version: int = 0
    base: str | None = None
    base_rows: int = 0
    deltas: tuple[tuple[str, int], ...] = ()
    batch: int = -1


@dataclass
class Writes:
    """Rows written by merges of this object, for its owner to watch."""

    merged: int = 0
    appended: int = 0
    folded: int = 0
    per_batch: list[int] = field(default_factory=list)


class GenerationTable:
    """A keep-latest table maintained by appended generations."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str | Sequence[str],
        latest_by: Sequence[str],
        normalize: Callable[[DataFrame], DataFrame] = lambda df: df,
        fold_share: float = 0.5,
    ) -> None:
        if fold_share <= 0:
            raise ValueError("fold_share has to be above 0")
        ensure_checkpoint_dir(spark)
        self.spark, self.path, self.fold_share = spark, path.rstrip("/"), fold_share
        self.key = [key] if isinstance(key, str) else list(key)
        self.latest_by, self.normalize = list(latest_by), normalize
        self.writes = Writes()

    # -------------------------------------------------------------- state
    def state(self, before: int | None = None) -> State:
        """The newest committed state (of the batches before ``before``); an empty one if there is none."""
        log = self._log()
        r = parquet.newest(log if before is None else log.filter(F.col("batch") < before))
        if r is None:
            return State()
        return State(r.version, r.base, r.base_rows, tuple((d.path, d.rows) for d in r.deltas), r.batch)

    def _log(self) -> DataFrame:
        return parquet.read_log(self.spark, f"{self.path}/log", LOG_SCHEMA)

    def _commit(self, state: State) -> None:
        row = (state.version, state.base, state.base_rows, list(state.deltas), state.batch)
        parquet.append_log(self.spark, f"{self.path}/log", LOG_SCHEMA, row)

    def _write(self, df: DataFrame, name: str) -> tuple[str, int]:
        """``df`` written as a generation (over what a failed attempt left) and its rows."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return path, self.spark.read.parquet(path).count()  # from the files' footers

    # -------------------------------------------------------------- reads
    def generations(self, state: State) -> DataFrame | None:
        """The rows of all generations: each of them holds a key once."""
        paths = [p for p in (state.base, *(p for p, _ in state.deltas)) if p]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, before: int | None = None, like: DataFrame | None = None) -> DataFrame:
        """The current table, or as it was before batch ``before`` (unless that was vacuumed).
        With deltas, the latest row per key: each task passes one row per key on, before the
        shuffle. A table without a batch has the columns of ``like``."""
        state = self.state(before)
        rows = self.generations(state)
        if rows is None:
            if like is None:
                raise ValueError(f"{self.path} holds no batch yet")
            return like.limit(0)
        return self._folded(rows) if state.deltas else rows

    def _folded(self, rows: DataFrame) -> DataFrame:
        """The latest row per key of several generations. A key has at most one row in each, so
        rows are shuffled as they are and sorted once, after it."""
        return keep_latest(rows.repartition(*self.key), self.key, self.latest_by)

    # -------------------------------------------------------------- writes
    def delta(self, batch: DataFrame, number: int, unique: bool = False) -> DataFrame:
        """The latest rows of batch ``number``, written as its delta (over what a failed attempt
        left) but not committed; those of a batch that was merged before are read as they are."""
        path = f"{self.path}/delta/{number}"
        if number > self.state().batch or not parquet.exists(self.spark, path):
            rows = self.normalize(batch)
            self._write(rows if unique else keep_latest(rows, self.key, self.latest_by), f"delta/{number}")
        return self.spark.read.parquet(path)

    def merge(
        self, batch: DataFrame, number: int | None = None, unique: bool = False, delta: DataFrame | None = None
    ) -> bool:
        """Append the batch's latest rows; False if batch ``number`` was merged before.

        ``unique``: the batch holds a key once already. ``delta``: what ``delta`` wrote of it.
        """
        state = self.state()
        if number is None:
            number = state.batch + 1
        if number <= state.batch:
            return False
        if delta is None:
            delta = self.delta(batch, number, unique)
        added = (f"{self.path}/delta/{number}", delta.count())  # from the files' footers
        version = state.version + 1
        written = added[1]
        deltas = (*state.deltas, added)
        new = State(version, state.base, state.base_rows, deltas, number)
        if state.base is None:
            new = State(version, *added, (), number)
        elif sum(n for _, n in deltas) > self.fold_share * state.base_rows:
            base, rows = self._write(self._folded(self.generations(new)), f"base/{version}")
            new = State(version, base, rows, (), number)
            written += rows
            self.writes.folded += rows
        self._commit(new)
        self.writes.merged += 1
        self.writes.appended += added[1]
        self.writes.per_batch.append(written)
        return True

    def stale(self) -> list[str]:
        """Generations of earlier states that the newest one doesn't use: they may be deleted
        when no reader holds an earlier state any more. At most two paths per commit."""
        state = self.state()
        live = {state.base, *(p for p, _ in state.deltas)}
        named = self._log().select(F.explode(F.concat(F.array("base"), F.col("deltas.path"))).alias("path"))
        return sorted(r.path for r in named.distinct().collect() if r.path and r.path not in live)

    def vacuum(self) -> int:
        """Delete the stale generations; how many there were."""
        return sum(parquet.delete_folder(self.spark, path) for path in self.stale())


def merge_stream(stream: DataFrame, table: GenerationTable, checkpoint: str) -> int:
    """Merge every micro-batch of a streaming ``DataFrame``, until its files are used up.

    Returns how many were merged. A micro-batch that is replayed after its commit is skipped.
    """
    merged = []

    def apply(batch: DataFrame, epoch: int) -> None:
        if table.merge(batch, epoch):
            merged.append(epoch)

    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(merged)
