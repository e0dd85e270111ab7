"""Checks as kept state: uniqueness and relationships without rescanning whole tables.

``KeyIndex`` (K01, K04, K07, K14, K20): a table bucketed and sorted by key with the keys
of all batches. A batch is reduced to its distinct keys with counts and probes the index
by a sort-merge join whose index side needs no shuffle; it appends one row per key with
the key's rows so far. Keys of more than one row are kept apart, so that ``offenders``
doesn't read the index.

``OpenOrphans`` (J08, K10, K17, K23, K28, K31): child keys without a parent so far, with
their row counts. A batch of children tests its distinct keys against the index of parent
keys; a batch of parents closes the open orphans that it brings. Neither rescans the
children or parents of earlier batches.

Safe to run again: a batch number that was committed is skipped; a batch that failed
before its commit computes the same rows again, from what was there before it, and rows
that it had appended say the same (a key's largest count stands).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources import parquet
from quarry.streaming.generations import GenerationTable


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """(key, n) of the non-null values of a column."""
    keys = df.select(F.col(column).cast("string").alias("key")).filter(F.col("key").isNotNull())
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


class KeyIndex:
    """Keys seen in any batch, with their row counts; null keys are no keys."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        """``name``: catalog name of the index; its files and the duplicates lie under ``path``."""
        self.spark, self.name, path = spark, name, path.rstrip("/")
        if not spark.catalog.tableExists(name):
            spark.sql(
                f"CREATE TABLE {name} (key STRING, n BIGINT, batch BIGINT) USING parquet "
                f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}/keys'"
            )
        # An index keeps the buckets that it was created with.
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Num Buckets'")
        self.buckets = int(described.first()["data_type"])
        self.repeated = GenerationTable(spark, f"{path}/repeated", "key", ["n"])

    def last_batch(self) -> int:
        return self.repeated.state().batch

    def entries(self, before: int) -> DataFrame:
        """(key, n): rows so far of every key of the batches before ``before``."""
        rows = self.spark.table(self.name).filter(F.col("batch") < before)
        return rows.groupBy("key").agg(F.max("n").alias("seen"))

    def add(self, df: DataFrame, column: str, batch: int | None = None) -> bool:
        """Take in the keys of a batch; False if ``batch`` was taken in before."""
        batch = self.last_batch() + 1 if batch is None else batch
        if batch <= self.last_batch():
            return False
        keys = key_counts(df, column)
        total = F.col("n") + F.coalesce("seen", F.lit(0))
        counted = keys.join(self.entries(batch).hint("merge"), "key", "left").select("key", total.alias("n")).checkpoint()
        (
            counted.withColumn("batch", F.lit(batch).cast("bigint"))
            .repartition(self.buckets, "key")
            .write.mode("append").bucketBy(self.buckets, "key").sortBy("key").format("parquet").saveAsTable(self.name)
        )
        return self.repeated.merge(counted.filter("n > 1"), batch)  # the commit

    def offenders(self) -> DataFrame:
        """(key, n_records) of the keys that occur more than once."""
        return self.repeated.read().withColumnRenamed("n", "n_records")

    def missing(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of ``keys`` (key, ...) whose key was never seen (before batch ``before``)."""
        seen = self.entries(self.last_batch() + 1 if before is None else before)
        return keys.join(seen.select("key").hint("merge"), "key", "left_anti")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class OpenOrphans:
    """Child keys that no parent has had so far, over a ``KeyIndex`` of parent keys."""

    LOG = "version long, batch long, path string"

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.parents = KeyIndex(spark, name, f"{self.path}/parents", buckets)

    def _state(self):
        return parquet.newest(parquet.read_log(self.spark, f"{self.path}/log", self.LOG))

    def _open(self, state) -> DataFrame:
        schema = "key string, n long"
        if state is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(state.path)

    def add(
        self,
        children: tuple[DataFrame, str] | None = None,
        parents: tuple[DataFrame, str] | None = None,
        batch: int | None = None,
    ) -> bool:
        """Take in a batch of (children, column), (parents, column) or both; False if it was before."""
        state = self._state()
        last = state.batch if state else -1
        batch = last + 1 if batch is None else batch
        if batch <= last:
            return False
        rows = self._open(state)
        if parents is not None:
            # Parents that a failed attempt took in already are skipped here; the open
            # orphans are tested against this batch's again.
            self.parents.add(*parents, batch)
            rows = rows.join(key_counts(*parents).select("key"), "key", "left_anti")
        if children is not None:
            new = self.parents.missing(key_counts(*children))
            rows = rows.unionByName(new).groupBy("key").agg(F.sum("n").alias("n"))
        path = f"{self.path}/open/{batch}"
        rows.write.mode("overwrite").parquet(path)
        row = ((state.version if state else 0) + 1, batch, path)
        parquet.append_log(self.spark, f"{self.path}/log", self.LOG, row)
        return True

    def offenders(self) -> DataFrame:
        """(key, _rows) of child keys without a parent, with their rows."""
        return self._open(self._state()).withColumnRenamed("n", "_rows")

    def drop(self) -> None:
        self.parents.drop()
