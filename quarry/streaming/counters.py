"""Mergeable counters per stream and batch (M14, M15), and the policy mart by touched policies.

``StreamCounters`` keeps one row of counts per batch: bronze rows as they were sent, and
silver rows, with their flags, by the batch that the surviving copy came with. Where a
row replaces a stored winner, the winner's batch loses what it counted for (a row of
negative counts), so sums over all rows are those of a recount, and a report is a sum of
a few small rows.

``PolicyMart`` keeps the mart's aggregates per policy. A batch recomputes the policies
that its rows touch, those of the winners that it replaces included, from the stored facts
of these policies; reads take each policy's newest aggregates.

Both are safe to run again: they compare with the winners of the state before a batch,
whether or not a failed attempt has stored its own, and a batch number that was committed
is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.dedup import latest_order
from quarry.plans import silver
from quarry.plans.gold import gold_policy_performance
from quarry.sources import parquet
from quarry.streaming.generations import GenerationTable

LOG = "version long, batch long"


class StreamCounters:
    """Counts of a stream of batches, equal to a recount of bronze and silver."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        latest_by: Sequence[str],
        normalize: Callable[[DataFrame], DataFrame],
        flags: dict[str, Column],
    ) -> None:
        """``flags``: counters by name; each counts the winning rows for which it is true."""
        self.spark, self.path, self.key, self.latest_by = spark, path.rstrip("/"), key, list(latest_by)
        self.normalize, self.flags = normalize, flags
        self.winners = GenerationTable(spark, f"{self.path}/winners", key, latest_by, normalize)

    def _counts(self, rows: DataFrame) -> DataFrame:
        """Counts by batch of rows with a ``_sign``: 1 for a winner, -1 for one that it replaces."""
        flags = [F.sum(F.when(flag, F.col("_sign")).otherwise(0)).alias(name) for name, flag in self.flags.items()]
        return rows.groupBy("_batch").agg(F.sum("_sign").alias("silver_rows"), *flags)

    def _changes(self, new: DataFrame, number: int) -> DataFrame:
        """The winners among the keys of ``new`` with ``_sign`` 1, and those before it with -1.

        Stored generations and ``new`` hold a key once each: all are shuffled and sorted once.
        A winner that stays is there with both signs. A null key replaces nothing.
        """
        stored = self.winners.generations(self.winners.state(before=number))
        if stored is None:
            return new.withColumn("_sign", F.lit(1))
        stored = stored.filter(F.col(self.key).isNotNull())
        both = stored.withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
        of_key = Window.partitionBy(self.key)
        order = of_key.orderBy(*latest_order(new, [self.key], self.latest_by))
        older = F.sum(F.when(F.col("_new"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
        ranked = both.repartition(self.key).withColumns(
            {"_rank": F.row_number().over(order), "_older": older, "_touched": F.max("_new").over(of_key)}
        )
        wins = F.when(F.col("_rank") == 1, F.lit(1))
        replaced = F.when(~F.col("_new") & (F.col("_older") == 1), F.lit(-1))
        signs = F.filter(F.array(wins, replaced), lambda s: s.isNotNull())
        return ranked.filter("_touched").withColumn("_sign", F.explode(signs)).select(*new.columns, "_sign")

    def merge(self, bronze: DataFrame, number: int | None = None) -> bool:
        """Count a batch of bronze rows; False if it was counted before."""
        last = parquet.newest(parquet.read_log(self.spark, f"{self.path}/log", LOG))
        done = last.batch if last else -1
        number = done + 1 if number is None else number
        if number <= done:
            return False
        new = self.winners.delta(bronze, number)
        sent = bronze.groupBy("_batch").agg(F.count(F.lit(1)).alias("bronze_rows"))
        change = sent.unionByName(self._counts(self._changes(new, number)), allowMissingColumns=True)
        names = [c for c in change.columns if c != "_batch"]
        change = change.groupBy("_batch").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
        change.withColumn("number", F.lit(number).cast("bigint")).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/counts/number={number}"
        )
        self.winners.merge(bronze, number, delta=new)
        parquet.append_log(self.spark, f"{self.path}/log", LOG, ((last.version if last else 0) + 1, number))
        return True

    def per_batch(self) -> DataFrame:
        """One row of counts per batch of the stream."""
        last = parquet.newest(parquet.read_log(self.spark, f"{self.path}/log", LOG))
        if last is None:
            raise ValueError(f"{self.path} holds no batch yet")
        rows = self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.path}/counts")
        rows = rows.filter(F.col("number") <= last.batch)
        names = ["bronze_rows", "silver_rows", *self.flags]
        return rows.groupBy("_batch").agg(*[F.sum(c).alias(c) for c in names])

    def totals(self) -> DataFrame:
        """One row: the sums over all batches."""
        names = ["bronze_rows", "silver_rows", *self.flags]
        return self.per_batch().agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names])


def reconciliation(streams: dict[str, StreamCounters]) -> DataFrame:
    """M14 from counters with a flag ``late_arrival_rows``: one small sum per stream."""
    out = None
    for name, counters in streams.items():
        row = counters.totals().select(
            F.lit(name).alias("stream"), "bronze_rows", "silver_rows",
            (F.col("bronze_rows") - F.col("silver_rows")).alias("duplicates_removed"), "late_arrival_rows",
        )
        out = row if out is None else out.unionByName(row)
    return out


class PolicyMart:
    """The policy performance mart, kept up to date by the policies that a batch touches."""

    TOTALS = ["premiums_due", "premiums_paid", "premium_collected", "claims_filed", "claims_paid", "loss_ratio"]

    def __init__(self, spark: SparkSession, path: str) -> None:
        path = path.rstrip("/")
        latest = silver.FACT_LATEST_BY
        self.payments = GenerationTable(spark, f"{path}/payments", "payment_id", latest, silver.normalized_payments)
        self.claims = GenerationTable(spark, f"{path}/claims", "claim_id", latest, silver.normalized_claims)
        self.totals = GenerationTable(spark, f"{path}/totals", "policy_id", ["number"])

    @staticmethod
    def _touched(table: GenerationTable, key: str, new: DataFrame, number: int) -> DataFrame:
        """Policies of a batch's latest rows and of the stored rows that they may replace."""
        stored = table.generations(table.state(before=number))
        if stored is None:
            return new.select("policy_id")
        replaced = stored.select(key, "policy_id").join(new.select(key), key, "left_semi")
        return new.select("policy_id").union(replaced.select("policy_id"))

    def merge(self, payments: DataFrame, claims: DataFrame, number: int | None = None) -> bool:
        """Take in a batch of bronze payments and claims; False if it was taken in before."""
        done = self.totals.state().batch
        number = done + 1 if number is None else number
        if number <= done:
            return False
        touched = None
        for table, key, batch in ((self.payments, "payment_id", payments), (self.claims, "claim_id", claims)):
            new = table.delta(batch, number)
            policies = self._touched(table, key, new, number)
            touched = policies if touched is None else touched.union(policies)
            table.merge(batch, number, delta=new)
        touched = touched.filter(F.col("policy_id").isNotNull()).distinct().checkpoint()
        facts = [t.read().join(touched, "policy_id", "left_semi") for t in (self.payments, self.claims)]
        # The mart of these policies alone; what describes a policy is joined when it is read.
        names = ["customer_id", "product_line", "status", "currency", "premium_amount", "sum_assured"]
        bare = touched.select("policy_id", *[F.lit(None).cast("string").alias(c) for c in names])
        rows = gold_policy_performance(bare, *facts).select("policy_id", *self.TOTALS)
        return self.totals.merge(rows.withColumn("number", F.lit(number).cast("bigint")), number, unique=True)

    def read(self, policies: DataFrame) -> DataFrame:
        """The mart of ``policies``, as a rebuild from all batches gives it."""
        none = gold_policy_performance(policies, self.payments.read().limit(0), self.claims.read().limit(0))
        kept = self.totals.read().select("policy_id", *[F.col(c).alias(f"_{c}") for c in self.TOTALS])
        values = [F.coalesce(f"_{c}", c).alias(c) for c in self.TOTALS]
        others = [c for c in none.columns if c not in self.TOTALS]
        return none.join(kept, "policy_id", "left").select(*others, *values).select(*none.columns)
