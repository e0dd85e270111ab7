"""Steps whose work has to grow no faster than their input: what they read, sort and write once."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.asof import asof_sweep
from quarry.operators.dedup import keep_latest
from quarry.plans import queries
from quarry.streaming import incremental
from quarry.streaming.counters import PolicyMart, StreamCounters
from quarry.streaming.generations import GenerationTable
from quarry.streaming.kept_checks import KeyIndex
from tests.conftest import SF_SMALL, canon


@pytest.fixture
def no_checkpoint(monkeypatch):
    """Whole rows kept uncompressed are an error."""
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **b: (_ for _ in ()).throw(AssertionError("checkpoint")))


def keyed(spark, n: int, seen: int):
    return spark.range(n).select(
        F.concat(F.lit("k"), "id").alias("id"), F.lit(seen).alias("seen"), (F.col("id") % 7).alias("v")
    )


def test_a_merge_replaces_the_files_that_it_reads(spark, tmp_path, no_checkpoint):
    table = incremental.IncrementalSilver(spark, str(tmp_path / "t"), "id", ["seen"], lambda df: df, buckets=3)
    first, second = keyed(spark, 300, 1), keyed(spark, 300, 2).filter("v < 2")
    for batch in (first, second.unionByName(second), first.limit(5)):
        table.merge(batch)
    want = keep_latest(first.unionByName(second), ["id"], ["seen"])
    assert canon(table.read().select("id", "seen", "v").collect()) == canon(want.collect())


def test_a_hot_bucket_has_several_slots_and_a_slot_one_bucket(spark):
    rows = keyed(spark, 1000, 1).withColumn("_bucket", F.when(F.col("v") < 5, 7).when(F.col("v") == 5, 8))
    counts = {r[0]: r[1] for r in rows.groupBy("_bucket").count().collect()}
    dealt = incremental.in_slots(rows, "id", counts, per_slot=100).withColumn("_part", F.spark_partition_id())
    slots = dealt.groupBy("_slot").agg(
        F.count("*").alias("n"), F.count_distinct(F.coalesce("_bucket", F.lit(-1))).alias("b"), F.count_distinct("_part").alias("p")
    ).collect()
    assert len(slots) == sum(-(-n // 100) for n in counts.values())
    assert sum(s.n for s in slots) == 1000 and max(s.n for s in slots) < 200
    assert {(s.b, s.p) for s in slots} == {(1, 1)}


def test_the_first_generation_is_written_once(spark, tmp_path):
    table = GenerationTable(spark, str(tmp_path / "t"), "id", ["seen"])
    table.merge(keyed(spark, 50, 1), 0)
    assert table.writes.per_batch == [50] and not table.state().deltas
    table.merge(keyed(spark, 20, 2), 1)
    assert canon(table.read().groupBy("seen").count().collect()) == canon([(1, 30), (2, 20)])


def test_counters_take_a_batch_in_without_copies_of_it(spark, tmp_path, no_checkpoint):
    flags = {"odd": F.col("v") % 2 == 1}
    kept = StreamCounters(spark, str(tmp_path / "c"), "id", ["seen"], lambda df: df, flags)
    first = keyed(spark, 70, 1).withColumn("_batch", F.lit(1))
    kept.merge(first, 0)
    kept.merge(keyed(spark, 14, 2).withColumn("_batch", F.lit(2)), 1)
    kept.merge(keyed(spark, 7, 0).withColumn("_batch", F.lit(3)), 2)  # loses
    got = {r["_batch"]: (r.bronze_rows, r.silver_rows, r.odd) for r in kept.per_batch().collect()}
    assert got == {1: (70, 56, 24), 2: (14, 14, 6), 3: (7, 0, 0)}


def test_the_mart_normalises_a_batch_once(spark, small_layers, tmp_path):
    mart, calls = PolicyMart(spark, str(tmp_path / "m")), []
    for table in (mart.payments, mart.claims):
        table.normalize = lambda df, f=table.normalize: calls.append(1) or f(df)
    b = small_layers.bronze
    mart.merge(b["premium_payments"], b["claims"])
    assert len(calls) == 2


def test_a_sweep_computes_its_spans_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(k):
        read.add(1)
        return ("a", k, k + 1, k)

    spans = spark.createDataFrame(spark.sparkContext.parallelize(range(100), 2).map(counted), "k string, valid_from long, valid_to long, v long")
    facts = spark.range(300).select(F.lit("a").alias("k"), (F.col("id") % 100).alias("at"))
    assert asof_sweep(facts, spans, "k", "at", ["v"]).filter("v = at").count() == 300
    assert read.value == 100


@pytest.mark.parametrize("kind", ["k_not_null", "k_unique"])
def test_checks_store_no_whole_rows(spark, no_checkpoint, kind):
    got = queries.all_queries()[kind](spark, SF_SMALL)
    assert got.filter("violations <> 0").count() == 0
    assert "silver_premium_payments" in str(got.inputFiles()) and "gold_" not in str(got.inputFiles())


def test_a_kept_check_deals_stored_keys(spark, monkeypatch):
    plans, add = [], KeyIndex.add

    def seen(self, df, column, batch=None):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return add(self, df, column, batch)

    monkeypatch.setattr(KeyIndex, "add", seen)
    assert queries.all_queries()["k_unique_kept"](spark, SF_SMALL).filter("violations <> 0").count() == 0
    assert len(plans) == 4 * queries.KEPT_BATCHES and not any("Window" in p for p in plans)


def test_facts_are_sorted_and_shuffled_without_their_flags(spark):
    """What follows from a fact's other columns is computed for the rows that stay."""
    from quarry.plans.layers import from_driver_tables

    s = from_driver_tables(spark, "/root/testdata/sf0.001").silver
    flags = {"payment": ("is_paid", "is_late_arrival", "days_to_pay"), "claim": ("is_assessed", "is_late_arrival")}
    for name, df in (("payment", s["silver_premium_payments"]), ("claim", s["silver_claims"])):
        assert set(flags[name]) <= set(df.columns)
        plan = df._jdf.queryExecution().executedPlan().toString()
        moved = plan[plan.index(f"Exchange hashpartitioning({name}_id") :]
        assert not [c for c in flags[name] if c in moved]


def test_a_build_writes_its_tables_compressed_for_size(spark, tmp_path):
    import pyarrow.parquet as pq

    from quarry.plans.warehouse import write_model

    path = write_model(spark.range(1000).selectExpr("id", "cast(id as string) as s"), f"{tmp_path}/model")
    file = next(tmp_path.glob("model/part-*"))
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
    assert spark.read.parquet(path).count() == 1000
