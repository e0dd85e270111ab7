"""Pipeline build, idempotent re-run, sinks and incremental builds."""

from __future__ import annotations

import uuid

import pytest

from conftest import SF_SMALL, canon
from quarry.plans import silver, warehouse
from quarry.schemas import RAW_PREMIUM_PAYMENTS
from quarry.sources import parquet
from quarry.streaming import incremental


def _snapshot(spark, tables):
    return {n: canon(spark.table(t).collect()) for n, t in tables.items()}


def test_build_is_idempotent(spark, small_layers, tmp_path):
    wh = str(tmp_path / "wh")
    prefix = f"i{uuid.uuid4().hex[:6]}_"
    first = warehouse.build(spark, small_layers, wh, db_prefix=prefix)
    a = _snapshot(spark, first.tables)
    second = warehouse.build(spark, small_layers, wh, db_prefix=prefix)
    assert _snapshot(spark, second.tables) == a
    assert second.checks.filter("violations > 0").count() == 0
    assert second.checks.count() == 42


def test_report_reads(spark, small_layers, tmp_path):
    res = warehouse.build(spark, small_layers, str(tmp_path / "wh"), db_prefix=f"r{uuid.uuid4().hex[:6]}_")
    rep = warehouse.report(spark, res)
    assert [r.stream for r in rep["reconciliation"].collect()] == ["claims", "premium_payments"]
    metrics = [r.metric for r in rep["data_quality"].collect()]
    assert metrics[0] == "payments_total" and metrics[-1] == "customers_with_history"
    hist = rep["sample_history"].collect()
    assert len(hist) >= 3 and [r.scd_version for r in hist] == list(range(1, len(hist) + 1))


def test_gate_stops_gold_on_silver_violation(spark, small_layers, tmp_path):
    from pyspark.sql import functions as F

    from quarry.plans.layers import Layers

    raw = dict(small_layers.raw)
    raw["policies"] = raw["policies"].withColumn("currency", F.lit("EUR"))
    with pytest.raises(warehouse.CheckFailure, match="K12"):
        warehouse.build(spark, Layers(raw), str(tmp_path / "wh"), db_prefix=f"g{uuid.uuid4().hex[:6]}_")


def test_batch_sink_keeps_column_and_prunes(spark, small_layers, tmp_path):
    path = str(tmp_path / "landing")
    bronze = small_layers.bronze["premium_payments"]
    parquet.write_batches(bronze, path)
    back = parquet.read_batches(spark, path, RAW_PREMIUM_PAYMENTS)
    assert canon(back.collect()) == canon(bronze.collect())
    one = bronze.select("_batch").first()[0]
    part = parquet.read_batches(spark, path, RAW_PREMIUM_PAYMENTS, batches=[one])
    assert "PartitionFilters: [isnotnull(batch_key" in part._jdf.queryExecution().executedPlan().toString()
    assert {r._batch for r in part.collect()} == {one}


def test_landing_reader_is_additive(spark, small_layers, tmp_path):
    root = tmp_path / "raw"
    bronze = small_layers.bronze["premium_payments"]
    b1 = bronze.filter("_batch < 199801")
    b2 = bronze.filter("_batch >= 199801")
    b1.write.parquet(str(root / "premium_payments" / "batch1"))
    n1 = parquet.read_raw(spark, str(root), "premium_payments").count()
    b2.write.parquet(str(root / "premium_payments" / "batch2"))
    n2 = parquet.read_raw(spark, str(root), "premium_payments").count()
    assert n1 == b1.count() and n2 == bronze.count()


def test_streaming_incremental_equals_rebuild_and_resumes(spark, small_layers, tmp_path):
    landing = str(tmp_path / "landing")
    bronze = small_layers.bronze["premium_payments"]
    first = bronze.filter("_batch < 199901")
    later = bronze.filter("_batch >= 199901")
    parquet.write_batches(first, landing)
    table = incremental.IncrementalSilver(
        spark, str(tmp_path / "silver"), "payment_id", silver.FACT_LATEST_BY,
        silver.normalized_payments, buckets=8,
    )
    ck = str(tmp_path / "stream_ckpt")
    assert incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, ck, files_per_trigger=20) >= 1
    parquet.write_batches(later, landing)  # new batch folders arrive
    incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, ck, files_per_trigger=20)
    expected = silver.silver_premium_payments(bronze)
    assert canon(table.read().collect()) == canon(expected.select(*table.read().columns).collect())


def test_streaming_restart_without_new_files_is_a_no_op(spark, small_layers, tmp_path):
    landing = str(tmp_path / "landing")
    parquet.write_batches(small_layers.bronze["premium_payments"], landing)
    table = incremental.IncrementalSilver(
        spark, str(tmp_path / "silver"), "payment_id", silver.FACT_LATEST_BY,
        silver.normalized_payments, buckets=4,
    )
    ck = str(tmp_path / "ck")
    incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, ck)
    before = canon(table.read().collect())
    assert incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, ck) == 0
    assert canon(table.read().collect()) == before


def test_sf_dir_constant():
    assert SF_SMALL.endswith("sf0.001")


def test_build_from_a_landing_area_equals_overlay_build(spark, small_layers, tmp_path):
    """S01 + S10 + S11: land the extracts as files, build from the folder."""
    from quarry.plans.layers import from_landing

    root = str(tmp_path / "raw")
    for name, df in small_layers.raw.items():
        if name in ("premium_payments", "claims"):
            parquet.write_batches(df, f"{root}/{name}")  # one folder per batch
        else:
            parquet.write_single_file(df, f"{root}/{name}")
    landed = from_landing(spark, root)
    for name in ("silver_dim_customer", "silver_premium_payments", "silver_claims"):
        assert canon(landed.silver[name].collect()) == canon(small_layers.silver[name].collect())
    assert canon(landed.gold["gold_policy_performance"].collect()) == canon(
        small_layers.gold["gold_policy_performance"].collect()
    )


def test_incremental_with_event_month_partitions_equals_rebuild(spark, small_layers, tmp_path):
    """Claims: a re-send repeats the event, so the filing month is a valid partition."""
    from pyspark.sql import functions as F

    from quarry.functions.normalize import batch_key

    bronze = small_layers.bronze["claims"]
    table = incremental.IncrementalSilver(
        spark, str(tmp_path / "silver"), "claim_id", silver.FACT_LATEST_BY,
        silver.normalized_claims, partition=batch_key(F.col("filed_date")),
    )
    for batch in sorted(r[0] for r in bronze.select("_batch").distinct().collect()):
        table.merge(bronze.filter(F.col("_batch") == batch))
    expected = silver.silver_claims(bronze)
    assert canon(table.read().collect()) == canon(expected.select(*table.read().columns).collect())


def test_reloading_a_batch_replaces_only_that_batch(spark, small_layers, tmp_path):
    """Re-landing a batch (dynamic overwrite) leaves the other batches alone."""
    from pyspark.sql import functions as F

    path = str(tmp_path / "landing")
    bronze = small_layers.bronze["premium_payments"]
    parquet.write_batches(bronze, path)
    one = bronze.select("_batch").first()[0]
    fixed = bronze.filter(F.col("_batch") == one).withColumn("method", F.lit("CASH"))
    parquet.write_batches(fixed, path)
    back = parquet.read_batches(spark, path, RAW_PREMIUM_PAYMENTS)
    expected = bronze.filter(F.col("_batch") != one).unionByName(fixed)
    assert canon(back.collect()) == canon(expected.collect())


def test_stream_survives_a_failed_micro_batch(spark, small_layers, tmp_path):
    """A merge that dies before its write is replayed on restart; nothing is lost or doubled."""
    landing = str(tmp_path / "landing")
    bronze = small_layers.bronze["premium_payments"]
    parquet.write_batches(bronze, landing)

    class FlakyOnce(incremental.IncrementalSilver):
        calls = 0

        def merge(self, batch):
            FlakyOnce.calls += 1
            if FlakyOnce.calls == 2:
                raise RuntimeError("executor lost")
            super().merge(batch)

    table = FlakyOnce(
        spark, str(tmp_path / "silver"), "payment_id", silver.FACT_LATEST_BY,
        silver.normalized_payments, buckets=4,
    )
    ck = str(tmp_path / "ck")
    with pytest.raises(Exception):
        incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, ck, files_per_trigger=10)
    incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, ck, files_per_trigger=10)
    expected = silver.silver_premium_payments(bronze)
    assert canon(table.read().collect()) == canon(expected.select(*table.read().columns).collect())


def test_cli_build_and_report(spark, tmp_path, capsys):
    from quarry.__main__ import main

    wh = str(tmp_path / "wh")
    assert main(["build", "--warehouse", wh, "--driver-tables", SF_SMALL]) == 0
    assert main(["report", "--warehouse", wh]) == 0
    out = capsys.readouterr().out
    assert "premium_payments" in out and "customers_with_history" in out and "K42" in out


def test_hot_batch_is_split_over_writers(spark, small_layers, tmp_path):
    """S10 with one batch holding most rows: AQE's rebalance splits it."""
    import glob

    from pyspark.sql import functions as F

    # Several map tasks, as a scan of many files has; the sf0.001 table is a single split.
    bronze = small_layers.bronze["premium_payments"].repartition(8)
    hot = bronze.withColumn("_batch", F.when(F.col("amount") > 1000, F.lit(202001)).otherwise(F.col("_batch")))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    try:
        path = str(tmp_path / "landing")
        parquet.write_batches(hot, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = glob.glob(f"{path}/batch_key=202001/*.parquet")
    assert len(files) > 1
    back = parquet.read_batches(spark, path, RAW_PREMIUM_PAYMENTS)
    assert back.count() == bronze.count()
