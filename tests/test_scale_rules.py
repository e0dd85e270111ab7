"""Long keys, segments that stay put, safe re-runs, empty streams and honest settings."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.functions.normalize import clean, token
from quarry.operators.scd2 import scd2_from_snapshots
from quarry.operators.sequential import change_versions
from quarry.plans import gold, silver
from quarry.plans.layers import from_driver_tables
from quarry.sources import overlay, parquet
from quarry.streaming.incremental import merge_snapshot_periods
from tests.conftest import SF_SMALL, canon

DIM = dict(key="customer_id", tracked=silver.DIM_TRACKED, carried=silver.DIM_CARRIED)


def test_ids_are_padded_but_never_cut(spark):
    keys = [1, 9_999_999, 10_000_000, 100_000_000, 1_000_000, None]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r[0] for r in rows.select(overlay.padded_id("CUST", F.col("k"), 7)).collect()]
    assert got == ["CUST0000001", "CUST9999999", "CUST10000000", "CUST100000000", "CUST1000000", None]


def test_long_keys_keep_every_row(spark, tmp_path):
    """The driver tables with keys moved beyond every id's width."""
    moves = {
        "customer": ["c_custkey"],
        "supplier": ["s_suppkey"],
        "orders": ["o_orderkey", "o_custkey"],
        "lineitem": ["l_orderkey", "l_suppkey"],
        "events": ["event_id"],
        "nation": [],
        "region": [],
    }
    for name, keys in moves.items():
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        for k in keys:
            df = df.withColumn(k, F.col(k) * 10_000_000_000)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    plain, moved = (from_driver_tables(spark, d) for d in (SF_SMALL, str(tmp_path)))
    for name in ("silver_premium_payments", "silver_claims", "silver_policies", "silver_agents"):
        assert moved.silver[name].count() == plain.silver[name].count()
    customers = [x.silver["silver_dim_customer"].select("customer_id").distinct().count() for x in (plain, moved)]
    assert customers[0] == customers[1]
    facts = [x.gold["gold_fct_premium_payments"].filter("customer_id is not null").count() for x in (plain, moved)]
    assert facts[0] == facts[1]


def test_segmented_scan_equals_the_window_on_many_rows(spark):
    """Over 100,000 rows, with carried columns and without exchange reuse."""
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
        F.col("id").alias("t"),
        (F.xxhash64("id") % 3).cast("string").alias("a"),
        F.xxhash64(F.lit(1), "id").cast("string").alias("extra"),
        F.sha2(F.col("id").cast("string"), 256).alias("wide"),
    )
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for _ in range(2):
            got = change_versions(rows, "k", ["t"], ["a"], segments=7, start="t")
            wanted = rows.withColumn(
                "chg", F.expr("int(coalesce(a, '') <> coalesce(lag(a) over (partition by k order by t), '~'))")
            ).withColumn("ver", F.expr("sum(chg) over (partition by k order by t rows unbounded preceding)"))
            both = got.join(wanted.select(F.col("t").alias("t2"), "chg", "ver"), F.col("t") == F.col("t2"))
            wrong = both.filter("version <> ver or is_change <> chg").count()
            assert both.count() == 120_000 and wrong == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_reports_count_zero_for_empty_streams(spark):
    layers = from_driver_tables(spark, SF_SMALL)
    bronze, s = layers.bronze, layers.silver
    rec = gold.gold_rpt_reconciliation(
        bronze["premium_payments"], s["silver_premium_payments"],
        bronze["claims"].filter("false"), s["silver_claims"].filter("false"),
    )
    assert [tuple(r) for r in rec.collect() if r["stream"] == "claims"] == [("claims", 0, 0, 0, 0)]
    dq = gold.gold_rpt_data_quality(
        s["silver_premium_payments"].filter("false"), s["silver_claims"].filter("false"),
        s["silver_dim_customer"].filter("false"), keep_ord=True,
    )
    rows = dq.collect()
    assert len(rows) == 10 and {r["value"] for r in rows} == {0}
    assert [r["ord"] for r in rows] == list(range(1, 11))


SNAPSHOTS = "customer_id string, snapshot_month date, " + ", ".join(
    f"{c} string" for c in [*silver.DIM_TRACKED, *silver.DIM_CARRIED]
)


def snapshots(spark, cities):
    """{customer: [city per month]} as monthly snapshots."""
    rows = []
    for customer, values in cities.items():
        for m, city in enumerate(values, 1):
            if city:
                named = {"city": city}
                rest = [named.get(c, "x") for c in [*silver.DIM_TRACKED, *silver.DIM_CARRIED]]
                rows.append((customer, dt.date(2020, m, 1), *rest))
    return spark.createDataFrame(rows, SNAPSHOTS)


def test_merging_twice_equals_merging_once_and_late_months_are_rebuilt(spark):
    cities = {"a": "AABBCC", "b": "XXXXXY", "c": "MNMNMN"}
    full = snapshots(spark, cities)
    wanted = canon(scd2_from_snapshots(full, period="snapshot_month", **DIM).collect())
    early = full.filter("snapshot_month < '2020-03-01'")
    history = scd2_from_snapshots(early, period="snapshot_month", **DIM)
    slices = [("2020-03-01", "2020-05-01"), ("2020-03-01", "2020-05-01"), ("2020-01-01", None), ("2020-05-01", None)]
    got = merge_snapshot_periods(history, full, "snapshot_month", slices, "2020-02-01", **DIM)
    assert canon(got.select(*history.columns).collect()) == wanted
    # A month that was missing for one customer when it was merged comes late.
    gap = snapshots(spark, {**cities, "c": ["M", "N", None, "N", "M", "N"]})
    stale = scd2_from_snapshots(gap, period="snapshot_month", **DIM)
    late = merge_snapshot_periods(stale, full, "snapshot_month", [("2020-03-01", "2020-04-01")], "2020-06-01", **DIM)
    assert canon(late.select(*history.columns).collect()) == wanted


def test_unicode_spaces_are_trimmed(spark):
    row = spark.createDataFrame([("  Jakarta  ", "a b", None)], "x string, y string, z string")
    got = row.select(clean("x"), token("x"), clean("y"), token("z")).first()
    assert tuple(got) == ("Jakarta", "JAKARTA", "a b", None)


def test_single_file_refuses_large_tables(spark, tmp_path):
    with pytest.raises(ValueError):
        parquet.write_single_file(spark.range(11), f"{tmp_path}/x", max_rows=10)
    assert spark.read.parquet(parquet.write_single_file(spark.range(10), f"{tmp_path}/x", max_rows=10)).count() == 10


def test_batches_of_a_date_label_and_full_refresh(spark, tmp_path):
    rows = [(1, dt.date(2020, 1, 5), 202001), (2, dt.date(2020, 2, 5), 202001), (3, dt.date(2020, 3, 5), 202001)]
    df = spark.createDataFrame(rows, "id int, d date, _batch bigint")
    path = parquet.write_batches(df, f"{tmp_path}/b", date_col="d")
    assert [r["id"] for r in parquet.read_batches(spark, path, df.schema, [202002]).collect()] == [2]
    parquet.write_batches(df.filter("id = 2"), path, date_col="d")
    assert parquet.read_batches(spark, path, df.schema).count() == 3
    parquet.write_batches(df.filter("id = 2"), path, date_col="d", full_refresh=True)
    assert parquet.read_batches(spark, path, df.schema).count() == 1


def test_an_existing_session_keeps_its_settings(spark):
    from quarry.session import get_session

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "7m")
    try:
        again = get_session()
        assert again.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "7m"
        assert again.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")


def test_plans_have_one_shape_at_every_size(spark):
    """No repartition of scans, and agents broadcast by their size in bytes."""
    for name in ("m06_agents", "m12_fct_claims"):
        from quarry.plans.queries import all_queries

        shapes = []
        for sf in (SF_SMALL, SF_SMALL.replace("0.001", "0.01")):
            plan = all_queries()[name](spark, sf)._jdf.queryExecution().sparkPlan().toString()
            shapes.append([line.split("(")[0].strip(" :+-*0123456789") for line in plan.splitlines()])
            assert "RoundRobin" not in plan
        assert [s.split()[0] for s in shapes[0] if s] == [s.split()[0] for s in shapes[1] if s]
