"""Plan shape tests: the physical plans the scale design relies on."""

from __future__ import annotations

import re

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fresh(spark):
    """New, never-executed plans (an executed one shows AQE's final plan instead)."""
    from quarry.plans.layers import from_driver_tables

    return from_driver_tables(spark, SF_SMALL)


def test_dedup_has_partial_window_group_limit_before_shuffle(spark):
    p = plan(fresh(spark).silver["silver_premium_payments"])
    # Final limit above the exchange, partial limit below it.
    assert p.count("WindowGroupLimit") == 2
    top = p.index("WindowGroupLimit")
    ex = p.index("Exchange hashpartitioning(payment_id")
    assert top < ex < p.rindex("WindowGroupLimit")


def test_scd2_never_shuffles_the_snapshot_rows(spark):
    p = plan(fresh(spark).silver["silver_dim_customer"])
    exchanges = re.findall(r"Exchange [a-zA-Z]+\(([^)]*)\)", p)
    # The only exchange is the small customer master, hashed on the key before
    # the monthly fan-out; the windows and the collapse reuse it.
    assert len(exchanges) == 1 and exchanges[0].startswith("customer_id")
    assert p.index("Exchange") > p.index("Generate")


def test_policy_mart_aggregates_facts_before_joining(spark):
    p = plan(fresh(spark).gold["gold_policy_performance"])
    assert "partial_count" in p and "partial_sum" in p


def test_scan_prunes_columns(spark):
    from quarry.sources import overlay

    df = overlay.premium_payments(spark, SF_SMALL).select("policy_id", "amount")
    p = plan(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"l_orderkey", "l_partkey", "l_extendedprice"}


def test_hot_policy_is_split_by_aqe_and_results_stay_whole(spark, small_layers):
    """A third of all payments on one policy: AQE splits the skewed join partition."""
    from pyspark.sql import functions as F

    from quarry.plans import gold

    s = small_layers.silver
    pay = s["silver_premium_payments"]
    hot_policy = pay.select("policy_id").first()[0]
    n = pay.count()
    hot = pay.limit(n // 2).withColumn("policy_id", F.lit(hot_policy))
    skewed = pay.unionByName(hot)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fct = gold.gold_fct_premium_payments(
            skewed, s["silver_policies"], s["silver_agents"], s["silver_dim_customer"]
        )
        got = len(fct.collect())  # runs through fct's own adaptive plan
        final = fct._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == n + n // 2  # every row kept, none dropped or capped
    assert "skew=true" in final, final


def test_segmented_scan_never_windows_a_whole_key(spark):
    from quarry.operators.sequential import change_versions

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(change_versions(ev, "user_id", ["ts", "event_id"], ["event_type"]))
    row_windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", p)
    assert row_windows, p
    # Row-level windows are partitioned by (user_id, segment); only the
    # per-segment summary (at most n rows per key) is windowed by user_id alone.
    assert any("_seg" in w for w in row_windows)
    # Rows and summaries read the same stored segments, which no window spans.
    assert "rangepartitioning" not in p and p.count("ExistingRDD") == 2


def test_policies_are_not_shuffled_on_agent_id(spark):
    """Agents are broadcast after a check of their size, whatever Spark's threshold."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("gold_fct_premium_payments", "gold_fct_claims"):
            p = plan(fresh(spark).gold[name])
            assert not re.search(r"Exchange hashpartitioning\(agent_id", p), p
            assert re.search(r"BroadcastHashJoin \[agent_id", p), p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_side_beyond_the_limit_is_shuffled_with_the_same_result(spark):
    from pyspark.sql import functions as F

    from quarry.operators.joins import enrich_measured, measured_bytes

    left = spark.range(200).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"))
    right = spark.createDataFrame([(k, f"branch {k}", None) for k in range(4)], "k bigint, branch string, region string")
    assert measured_bytes(right) == 4 * (64 + 1 + 8)
    assert measured_bytes(right.limit(0)) == 0
    small = enrich_measured(left, right, "k", ["branch", "region"])
    large = enrich_measured(left, right.hint("merge"), "k", ["branch", "region"], limit=0)
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    want = sorted((i, i % 5 if i % 3 else None, f"branch {i % 5}" if i % 3 and i % 5 < 4 else None) for i in range(200))
    for got in (small, large):
        assert sorted(((r["id"], r["k"], r["branch"]) for r in got.collect())) == want
