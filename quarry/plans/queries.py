"""Registered queries: one DataFrame per operator/model, from the driver tables.

Each callable takes ``(spark, sf_dir)`` and reads the whole driver tables
through the overlay; nothing is sampled or capped. Most return a lazy plan; the
sink and incremental ones (s08, s10, x02, x03, s13_build_checks) first write
into the shared checkpoint folder and return the table read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import fixed
from quarry.functions.normalize import batch_increment, batch_key, month_add, month_floor
from quarry.operators import checks, fuzzy, sequential, splice
from quarry.operators.asof import asof_sweep
from quarry.operators.dedup import keep_latest
from quarry.operators.scd2 import scd2_from_snapshots
from quarry.plans import extras, gold, silver, warehouse
from quarry.plans.layers import Layers, from_driver_tables, from_landing
from quarry.schemas import RAW_PREMIUM_PAYMENTS, RAW_SCHEMAS
from quarry.session import ensure_checkpoint_dir, shared_dir, task_count
from quarry.sources import overlay, parquet
from quarry.sources.bronze import register_views
from quarry.sources.overlay import INCOME_BANDS, RISK_CLASSES
from quarry.streaming import counters, generations, incremental, kept_checks

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return from_driver_tables(spark, sf_dir).bronze[name]

    q.__name__ = f"bronze_{name}"
    return q


def _silver(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return from_driver_tables(spark, sf_dir).silver[name]

    q.__name__ = name
    return q


def _gold(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return from_driver_tables(spark, sf_dir).gold[name]

    q.__name__ = name
    return q


def _checks(kind: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Silver tables are read many times: each is computed once. A kind reads a gold table once.
        layers = from_driver_tables(spark, sf_dir, stored=True)
        return checks.check_results(layers.tables(), kinds=[kind])

    q.__name__ = f"k_{kind}"
    return q


def x01_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = from_driver_tables(spark, sf_dir).silver
    return extras.payments_asof_customer(
        s["silver_premium_payments"], s["silver_policies"], s["silver_dim_customer"]
    )


def x01_asof_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The as-of join by a sweep over facts and span starts."""
    s = from_driver_tables(spark, sf_dir).silver
    return extras.payments_asof_customer(
        s["silver_premium_payments"], s["silver_policies"], s["silver_dim_customer"], asof_sweep
    )


def fuzzy_sources(layers) -> list:
    b = layers.bronze
    return [
        ("policies.product_line", b["policies"], "product_line", fixed.PRODUCT_LINES),
        ("policies.status", b["policies"], "status", fixed.POLICY_STATUSES),
        ("premium_payments.method", b["premium_payments"], "method", fixed.PAYMENT_METHODS),
        ("claims.status", b["claims"], "status", fixed.CLAIM_STATUSES),
        ("customer_snapshots.income_band", b["customer_snapshots"], "income_band", INCOME_BANDS),
        ("customer_snapshots.risk_class", b["customer_snapshots"], "risk_class", RISK_CLASSES),
    ]


def x04_fuzzy_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extras.fuzzy_repair_report(fuzzy_sources(from_driver_tables(spark, sf_dir)))


def x04_deletion_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same repairs, against domain tables through a stored deletion index."""
    sources = fuzzy_sources(from_driver_tables(spark, sf_dir))
    values = [(label, v) for label, _, _, accepted in sources for v in accepted]
    path = f"{shared_dir(spark, 'domains')}/deletion_index"
    fuzzy.deletion_index(spark.createDataFrame(values, "domain string, value string")).write.parquet(path)
    parts = [
        df.groupBy(F.col(col).alias("raw_value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("domain", F.lit(label))
        for label, df, col, _ in sources
    ]
    raw = reduce(DataFrame.unionByName, parts)
    return fuzzy.repair_by_index(raw, spark.read.parquet(path)).select(
        F.col("domain").alias("column_name"), "raw_value", "repaired_value",
        F.col("distance").cast("long").alias("distance"), "rows",
    )


def x05_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = from_driver_tables(spark, sf_dir).bronze
    return extras.freshness(
        [
            (fixed.STREAM_PAYMENTS, b["premium_payments"], "due_date"),
            (fixed.STREAM_CLAIMS, b["claims"], "filed_date"),
        ]
    )


def x06_currency_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = from_driver_tables(spark, sf_dir).silver
    facts = {fixed.STREAM_PAYMENTS: s["silver_premium_payments"], fixed.STREAM_CLAIMS: s["silver_claims"]}
    parts = [
        extras.currency_match(df, s["silver_policies"]).withColumn("stream", F.lit(name))
        for name, df in facts.items()
    ]
    return parts[0].unionByName(parts[1])


LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


def w04_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-latest on untouched driver data: newest ship date per order line."""
    return keep_latest(overlay.driver_table(spark, sf_dir, "lineitem"), LINEITEM_KEY, ["l_shipdate"])


EVENT_ORDER = ["ts", "event_id"]  # total order of one user's events


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a per-user sequence (range-partitioned downstream)."""
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    return sequential.change_versions(ev, "user_id", EVENT_ORDER, ["event_type"], start="ts")


def w01_lag_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user, in time order: previous event type and a change flag."""
    return _user_events(spark, sf_dir).select(
        "event_id", "user_id", "ts", "event_type", "prev_event_type", "is_change"
    )


def w03_running_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: running count of event-type changes."""
    return _user_events(spark, sf_dir).select("event_id", "user_id", "version")


def w05_lead_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: spans of constant event type, closed by the next span's start."""
    return sequential.version_spans(_user_events(spark, sf_dir), "user_id", "ts", ["event_type"])


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlay.driver_table(spark, sf_dir, "orders")


def r14_month_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _orders(spark, sf_dir).select(
        "o_orderkey", month_add("o_orderdate", (k % 25 - 12).cast("int")).alias("month_added")
    )


def r15_month_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("o_orderkey", month_floor("o_orderdate").alias("month_start"))


def r16_batch_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select("o_orderkey", batch_key("o_orderdate").alias("batch"))


def r17_batch_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return _orders(spark, sf_dir).select(
        "o_orderkey",
        batch_increment(batch_key("o_orderdate"), (k % 25 - 12).cast("int")).alias("moved_batch"),
    )


def s08_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver payments written as one catalog table and read back."""
    name = f"q{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, 'tables')}'")
    payments = from_driver_tables(spark, sf_dir).silver["silver_premium_payments"]
    ident = warehouse.save_table(payments, f"{name}.silver_premium_payments")
    out = spark.table(ident).checkpoint()
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return out


def _build(spark: SparkSession, sf_dir: str) -> warehouse.BuildResult:
    return warehouse.build(
        spark, from_driver_tables(spark, sf_dir), shared_dir(spark, "warehouse"),
        db_prefix=f"q{uuid.uuid4().hex[:8]}_",
    )


def s13_build_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build; all 42 check results read back from the written gold table."""
    result = _build(spark, sf_dir)
    out = result.checks.checkpoint()
    warehouse.drop(spark, result)
    return out


def s13_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A build that passes, then one of faulty extracts that fails its checks: the live
    policies and their published scorecard are those of the first."""
    layers, root = from_driver_tables(spark, sf_dir), shared_dir(spark, "warehouse")
    prefix = f"q{uuid.uuid4().hex[:8]}_"
    result = warehouse.build(spark, layers, root, db_prefix=prefix)
    faulty = dict(layers.raw)
    faulty["policies"] = faulty["policies"].withColumn("currency", F.lit("???"))
    try:
        warehouse.build(spark, Layers(faulty), root, db_prefix=prefix)
        raise AssertionError("a build with wrong currencies passed its checks")
    except warehouse.CheckFailure:
        out = spark.table(result.tables["silver_policies"]).checkpoint()
    warehouse.drop(spark, result)
    return out


def m17_report_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build; the stored scorecard as the report reads it, with each row's place."""
    result = _build(spark, sf_dir)
    # At most one row per metric: the order of the report is its row order.
    rows = warehouse.report(spark, result)["data_quality"].collect()
    warehouse.drop(spark, result)
    return spark.createDataFrame(
        [(k, r["metric"], r["value"], r["unit"]) for k, r in enumerate(rows, 1)],
        "place int, metric string, value bigint, unit string",
    )


def _placed_read(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    """A report as it is read from the published tables, each row with its place."""
    result = _build(spark, sf_dir)
    read = warehouse.report(spark, result)[report].coalesce(1)  # two streams, or one customer's versions
    out = read.withColumn("place", (F.monotonically_increasing_id() + 1).cast("int")).checkpoint()
    warehouse.drop(spark, result)
    return out


def m17_reconciliation_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed_read(spark, sf_dir, "reconciliation")


def m17_history_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed_read(spark, sf_dir, "sample_history")


#: Batches of a stream, for queries that keep state: rows by a hash of their key, then a part once more.
KEPT_BATCHES = 3


def _in_batches(df: DataFrame, key: str) -> list[DataFrame]:
    dealt = F.pmod(F.xxhash64(key, *[c for c in ("_batch",) if c in df.columns]), F.lit(KEPT_BATCHES))
    return [df.filter(dealt == k) for k in range(KEPT_BATCHES)]


def k_unique_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K01, K07, K14 and K20 from key indexes that take in batches."""
    layers, root = from_driver_tables(spark, sf_dir), shared_dir(spark, "kept")
    out = []
    for check in checks.CATALOG:
        if check.check_id not in ("K01", "K07", "K14", "K20"):
            continue
        name = f"key_index_{uuid.uuid4().hex}"
        index = kept_checks.KeyIndex(spark, name, f"{root}/{check.check_id}", 8)
        column = check.columns[0]
        # The keys, and the batch that rows are dealt by, computed once for all batches.
        table = layers.tables()[check.table]
        keys = table.select(column, *[c for c in ("_batch",) if c in table.columns]).checkpoint()
        for k, batch in enumerate(_in_batches(keys, column)):
            index.add(batch, column, k)
        found = index.offenders().agg(F.count(F.lit(1)).alias("violations"))
        out.append(found.select(F.lit(check.check_id).alias("check_id"), F.lit(check.target).alias("target"), "violations"))
        index.drop()
    return reduce(DataFrame.unionByName, out)


def k_relationships_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines against a part of the orders that comes late: open orphans after all
    children and two of three batches of parents, with their rows."""
    root = shared_dir(spark, "kept")
    lines = overlay.driver_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    orders = overlay.driver_table(spark, sf_dir, "orders").select("o_orderkey")
    kept = kept_checks.OpenOrphans(spark, f"parent_keys_{uuid.uuid4().hex}", root, 8)
    early, late = orders.filter("o_orderkey % 3 = 0"), orders.filter("o_orderkey % 3 = 1")
    for k in range(2):  # children before, with and after their parents
        part = lines.filter(F.col("l_linenumber") % 2 == k)
        kept.add((part, "l_orderkey"), (early, "o_orderkey") if k == 0 else None)
    kept.add(None, (late, "o_orderkey"))
    out = kept.offenders().select(F.col("key").cast("bigint").alias("l_orderkey"), F.col("_rows").alias("orphan_rows"))
    kept.drop()
    return out


def m14_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reconciliation from counters that batches are merged into."""
    bronze, root = from_driver_tables(spark, sf_dir).bronze, shared_dir(spark, "counters")
    late = {"late_arrival_rows": F.col("is_late_arrival")}
    streams = {
        fixed.STREAM_PAYMENTS: ("premium_payments", "payment_id", silver.normalized_payments),
        fixed.STREAM_CLAIMS: ("claims", "claim_id", silver.normalized_claims),
    }
    kept = {}
    for stream, (table, key, normalize) in streams.items():
        kept[stream] = counters.StreamCounters(spark, f"{root}/{stream}", key, silver.FACT_LATEST_BY, normalize, late)
        for k, batch in enumerate(_in_batches(bronze[table], key)):
            kept[stream].merge(batch, k)
    return counters.reconciliation(kept)


def m13_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy mart kept up to date by the policies that three batches touch."""
    layers = from_driver_tables(spark, sf_dir)
    mart = counters.PolicyMart(spark, shared_dir(spark, "mart"))
    payments, claims = (layers.bronze[t] for t in ("premium_payments", "claims"))
    both = zip(_in_batches(payments, "payment_id"), _in_batches(claims, "claim_id"), strict=True)
    for k, (p, c) in enumerate(both):
        mart.merge(p, c, k)
    return mart.read(layers.silver["silver_policies"])


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """The five extracts landed as files, as ``from_landing`` reads them."""
    root = shared_dir(spark, "landing")
    for name, df in from_driver_tables(spark, sf_dir).bronze.items():
        df.write.parquet(f"{root}/{name}")
    return root


def s01_landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver claims from landed files with declared schemas."""
    return from_landing(spark, _landed(spark, sf_dir)).silver["silver_claims"]


def s07_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies per line, by SQL over the bronze view."""
    register_views(from_driver_tables(spark, sf_dir).bronze)
    return spark.sql(
        "SELECT upper(trim(product_line)) AS product_line, count(*) AS policies "
        "FROM bronze_policies GROUP BY upper(trim(product_line))"
    )


def s11_single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agents master written as one file and read back."""
    path = parquet.write_single_file(
        from_driver_tables(spark, sf_dir).bronze["agents"], shared_dir(spark, "single")
    )
    return spark.read.parquet(path)


def s12_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims landed whole, then reloaded without their even batches: those are gone."""
    path = shared_dir(spark, "landing", "claims")
    claims = from_driver_tables(spark, sf_dir).bronze["claims"]
    parquet.write_batches(claims, path)
    parquet.write_batches(claims.filter(F.col("_batch") % 2 == 1), path, full_refresh=True)
    return parquet.read_batches(spark, path, RAW_SCHEMAS["claims"])


def w05_segmented_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension by the segmented scan, with carried columns."""
    snaps = silver.normalized_snapshots(from_driver_tables(spark, sf_dir).bronze["customer_snapshots"])
    return scd2_from_snapshots(
        snaps, "customer_id", "snapshot_month", silver.DIM_TRACKED, silver.DIM_CARRIED, segments=8
    )


def s10_batch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze payments landed one folder per batch, read back with the declared schema."""
    path = shared_dir(spark, "landing", "premium_payments")
    parquet.write_batches(from_driver_tables(spark, sf_dir).bronze["premium_payments"], path)
    return parquet.read_batches(spark, path, RAW_PREMIUM_PAYMENTS)


def x02_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver payments built batch by batch from a landing folder by a stream."""
    root = shared_dir(spark, "x02")
    landing = f"{root}/landing/premium_payments"
    parquet.write_batches(from_driver_tables(spark, sf_dir).bronze["premium_payments"], landing)
    table = incremental.IncrementalSilver(
        spark, f"{root}/silver/premium_payments", "payment_id", silver.FACT_LATEST_BY,
        silver.normalized_payments,
        buckets=int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    incremental.stream_silver(spark, landing, RAW_PREMIUM_PAYMENTS, table, f"{root}/_stream")
    return table.read()


def x02_resend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver payments built, then a third of the keys re-sent by a caller that asks for other buckets."""
    bronze = from_driver_tables(spark, sf_dir).bronze["premium_payments"]
    path = f"{shared_dir(spark, 'x02')}/silver/premium_payments"
    for buckets, batch in ((4, bronze), (7, bronze.filter(F.xxhash64("payment_id") % 3 == 0))):
        incremental.IncrementalSilver(
            spark, path, "payment_id", silver.FACT_LATEST_BY, silver.normalized_payments, buckets=buckets
        ).merge(batch)
    return spark.read.parquet(path).drop(incremental.BUCKET)


def x02_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver payments from a stream of landed batches that append generations."""
    root = shared_dir(spark, "x02")
    landing = f"{root}/landing/premium_payments"
    parquet.write_batches(from_driver_tables(spark, sf_dir).bronze["premium_payments"], landing)
    table = generations.GenerationTable(
        spark, f"{root}/silver/premium_payments", "payment_id", silver.FACT_LATEST_BY, silver.normalized_payments
    )
    stream = (
        spark.readStream.schema(RAW_PREMIUM_PAYMENTS)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 12)
        .parquet(landing)
    )
    generations.merge_stream(stream, table, f"{root}/_stream")
    return table.read()


# Merge the last three years of snapshots into a history built from the first four.
X03_HISTORY_END = "1999-01-01"
X03_SLICES = [("1999-01-01", "2000-01-01"), ("2000-01-01", "2001-01-01"), ("2001-01-01", None)]


def _snapshot_merge(spark: SparkSession, sf_dir: str, slices: list, through: str | None) -> DataFrame:
    ensure_checkpoint_dir(spark)
    snaps = silver.normalized_snapshots(from_driver_tables(spark, sf_dir).bronze["customer_snapshots"])
    # Landed by month, so that each slice reads only its own.
    path = shared_dir(spark, "landing", "customer_snapshots")
    by_month = snaps.withColumn("month", batch_key("snapshot_month"))
    by_month.hint("rebalance", "month").write.partitionBy("snapshot_month").parquet(path)
    snaps = spark.read.parquet(path).drop("month")
    args = dict(key="customer_id", tracked=silver.DIM_TRACKED, carried=silver.DIM_CARRIED)
    early = snaps.filter(F.col("snapshot_month") < F.lit(X03_HISTORY_END).cast("date"))
    history = scd2_from_snapshots(early, period="snapshot_month", **args).checkpoint(eager=True)
    return incremental.merge_snapshot_periods(history, snaps, "snapshot_month", slices, through, **args)


def x03_snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot_merge(spark, sf_dir, X03_SLICES, None)


def x03_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slice merged twice, and the history's own months again."""
    again = [("1995-01-01", X03_HISTORY_END)] + [s for s in X03_SLICES for _ in range(2)]
    return _snapshot_merge(spark, sf_dir, again, "1998-12-01")


def x03_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension of all snapshots but a tenth, which then come late in two slices and
    are spliced into the history without reading the others again."""
    ensure_checkpoint_dir(spark)
    snaps = silver.normalized_snapshots(from_driver_tables(spark, sf_dir).bronze["customer_snapshots"])
    args = dict(key="customer_id", period="snapshot_month")
    dealt = snaps.withColumn("_slice", F.pmod(F.xxhash64("customer_id", "snapshot_month"), F.lit(20)))
    path = shared_dir(spark, "landing", "customer_snapshots")
    dealt.write.parquet(path)
    dealt = spark.read.parquet(path)
    parts = task_count(spark, dealt.count())
    early = dealt.filter("_slice > 1").drop("_slice").repartition(parts, "customer_id")
    history = scd2_from_snapshots(early, tracked=silver.DIM_TRACKED, carried=silver.DIM_CARRIED, **args).checkpoint()
    periods = splice.periods_of(early, **args).checkpoint()
    for k in (0, 1):
        late = dealt.filter(F.col("_slice") == k).drop("_slice")
        history, periods = (
            df.checkpoint()
            for df in splice.splice_late(
                history, periods, late, tracked=silver.DIM_TRACKED, carried=silver.DIM_CARRIED, **args
            )
        )
    return history


def m16_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.sample_history(from_driver_tables(spark, sf_dir).silver["silver_dim_customer"])


CORE: dict[str, Query] = {
    "s02_bronze_agents": _bronze("agents"),
    "s03_bronze_snapshots": _bronze("customer_snapshots"),
    "s04_bronze_policies": _bronze("policies"),
    "s05_bronze_payments": _bronze("premium_payments"),
    "s06_bronze_claims": _bronze("claims"),
    "m06_agents": _silver("silver_agents"),
    "m07_dim_customer": _silver("silver_dim_customer"),
    "m08_policies": _silver("silver_policies"),
    "m09_payments": _silver("silver_premium_payments"),
    "m10_claims": _silver("silver_claims"),
    "m11_fct_payments": _gold("gold_fct_premium_payments"),
    "m12_fct_claims": _gold("gold_fct_claims"),
    "m13_policy_performance": _gold("gold_policy_performance"),
    "m14_reconciliation": _gold("gold_rpt_reconciliation"),
    "m15_scorecard": _gold("gold_rpt_data_quality"),
    "m16_history": m16_history,
    **{f"k_{kind}": _checks(kind) for kind in checks.KINDS},
    "w01_lag_flags": w01_lag_flags,
    "w03_running_version": w03_running_version,
    "w04_keep_latest": w04_keep_latest,
    "w05_lead_spans": w05_lead_spans,
    "r14_month_add": r14_month_add,
    "r15_month_floor": r15_month_floor,
    "r16_batch_key": r16_batch_key,
    "r17_batch_increment": r17_batch_increment,
    "x01_asof_join": x01_asof_join,
    "x04_fuzzy_repair": x04_fuzzy_repair,
    "x05_freshness": x05_freshness,
    "x06_currency_match": x06_currency_match,
    "s08_table_roundtrip": s08_table_roundtrip,
    "s10_batch_sink": s10_batch_sink,
    "x02_incremental": x02_incremental,
    "x03_snapshot_merge": x03_snapshot_merge,
    "s13_build_checks": s13_build_checks,
    "s01_landing_scan": s01_landing_scan,
    "s07_views": s07_views,
    "s11_single_file": s11_single_file,
    "s12_full_refresh": s12_full_refresh,
    "m17_report_reads": m17_report_reads,
    "w05_segmented_dim": w05_segmented_dim,
    "x02_resend": x02_resend,
    "x03_rerun": x03_rerun,
    "x01_asof_sweep": x01_asof_sweep,
    "x02_generations": x02_generations,
    "x03_splice": x03_splice,
    "x04_deletion_index": x04_deletion_index,
    "s13_publish": s13_publish,
    "m17_reconciliation_read": m17_reconciliation_read,
    "m17_history_read": m17_history_read,
    "k_unique_kept": k_unique_kept,
    "k_relationships_kept": k_relationships_kept,
    "m14_counters": m14_counters,
    "m13_by_policy": m13_by_policy,
}


def all_queries() -> dict[str, Query]:
    return dict(CORE)
