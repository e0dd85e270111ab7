"""Overlay: derive the five raw insurance extracts from the driver tables.

The driver supplies TPC-H-like tables (customer, supplier, nation, region,
orders, lineitem, events). Each raw extract is a pure projection of them, with
deterministic "mess" (case drift, stray spaces, re-sends, late batches, unpaid
rows, negative amounts) keyed on row ids, so Spark and an SQL oracle start from
identical rows. Real landing folders are read by ``sources.parquet`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.fixed import CLAIM_TYPES, PAYMENT_METHODS, PRODUCT_LINES
from quarry.functions.normalize import batch_increment, batch_key, month_floor
from quarry.session import task_count

# Overlay parameters (the overlay picks element ``key % len`` of a domain; the
# contract domains come from ``quarry.fixed``).
INCOME_BANDS = ["UNDER_1K", "1K_TO_3K", "3K_TO_9K", "OVER_9K"]
RISK_CLASSES = ["USUAL", "LOWERED", "RAISED"]
TERMS = [6, 18, 30, 48, 90]
SNAPSHOT_START = "1995-01-01"
SNAPSHOT_MONTHS = 84
HIRE_START = "2015-01-01"
BIRTH_START = "1955-01-01"
NOISE_MODULUS = 23


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as its files are split; the plan is the same at every size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def noisy(v: Column, k: Column) -> Column:
    """Case drift / stray spaces chosen by ``k % 23``; recoverable by upper(trim())."""
    r = k % NOISE_MODULUS
    return (
        F.when(r == 0, F.lower(v))
        .when(r == 1, F.concat(F.lit("  "), v))
        .when(r == 2, F.concat(v, F.lit("  ")))
        .otherwise(v)
    )


def pick(values: list, idx: Column) -> Column:
    """Element ``idx`` (0-based) of a literal list (folded to one constant array)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def padded_id(prefix: str, key: Column, width: int) -> Column:
    """The key padded to ``width`` digits; longer keys are kept whole (``lpad`` would cut them)."""
    digits = key.cast("string")
    padded = F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
    return F.concat(F.lit(prefix), padded)


def policy_id(orderkey: Column) -> Column:
    return padded_id("POL", orderkey, 9)


def customer_id(custkey: Column) -> Column:
    return padded_id("CUST", custkey, 7)


def agent_id(suppkey: Column) -> Column:
    return padded_id("AGT", suppkey, 6)


def currency_of(key: Column) -> Column:
    return F.when(key % 12 == 0, F.lit("USD")).otherwise(F.lit("IDR"))


# ------------------------------------------------------------------ extracts
def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver_table(spark, sf_dir, "supplier")
    n = driver_table(spark, sf_dir, "nation")
    r = driver_table(spark, sf_dir, "region")
    # Spark broadcasts the code tables by the size of their files.
    j = s.join(n, s.s_nationkey == n.n_nationkey, "left").join(
        r, F.col("n_regionkey") == r.r_regionkey, "left"
    )
    return j.select(
        agent_id(F.col("s_suppkey")).alias("agent_id"),
        F.concat(F.col("s_name"), F.lit(" ")).alias("agent_name"),
        noisy(F.col("n_name"), F.col("s_suppkey")).alias("branch"),
        F.col("r_name").alias("region"),
        F.date_add(F.lit(HIRE_START).cast("date"), (F.col("s_suppkey") % 3000).cast("int")).alias(
            "hire_date"
        ),
    )


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders")
    li = driver_table(spark, sf_dir, "lineitem")
    # First supplier per order = the agent. Partial aggregation before the shuffle.
    first_supp = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("_agent_key"))
    j = o.join(first_supp, o.o_orderkey == first_supp.l_orderkey, "left")
    k = F.col("o_orderkey")
    status = (
        F.when(F.col("o_orderstatus") == "O", F.lit("ACTIVE"))
        .when(F.col("o_orderstatus") == "F", F.lit("MATURED"))
        .when(k % 2 == 0, F.lit("LAPSED"))
        .otherwise(F.lit("CANCELLED"))
    )
    # Exact decimal arithmetic: cents of a hundredth, rounded half away from zero.
    premium = F.round(
        F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.01).cast("decimal(3,2)"), 2
    ).cast("double")
    return j.select(
        policy_id(k).alias("policy_id"),
        customer_id(F.col("o_custkey")).alias("customer_id"),
        agent_id(F.col("_agent_key")).alias("agent_id"),
        noisy(pick(PRODUCT_LINES, k % 4), k).alias("product_line"),
        premium.alias("premium_amount"),
        F.col("o_totalprice").alias("sum_assured"),
        currency_of(k).alias("currency"),
        F.to_date("o_orderdate").alias("start_date"),
        pick(TERMS, k % 5).cast("long").alias("term_months"),
        noisy(status, k + 7).alias("status"),
    )


def premium_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = driver_table(spark, sf_dir, "lineitem")
    ship = F.to_date("l_shipdate")
    ingested = F.col("l_shipdate") + F.make_dt_interval(days=(F.col("l_suppkey") % 60).cast("int"))
    unpaid = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    amount = F.when(F.col("l_partkey") % 97 == 0, -F.col("l_extendedprice")).otherwise(
        F.col("l_extendedprice")
    )
    return li.select(
        padded_id("PAY", F.col("l_orderkey") * 10 + F.col("l_linenumber"), 10).alias("payment_id"),
        policy_id(F.col("l_orderkey")).alias("policy_id"),
        month_floor(ship).alias("due_date"),
        F.when(unpaid, F.lit(None).cast("date")).otherwise(F.date_sub(ship, 3)).alias("paid_date"),
        amount.alias("amount"),
        currency_of(F.col("l_orderkey")).alias("currency"),
        noisy(pick(PAYMENT_METHODS, F.col("l_linenumber") % 4), F.col("l_partkey")).alias("method"),
        ingested.alias("_ingested_at"),
        batch_key(F.to_date(ingested)).alias("_batch"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = driver_table(spark, sf_dir, "events")
    k = F.col("event_id")
    filed = F.to_date("ts")
    canonical = (
        F.when(F.col("event_type") == "purchase", F.lit("PAID"))
        .when(F.col("event_type") == "signup", F.lit("APPROVED"))
        .when(F.col("event_type") == "error", F.lit("REJECTED"))
        .otherwise(F.lit("FILED"))
    )
    assessed = F.when(canonical != "FILED", F.date_add(filed, (k % 40 + 5).cast("int")))
    paid = F.when(
        canonical == "PAID",
        F.round(F.col("value").cast("decimal(18,2)") * F.lit(0.8).cast("decimal(2,1)"), 2).cast(
            "double"
        ),
    )
    landed = F.coalesce(assessed, filed)
    batch = batch_key(F.add_months(landed, (k % 3).cast("int")))
    # Re-sends: every 50th claim is emitted twice; every 100th copy lands one
    # batch later (same ingest time), as an idempotent re-send would. One scan:
    # each event explodes into its copies instead of a self-union.
    copies = F.when(k % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    ev = ev.withColumn("_copy", F.explode(copies))
    resent_later = (F.col("_copy") == 1) & (k % 100 == 0)
    return ev.select(
        padded_id("CLM", k, 8).alias("claim_id"),
        policy_id(k).alias("policy_id"),
        pick(CLAIM_TYPES, k % 5).alias("claim_type"),
        filed.alias("filed_date"),
        assessed.alias("assessed_date"),
        F.col("value").alias("claim_amount"),
        paid.alias("paid_amount"),
        currency_of(k).alias("currency"),
        noisy(canonical, k).alias("status"),
        landed.cast("timestamp_ntz").alias("_ingested_at"),
        F.when(resent_later, batch_increment(batch, 1)).otherwise(batch).alias("_batch"),
    )


def customer_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    # One row per customer and month: explode a fixed 84-element month range
    # (a generator, not a join), so the work stays partitioned like `customer`.
    m = F.col("m")
    key = F.col("c_custkey")
    # Hash-partition the (small) customer rows on the business key *before* the
    # 84x fan-out: the SCD2 window downstream is clustered by customer_id, so the
    # 84x larger snapshot frame is never shuffled.
    n = task_count(spark, c.count() * SNAPSHOT_MONTHS)  # counted in the files' footers
    keyed = c.withColumn("customer_id", customer_id(key)).repartition(n, "customer_id")
    snaps = keyed.select("*", F.explode(F.sequence(F.lit(0), F.lit(SNAPSHOT_MONTHS - 1))).alias("m"))
    city_idx = (F.col("c_nationkey") + F.floor((key + m) / (key % 17 + 31))) % 25
    income_idx = F.floor((key + m) / (key % 23 + 29)) % 4
    risk_idx = F.floor((key * 3 + m) / (key % 29 + 61)) % 3
    # Canonical values first, noise second: two projections, so each canonical
    # expression is evaluated once per row rather than once per noise branch.
    canonical = snaps.select(
        "customer_id",
        F.add_months(F.lit(SNAPSHOT_START).cast("date"), m).alias("snapshot_month"),
        F.concat(F.lit(" "), F.col("c_name")).alias("full_name"),
        F.date_add(F.lit(BIRTH_START).cast("date"), (key * 37 % 17000).cast("int")).alias(
            "birth_date"
        ),
        F.when(key % 2 == 0, F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.col("c_mktsegment").alias("occupation"),
        F.concat(F.lit("NATION_"), city_idx.cast("string")).alias("_city"),
        pick(INCOME_BANDS, income_idx).alias("_income"),
        pick(RISK_CLASSES, risk_idx).alias("_risk"),
        (key * 3 + m).alias("_kc"),
        (key + m * 5).alias("_ki"),
        (key * 7 + m).alias("_kr"),
    )
    return canonical.select(
        "customer_id", "snapshot_month", "full_name", "birth_date", "gender", "occupation",
        noisy(F.col("_city"), F.col("_kc")).alias("city"),
        noisy(F.col("_income"), F.col("_ki")).alias("income_band"),
        noisy(F.col("_risk"), F.col("_kr")).alias("risk_class"),
    )


EXTRACTS = {
    "agents": agents,
    "customer_snapshots": customer_snapshots,
    "policies": policies,
    "premium_payments": premium_payments,
    "claims": claims,
}
