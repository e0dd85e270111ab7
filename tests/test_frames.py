"""Hand-made micro-frames for each edge case of the silver/gold semantics."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators.contracts import ContractError, enforce
from quarry.operators.scd2 import scd2_from_snapshots
from quarry.plans import gold, silver
from quarry.schemas import DIM_CUSTOMER, RAW_CLAIMS, RAW_CUSTOMER_SNAPSHOTS, RAW_POLICIES, RAW_PREMIUM_PAYMENTS

D = dt.date
TS = dt.datetime


def snaps(spark, data):
    """data: list of (customer, month 'YYYY-MM', income_band[, city[, birth]])."""
    out = []
    for rec in data:
        cust, month, income = rec[:3]
        city = rec[3] if len(rec) > 3 else "JAKARTA"
        birth = rec[4] if len(rec) > 4 else D(1980, 1, 1)
        y, m = map(int, month.split("-"))
        out.append((cust, D(y, m, 1), "Ann", birth, "F", "CLERK", city, income, "STANDARD"))
    return spark.createDataFrame(out, RAW_CUSTOMER_SNAPSHOTS)


def dim(spark, data, null_safe=False):
    return silver.silver_dim_customer(snaps(spark, data), null_safe=null_safe)


def test_scd_first_row(spark):
    r = rows(dim(spark, [("C1", "2024-01", "MID")]))
    assert len(r) == 1
    assert r[0]["scd_version"] == 1 and r[0]["valid_to"] is None and r[0]["is_current"]


def test_scd_case_noise_is_one_version(spark):
    r = rows(dim(spark, [("C1", "2024-01", "MID"), ("C1", "2024-02", "  mid "), ("C1", "2024-03", "Mid")]))
    assert len(r) == 1 and r[0]["income_band"] == "MID"


def test_scd_a_b_a_three_versions_that_tile(spark):
    r = rows(
        dim(spark, [("C1", "2024-01", "LOW"), ("C1", "2024-02", "MID"), ("C1", "2024-03", "LOW")]),
        ["scd_version"],
    )
    assert [x["income_band"] for x in r] == ["LOW", "MID", "LOW"]
    assert r[0]["valid_to"] == r[1]["valid_from"] and r[1]["valid_to"] == r[2]["valid_from"]
    assert [x["is_current"] for x in r] == [False, False, True]


def test_scd_null_null_sentinel_vs_null_safe(spark):
    data = [("C1", "2024-01", None), ("C1", "2024-02", None)]
    assert len(rows(dim(spark, data))) == 2
    assert len(rows(dim(spark, data, null_safe=True))) == 1


def test_scd_null_then_empty_flags_empty_then_null_does_not(spark):
    assert len(rows(dim(spark, [("C1", "2024-01", None), ("C1", "2024-02", "")]))) == 2
    assert len(rows(dim(spark, [("C2", "2024-01", ""), ("C2", "2024-02", None)]))) == 1


def test_scd_gap_is_bridged(spark):
    r = rows(dim(spark, [("C1", "2024-01", "MID"), ("C1", "2024-03", "MID")]))
    assert len(r) == 1 and r[0]["valid_from"] == D(2024, 1, 1) and r[0]["is_current"]


def test_scd_birth_date_is_not_tracked(spark):
    r = rows(
        dim(spark, [("C1", "2024-01", "MID", "X", D(1980, 5, 1)), ("C1", "2024-02", "MID", "X", D(1979, 1, 1))])
    )
    assert len(r) == 1 and r[0]["birth_date"] == D(1979, 1, 1)


def test_scd_surrogate_key_recipe(spark):
    r = rows(dim(spark, [("C1", "2024-01", "MID")]))
    import hashlib

    assert r[0]["customer_sk"] == hashlib.md5(b"C1-1").hexdigest()


def payments(spark, data):
    """data: (payment_id, due, paid, amount, ingested, batch)."""
    out = [
        (pid, "P1", due, paid, amt, "idr", " cash", ing, batch)
        for pid, due, paid, amt, ing, batch in data
    ]
    return spark.createDataFrame(out, RAW_PREMIUM_PAYMENTS)


def test_dedup_later_batch_wins_and_flags_from_it(spark):
    ing = TS(2024, 1, 20)
    df = payments(
        spark,
        [("A", D(2024, 1, 1), D(2024, 1, 5), 10.0, ing, 202401), ("A", D(2024, 1, 1), D(2024, 1, 5), 10.0, ing, 202402)],
    )
    r = rows(silver.silver_premium_payments(df))
    assert len(r) == 1 and r[0]["_batch"] == 202402 and r[0]["is_late_arrival"] is True
    assert r[0]["currency"] == "IDR" and r[0]["method"] == "CASH"


def test_dedup_later_ingest_beats_higher_batch(spark):
    df = payments(
        spark,
        [
            ("A", D(2024, 1, 1), None, 10.0, TS(2024, 1, 20), 202402),
            ("A", D(2024, 1, 1), None, 11.0, TS(2024, 1, 25), 202401),
        ],
    )
    r = rows(silver.silver_premium_payments(df))
    assert len(r) == 1 and r[0]["amount"] == 11.0


def test_late_at_year_end_and_not_late_same_month(spark):
    df = payments(
        spark,
        [
            ("A", D(2024, 12, 1), None, 1.0, TS(2025, 1, 3), 202501),
            ("B", D(2024, 12, 1), None, 1.0, TS(2024, 12, 3), 202412),
            ("C", D(2024, 12, 1), None, 1.0, TS(2024, 11, 30), 202411),
        ],
    )
    late = {r["payment_id"]: r["is_late_arrival"] for r in rows(silver.silver_premium_payments(df))}
    assert late == {"A": True, "B": False, "C": False}


def test_invalid_amount_three_valued(spark):
    df = payments(
        spark,
        [(p, D(2024, 1, 1), D(2024, 1, 2), a, TS(2024, 1, 2), 202401) for p, a in
         [("N", None), ("Z", 0.0), ("M", -1.0), ("P", 1.0)]],
    )
    inv = {r["payment_id"]: r["is_invalid_amount"] for r in rows(silver.silver_premium_payments(df))}
    assert inv == {"N": None, "Z": True, "M": True, "P": False}


def test_unpaid_flags(spark):
    df = payments(spark, [("U", D(2024, 1, 1), None, 5.0, TS(2024, 1, 2), 202401)])
    r = rows(silver.silver_premium_payments(df))[0]
    assert r["is_paid"] is False and r["days_to_pay"] is None and r["is_paid_before_due"] is False


def test_paid_before_due_and_days(spark):
    df = payments(spark, [("E", D(2024, 1, 10), D(2024, 1, 7), 5.0, TS(2024, 1, 12), 202401)])
    r = rows(silver.silver_premium_payments(df))[0]
    assert r["days_to_pay"] == -3 and r["is_paid_before_due"] is True


def _policies(spark, ids):
    return silver.silver_policies(
        spark.createDataFrame(
            [(p, "C1", None, "life", 10.0, 100.0, "IDR", D(2024, 1, 1), 12, "active") for p in ids],
            RAW_POLICIES,
        )
    )


def _claims(spark, data):
    """data: (claim_id, policy_id, status, paid_amount)."""
    out = [
        (c, p, "death", D(2024, 1, 3), D(2024, 1, 9) if s != "FILED" else None, 50.0, amt, "IDR", s,
         TS(2024, 1, 9), 202401)
        for c, p, s, amt in data
    ]
    return silver.silver_claims(spark.createDataFrame(out, RAW_CLAIMS))


def test_policy_without_facts_and_with_claims_only(spark):
    pol = _policies(spark, ["P0", "P1"])
    pay = silver.silver_premium_payments(payments(spark, [])).limit(0)
    clm = _claims(spark, [("K1", "P1", "PAID", 40.0)])
    perf = {r["policy_id"]: r for r in rows(gold.gold_policy_performance(pol, pay, clm))}
    p0, p1 = perf["P0"], perf["P1"]
    assert (p0["premiums_due"], p0["premium_collected"], p0["claims_filed"], p0["loss_ratio"]) == (0, 0.0, 0, None)
    assert p1["claims_paid"] == 40.0 and p1["loss_ratio"] is None


def test_loss_ratio_guarded_and_rounded(spark):
    pol = _policies(spark, ["P1"])
    pay = silver.silver_premium_payments(
        payments(spark, [("A", D(2024, 1, 1), D(2024, 1, 2), 30.0, TS(2024, 1, 2), 202401),
                         ("B", D(2024, 2, 1), D(2024, 2, 2), -5.0, TS(2024, 2, 2), 202402),
                         ("C", D(2024, 3, 1), None, 7.0, TS(2024, 3, 2), 202403)])
    ).withColumn("policy_id", F.lit("P1"))
    clm = _claims(spark, [("K1", "P1", "PAID", 10.0), ("K2", "P1", "FILED", None)])
    r = rows(gold.gold_policy_performance(pol, pay, clm))[0]
    assert r["premiums_due"] == 3 and r["premiums_paid"] == 2 and r["premium_collected"] == 30.0
    assert r["claims_filed"] == 2 and r["claims_paid"] == 10.0 and r["loss_ratio"] == 0.3333


def test_claim_derivations(spark):
    r = {x["claim_id"]: x for x in rows(_claims(spark, [("K1", "P1", " paid", 1.0), ("K2", "P1", "FILED", None)]))}
    assert r["K1"]["status"] == "PAID" and r["K1"]["is_paid_claim"] and r["K1"]["is_assessed"]
    assert r["K1"]["settlement_days"] == 6 and r["K2"]["settlement_days"] is None
    assert r["K2"]["is_assessed"] is False


def test_contract_rejects_drop_rename_retype_add(spark):
    good = dim(spark, [("C1", "2024-01", "MID")])
    enforce(good, DIM_CUSTOMER)
    with pytest.raises(ContractError):
        enforce(good.drop("city"), DIM_CUSTOMER)
    with pytest.raises(ContractError):
        enforce(good.withColumnRenamed("city", "town"), DIM_CUSTOMER)
    with pytest.raises(ContractError):
        enforce(good.withColumn("scd_version", F.col("scd_version").cast("long")), DIM_CUSTOMER)
    with pytest.raises(ContractError):
        enforce(good.withColumn("extra", F.lit(1)), DIM_CUSTOMER)


def test_scd2_generic_operator_with_tie_break_order(spark):
    df = spark.createDataFrame(
        [(1, TS(2024, 1, 1), 1, "a"), (1, TS(2024, 1, 1), 2, "b"), (1, TS(2024, 1, 2), 3, "b")],
        "k int, ts timestamp_ntz, id int, v string",
    )
    out = rows(scd2_from_snapshots(df, "k", "ts", ["v"], sk_col=None, order=["ts", "id"]), ["scd_version"])
    assert [(r["v"], r["scd_version"]) for r in out] == [("a", 1), ("b", 2)]


def test_fuzzy_repair_fixes_typos_and_leaves_far_values(spark):
    from quarry.plans.extras import repair_column

    df = spark.createDataFrame([("LIFEE",), (" helth",), ("general",), ("BANANA",), (None,)], "v string")
    rows = repair_column(df, "v", ["LIFE", "MICRO", "HEALTH", "GENERAL"]).collect()
    assert [r.v for r in rows] == ["LIFE", "HEALTH", "GENERAL", "BANANA", None]
    assert [r.v_raw for r in rows] == ["LIFEE", " helth", "general", "BANANA", None]
    methods = spark.createDataFrame([("",), ("X",), ("QR",), ("VAA",)], "v string")
    got = [r.v for r in repair_column(methods, "v", ["TRANSFER", "AUTODEBIT", "CASH", "VA"]).collect()]
    assert got == ["", "X", "QR", "VA"]


def test_asof_join_picks_span_in_force_and_keeps_unmatched(spark):
    from quarry.plans.extras import asof_join

    dim = spark.createDataFrame(
        [("C1", 1, D(2024, 1, 1), D(2024, 3, 1), "A"), ("C1", 2, D(2024, 3, 1), None, "B")],
        "customer_id string, scd_version int, valid_from date, valid_to date, city string",
    )
    facts = spark.createDataFrame(
        [(1, "C1", D(2023, 12, 31)), (2, "C1", D(2024, 2, 29)), (3, "C1", D(2024, 3, 1)), (4, "C2", D(2024, 1, 5))],
        "id int, customer_id string, at date",
    )
    got = {r.id: r.city for r in asof_join(facts, dim, "customer_id", "at", ["city"]).collect()}
    assert got == {1: None, 2: "A", 3: "B", 4: None}


def test_month_and_batch_helpers_cross_year_ends(spark):
    from quarry.functions.normalize import batch_increment, batch_key, days_between, month_add, month_floor, yyyymm

    df = spark.createDataFrame(
        [(202412, 1, D(2024, 12, 31)), (202401, -1, D(2024, 1, 15)), (202406, -18, D(2024, 2, 29))],
        "b long, n int, d date",
    )
    got = df.select(
        batch_increment("b", F.col("n")).alias("moved"),
        batch_key("d").alias("key"),
        yyyymm("d").alias("ym"),
        month_floor("d").alias("floor"),
        month_add("d", F.col("n")).alias("added"),
        days_between(F.lit(D(2024, 1, 1)), "d").alias("days"),
    ).collect()
    assert [r.moved for r in got] == [202501, 202312, 202212]
    assert [r.key for r in got] == [202412, 202401, 202402] == [r.ym for r in got]
    assert [r.floor for r in got] == [D(2024, 12, 1), D(2024, 1, 1), D(2024, 2, 1)]
    assert [r.added for r in got] == [D(2025, 1, 1), D(2023, 12, 1), D(2022, 8, 1)]
    assert [r.days for r in got] == [365, 14, 59]
