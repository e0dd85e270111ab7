"""Property tests: SCD2 and keep-latest against small pure-Python models."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import canon
from quarry.operators import checks
from quarry.operators.dedup import keep_latest
from quarry.operators.scd2 import scd2_merge
from quarry.plans import silver
from quarry.schemas import RAW_CUSTOMER_SNAPSHOTS

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

BANDS = ["LOW", "MID", "HIGH"]
NOISE = [lambda v: v, str.lower, lambda v: "  " + v, lambda v: v + "  ", str.title]


@st.composite
def histories(draw):
    """Per customer: a sorted set of months and a band (with noise) per month."""
    out = []
    for c in range(draw(st.integers(1, 4))):
        months = sorted(draw(st.sets(st.integers(0, 23), min_size=1, max_size=10)))
        for m in months:
            band = draw(st.sampled_from(BANDS))
            noise = draw(st.sampled_from(range(len(NOISE))))
            out.append((f"C{c}", m, band, noise))
    return out


def to_df(spark, hist, noisy=True):
    data = []
    for cust, m, band, noise in hist:
        month = dt.date(2020 + m // 12, m % 12 + 1, 1)
        value = NOISE[noise](band) if noisy else band
        data.append((cust, month, "Ann", dt.date(1980, 1, 1), "F", "CLERK", "X", value, "STANDARD"))
    return spark.createDataFrame(data, RAW_CUSTOMER_SNAPSHOTS)


def expected_versions(hist):
    """Pure-Python model: a new version whenever the band changes month to month."""
    per = {}
    for cust, m, band, _ in sorted(hist):
        per.setdefault(cust, []).append((m, band))
    out = {}
    for cust, seq in per.items():
        spans, prev = [], None
        for m, band in seq:
            if band != prev:
                spans.append((m, band))
            prev = band
        out[cust] = spans
    return out


@SETTINGS
@given(hist=histories())
def test_scd2_matches_model_and_tiles(spark, hist):
    dim = silver.silver_dim_customer(to_df(spark, hist))
    got = {}
    for r in dim.collect():
        got.setdefault(r.customer_id, []).append((r.scd_version, r.valid_from, r.income_band))
    exp = expected_versions(hist)
    assert set(got) == set(exp)
    for cust, spans in exp.items():
        g = sorted(got[cust])
        assert [v for v, _, _ in g] == list(range(1, len(spans) + 1))
        assert [b for _, _, b in g] == [b for _, b in spans]
        assert [(d.year - 2020) * 12 + d.month - 1 for _, d, _ in g] == [m for m, _ in spans]
    assert checks.contiguity_offenders(dim).count() == 0
    assert checks.one_current_offenders(dim).count() == 0


@SETTINGS
@given(hist=histories())
def test_case_noise_leaves_scd2_unchanged(spark, hist):
    a = silver.silver_dim_customer(to_df(spark, hist, noisy=True))
    b = silver.silver_dim_customer(to_df(spark, hist, noisy=False))
    assert canon(a.collect()) == canon(b.collect())


@SETTINGS
@given(hist=histories(), cut=st.integers(1, 23))
def test_snapshot_merge_equals_rebuild(spark, hist, cut):
    snaps = silver.normalized_snapshots(to_df(spark, hist))
    boundary = dt.date(2020 + cut // 12, cut % 12 + 1, 1)
    early = snaps.filter(snaps.snapshot_month < boundary)
    late = snaps.filter(snaps.snapshot_month >= boundary)
    args = dict(key="customer_id", period="snapshot_month", tracked=silver.DIM_TRACKED,
                carried=silver.DIM_CARRIED)
    from quarry.operators.scd2 import scd2_from_snapshots

    full = scd2_from_snapshots(snaps, **args)
    merged = scd2_merge(scd2_from_snapshots(early, **args), late, **args)
    assert canon(full.collect()) == canon(merged.collect())


@SETTINGS
@given(
    recs=st.lists(
        st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)),
        min_size=1,
        max_size=30,
    )
)
def test_keep_latest_one_row_per_key_and_is_the_max(spark, recs):
    df = spark.createDataFrame(recs, "k int, ing int, batch int, v int")
    got = {r.k: (r.ing, r.batch, r.v) for r in keep_latest(df, ["k"], ["ing", "batch"]).collect()}
    assert len(got) == len({k for k, *_ in recs})
    for k in got:
        cands = [(i, b, -v) for kk, i, b, v in recs if kk == k]
        i, b, nv = max(cands)  # latest ingest, then batch, then smallest v (ascending tie-break)
        assert got[k] == (i, b, -nv)


@SETTINGS
@given(values=st.lists(st.sampled_from(["mid", " MID", "Mid  ", "  high", "LOW"]), min_size=1))
def test_token_is_idempotent(spark, values):
    from quarry.functions.normalize import token

    df = spark.createDataFrame([(v,) for v in values], "v string")
    once = df.select(token("v").alias("v"))
    twice = once.select(token("v").alias("v"))
    assert once.collect() == twice.collect()
    assert all(r.v == r.v.strip().upper() for r in once.collect())


@SETTINGS
@given(
    recs=st.lists(
        st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2]), st.integers(0, 50), st.sampled_from(["a", "b", None])),
        min_size=1,
        max_size=60,
    ),
    segments=st.integers(1, 6),
)
def test_segmented_scan_equals_plain_window(spark, recs, segments):
    """A hot key (0) cut into range segments gives the same flags, versions and spans."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quarry.operators.scd2 import change_flag
    from quarry.operators.sequential import change_versions, version_spans

    rows_ = [(k, t, i, v) for i, (k, t, v) in enumerate(recs)]
    df = spark.createDataFrame(rows_, "k int, t int, id int, v string")
    got = change_versions(df, "k", ["t", "id"], ["v"], segments=segments, start="t")
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = (
        df.withColumn("prev_v", F.lag("v").over(w))
        .withColumn("is_change", change_flag(["v"], w))
        .withColumn("version", F.sum("is_change").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    )
    cols = ["k", "t", "id", "v", "prev_v", "is_change", "version"]
    assert canon(got.select(*cols).collect()) == canon(exp.select(*cols).collect())
    spans = version_spans(got, "k", "t", ["v"])
    ws = Window.partitionBy("k").orderBy("version")
    exp_spans = (
        exp.groupBy("k", "version")
        .agg(F.min("t").alias("valid_from"), F.min("v").alias("v"))
        .withColumn("valid_to", F.lead("valid_from").over(ws))
    )
    cols = ["k", "version", "v", "valid_from", "valid_to"]
    assert canon(spans.select(*cols).collect()) == canon(exp_spans.select(*cols).collect())


@SETTINGS
@given(hist=histories(), segments=st.integers(1, 5))
def test_scd2_segmented_mode_equals_window_mode(spark, hist, segments):
    from quarry.operators.scd2 import scd2_from_snapshots

    snaps = silver.normalized_snapshots(to_df(spark, hist))
    args = dict(key="customer_id", period="snapshot_month", tracked=silver.DIM_TRACKED,
                carried=silver.DIM_CARRIED)
    a = scd2_from_snapshots(snaps, **args)
    b = scd2_from_snapshots(snaps, segments=segments, **args)
    assert a.columns == b.columns
    assert canon(a.collect()) == canon(b.collect())


@SETTINGS
@given(
    recs=st.lists(
        st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(0, 3), st.integers(0, 5), st.booleans()),
        min_size=1,
        max_size=30,
    )
)
def test_keep_latest_batchwise_merge_equals_global(spark, recs):
    """X02's premise: keep_latest(keep_latest(A) + B) == keep_latest(A + B)."""
    df = spark.createDataFrame(recs, "k int, ing int, batch int, v int, second boolean")
    a, b = df.filter("not second").drop("second"), df.filter("second").drop("second")
    once = keep_latest(a.unionByName(b), ["k"], ["ing", "batch"])
    merged = keep_latest(keep_latest(a, ["k"], ["ing", "batch"]).unionByName(b), ["k"], ["ing", "batch"])
    assert canon(once.collect()) == canon(merged.collect())
