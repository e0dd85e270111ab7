"""Sweeps, generations, splices, deletion indexes and publishing: kept state and its bounds."""

from __future__ import annotations

import datetime as dt
import hashlib
import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.operators.asof import asof_sweep, carried_over
from quarry.operators.fuzzy import deletion_index, deletion_variants, nearest_values, repair_by_index
from quarry.operators.scd2 import scd2_from_snapshots
from quarry.operators.splice import periods_of, splice_late
from quarry.plans import extras, silver, warehouse
from quarry.plans.layers import Layers
from quarry.streaming.counters import PolicyMart, StreamCounters
from quarry.streaming.generations import GenerationTable
from quarry.streaming.kept_checks import KeyIndex, OpenOrphans
from tests.conftest import SF_SMALL, canon

D0 = dt.date(2020, 1, 1)


def day(k: int) -> dt.date:
    return D0 + dt.timedelta(days=k)


# ------------------------------------------------------------------ X01
@pytest.mark.parametrize("segments", [1, 7])
def test_sweep_equals_the_join_of_every_span(spark, segments):
    r = random.Random(segments)
    spans = []
    for k in ("a", "b", "c", None):
        at = 10
        for v in range(r.randint(1, 12)):
            end = at + r.choice([0, 1, 5, 9])  # some hold nothing
            spans.append((k, day(at), None if v > 8 else day(end), v, f"{k}{v}"))
            if v > 8:
                break
            at = end + r.choice([0, 0, 3])
    facts = [(i, r.choice(["a", "a", "b", "c", "d", None]), r.choice([None, *map(day, range(80))])) for i in range(400)]
    dim = spark.createDataFrame(spans, "k string, valid_from date, valid_to date, v int, name string")
    f = spark.createDataFrame(facts + facts[:50], "id long, k string, at date").withColumn("time", F.lit("clash"))
    want = extras.asof_join(f, dim, "k", "at", ["v", "name"], "was_")
    got = asof_sweep(f, dim, "k", "at", ["v", "name"], "was_", segments=segments)
    assert got.columns == want.columns
    assert canon(got.collect()) == canon(want.collect())
    assert asof_sweep(f.limit(0), dim, "k", "at", ["v"]).count() == 0
    assert asof_sweep(f, dim.limit(0), "k", "at", ["v"]).filter("v is null").count() == 450


def test_sweep_over_a_key_of_many_spans(spark):
    """100,000 spans and facts of one key: facts x spans would be 10^10 comparisons."""
    n = 100_000
    ts = (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 10)).alias("valid_from")
    dim = spark.range(n).select(F.lit("hot").alias("k"), ts, F.col("id").alias("v"))
    dim = dim.withColumn("valid_to", F.col("valid_from") + F.make_dt_interval(secs=F.lit(10)))
    facts = dim.select("k", (F.col("valid_from") + F.make_dt_interval(secs=F.lit(7))).alias("at"), F.col("v").alias("want"))
    begun = time.time()
    got = asof_sweep(facts, dim, "k", "at", ["v"], segments=8)
    assert got.filter(F.col("v") == F.col("want")).count() == n
    assert time.time() - begun < 60


def test_a_segment_takes_over_at_most_one_row(spark):
    rows = [("a", s, 0 if k == 0 else 1, k, (f"s{s}",) if k == 0 else None) for s in range(5) for k in range(4)]
    seq = spark.createDataFrame(rows, "key string, segment int, kind int, time int, span struct<v:string>")
    got = {r.segment: r.before.v for r in carried_over(seq).collect()}
    assert got == {s: f"s{s - 1}" for s in range(1, 5)}


# ------------------------------------------------------------------ X02
def batches_of(spark, n: int, rows: int):
    r = random.Random(n)
    for b in range(n):
        made = [(r.randrange(b * rows // 2 + 1, (b + 1) * rows + 1), b, r.randrange(5)) for _ in range(rows)]
        yield made, spark.createDataFrame(made, "id long, seen int, v int")


def test_generations_equal_a_rebuild_and_write_in_proportion(spark, tmp_path):
    table = GenerationTable(spark, str(tmp_path / "t"), "id", ["seen"])
    with pytest.raises(ValueError):
        table.read()
    every, brought = [], 0
    for k, (made, batch) in enumerate(batches_of(spark, 9, 60)):
        assert table.merge(batch, k)
        every += made
        brought += 60
        latest = {}
        for i, seen, v in sorted(every, key=lambda x: (x[0], -x[1], x[2])):
            latest.setdefault(i, (i, seen, v))
        assert canon(table.read().collect()) == canon(latest.values())
        assert sum(table.writes.per_batch) <= 4 * brought
    assert not table.merge(batch, 8) and not table.merge(batch, 3)  # merged before
    before = canon(table.read().collect())
    assert table.stale() and table.vacuum() > 0 and not [p for p in table.stale() if Path(p).exists()]
    assert canon(GenerationTable(spark, str(tmp_path / "t"), "id", ["seen"]).read().collect()) == before


def test_a_batch_that_fails_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = GenerationTable(spark, str(tmp_path / "t"), "id", ["seen"])
    (_, first), (_, second) = list(batches_of(spark, 2, 30))
    table.merge(first, 0)
    before = canon(table.read().collect())
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda state: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(second, 1)
    assert canon(table.read().collect()) == before
    assert table.merge(second, 1)
    again = GenerationTable(spark, str(tmp_path / "u"), "id", ["seen"])
    again.merge(first.unionByName(second))
    assert canon(table.read().collect()) == canon(again.read().collect())


# ------------------------------------------------------------------ uniqueness, relationships
def test_key_index_equals_the_full_check_after_every_batch(spark, tmp_path):
    r = random.Random(8)
    index = KeyIndex(spark, f"ki_{random.randrange(10**9)}", str(tmp_path / "ki"), 4)
    seen = Counter()
    for k in range(4):
        keys = [r.choice([None, *range(60)]) for _ in range(25)] if k != 2 else []
        batch = spark.createDataFrame([(x, k) for x in keys], "id int, b int")
        assert index.add(batch, "id", k)
        seen.update(str(x) for x in keys if x is not None)
        got = {o.key: o.n_records for o in index.offenders().collect()}
        assert got == {x: n for x, n in seen.items() if n > 1}
    assert not index.add(batch, "id", 3)
    asked = spark.createDataFrame([("3",), ("99",), (None,)], "key string")
    want = {x for x in ("3", "99", None) if x not in seen}
    assert {x.key for x in index.missing(asked).collect()} == want
    probe = asked.groupBy("key").count().join(index.entries(9).hint("merge"), "key", "left")
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "Bucketed: true" in plan  # none on the index side
    index.drop()


def test_a_key_batch_that_fails_before_its_commit_can_be_run_again(spark, tmp_path, monkeypatch):
    index = KeyIndex(spark, f"ki_{random.randrange(10**9)}", str(tmp_path / "ki"), 2)
    one, two = (spark.createDataFrame([(x,) for x in xs], "id int") for xs in ([1, 2], [2, 3]))
    index.add(one, "id", 0)
    with monkeypatch.context() as m:
        m.setattr(index.repeated, "merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            index.add(two, "id", 1)
    assert index.offenders().count() == 0
    index.add(two, "id", 1)
    assert [tuple(o) for o in index.offenders().collect()] == [("2", 2)]
    index.drop()


def test_open_orphans_equal_the_full_check_after_every_batch(spark, tmp_path):
    r = random.Random(6)
    kept = OpenOrphans(spark, f"oo_{random.randrange(10**9)}", str(tmp_path / "oo"), 2)
    children, parents = Counter(), set()
    for k in range(4):
        c = [r.choice([None, *range(12)]) for _ in range(15)]
        p = [r.choice([None, *range(12)]) for _ in range(2)]
        some = (spark.createDataFrame([(x,) for x in c], "fk int"), "fk") if k != 3 else None
        more = (spark.createDataFrame([(x,) for x in p], "pk int"), "pk") if k != 1 else None
        assert kept.add(some, more, k)
        children.update(str(x) for x in c if x is not None and some)
        parents |= {str(x) for x in p if more}
        assert {o.key: o._rows for o in kept.offenders().collect()} == {
            x: n for x, n in children.items() if x not in parents
        }
    assert not kept.add(some, more, 2)
    kept.drop()


# ------------------------------------------------------------------ M13, M14
def test_counters_equal_a_recount_after_resends_and_failures(spark, tmp_path, monkeypatch):
    r = random.Random(2)
    flags = {"odd": F.col("v") % 2 == 1}
    kept = StreamCounters(spark, str(tmp_path / "c"), "id", ["seen"], lambda df: df, flags)
    every = []
    for k in range(3):
        made = [(r.randrange(12), r.randrange(20), k if r.random() < 0.8 else 0, r.randrange(9)) for _ in range(20)]
        batch = spark.createDataFrame(made, "id int, seen int, _batch int, v int")
        if k == 1:  # lost after the winners were stored, before the commit
            with monkeypatch.context() as m:
                m.setattr("quarry.streaming.counters.parquet.append_log", _lost_for(kept.path))
                with pytest.raises(RuntimeError):
                    kept.merge(batch, k)
        assert kept.merge(batch, k)
        every += made
        best = {}
        for i, seen, b, v in sorted(every, key=lambda x: (x[0], -x[1], x[2], x[3])):
            best.setdefault(i, (b, v))
        want = {b: [n, 0, 0] for b, n in Counter(x[2] for x in every).items()}
        for b, v in best.values():
            want[b][1] += 1
            want[b][2] += v % 2
        got = {x["_batch"]: [x.bronze_rows, x.silver_rows, x.odd] for x in kept.per_batch().collect()}
        assert got == want
    assert not kept.merge(batch, 2)


def _lost_for(path):
    from quarry.sources import parquet

    real = parquet.append_log

    def append(spark, log, schema, row):
        if log == f"{path}/log":
            raise RuntimeError("lost")
        return real(spark, log, schema, row)

    return append


def test_policy_mart_equals_a_rebuild_after_every_batch(spark, small_layers, tmp_path):
    from quarry.plans import gold

    mart = PolicyMart(spark, str(tmp_path / "m"))
    pay, clm = small_layers.bronze["premium_payments"], small_layers.bronze["claims"]
    policies = small_layers.silver["silver_policies"]
    cut = [F.col("_batch") % 2 == 0, F.col("_batch") % 2 == 1]
    mart.merge(pay.filter(cut[0]), clm.filter(cut[0]))
    half = [silver.silver_premium_payments(pay.filter(cut[0])), silver.silver_claims(clm.filter(cut[0]))]
    assert canon(mart.read(policies).collect()) == canon(gold.gold_policy_performance(policies, *half).collect())
    # A re-send that moves a payment to another policy changes both policies.
    one = policies.agg(F.max("policy_id")).first()[0]
    moved = pay.filter("pmod(xxhash64(payment_id), 50) = 0").withColumns(
        {"policy_id": F.lit(one), "_ingested_at": F.col("_ingested_at") + F.expr("interval 9 years")}
    )
    mart.merge(pay.filter(cut[1]).unionByName(moved), clm.filter(cut[1]))
    whole = [silver.silver_premium_payments(pay.unionByName(moved)), silver.silver_claims(clm)]
    assert canon(mart.read(policies).collect()) == canon(gold.gold_policy_performance(policies, *whole).collect())


# ------------------------------------------------------------------ X03
@pytest.mark.parametrize("seed", range(3))
def test_splice_equals_a_rebuild_on_random_late_months(spark, seed):
    r = random.Random(seed)
    months = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(18)]
    rows = {}
    for c in range(12):
        for m in months:
            if r.random() < 0.85:  # gaps
                rows[f"c{c}", m] = (f"c{c}", m, r.choice(["x", "x", "x", "y", None]), r.choice(["p", "q"]), f"born{c}")
    late = {k for k in rows if r.random() < 0.25}
    late |= {k for k in rows if k[0] == "c3"}  # a key that only comes late
    corrected = {k: (*k, "z", "q", rows[k][4]) for k in r.sample(sorted(set(rows) - late), 8)}
    schema = "k string, m date, a string, b string, born string"
    args = dict(key="k", period="m", tracked=["a", "b"], carried=["born"], sk_col=None)
    early = spark.createDataFrame([rows[k] for k in sorted(set(rows) - late)], schema)
    history = scd2_from_snapshots(early, **args)
    periods = periods_of(early, "k", "m")
    slices = [[rows[k] for k in sorted(late)][0::2], [rows[k] for k in sorted(late)][1::2] + list(corrected.values())]
    for part in slices:
        new = spark.createDataFrame(part, schema)
        history, periods = (x.checkpoint() for x in splice_late(history, periods, new, **args))
        same, _ = splice_late(history, periods, new, **args)  # once more changes nothing
        assert canon(same.collect()) == canon(history.collect())
    want = scd2_from_snapshots(spark.createDataFrame(list((rows | corrected).values()), schema), **args)
    assert canon(history.collect()) == canon(want.select(*history.columns).collect())


# ------------------------------------------------------------------ X04
def test_variants_meet_within_the_distance(spark):
    r = random.Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("ABC") for _ in range(r.randint(0, 25)))
        b = list(a)
        for _ in range(r.randint(0, 2)):
            at = r.randrange(len(b) + 1)
            b[at : at + r.randint(0, 1)] = r.choice(["", "A", "D"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").filter("levenshtein(a, b) <= 2")
    met = F.arrays_overlap(deletion_variants(F.col("a"), 2), deletion_variants(F.col("b"), 2))
    assert df.count() > 350 and df.filter(~met).count() == 0
    assert df.select(F.max(F.size(deletion_variants(F.col("a"), 2)))).first()[0] <= 1 + 12 + 66


def test_a_domain_of_100_000_values(spark):
    r = random.Random(9)
    value = F.concat(*[F.substring(F.md5(F.concat(F.lit(str(k)), F.col("id").cast("string"))), 1, 5) for k in range(2)])
    domain = spark.range(100_000).select(F.lit("d").alias("domain"), F.upper(value).alias("value")).checkpoint()
    raw = []
    for row in domain.filter("pmod(xxhash64(value), 2500) = 1").collect():
        t = list(row.value)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = r.choice("0ZQ")
        raw.append(("d", " " + "".join(t).lower() + " "))
    raw += [("d", None), ("d", ""), ("d", "!"), ("other", "ABCDE")]
    asked = spark.createDataFrame(raw, "domain string, raw_value string")
    got = {r.raw_value: (r.distance, r.repaired_value) for r in repair_by_index(asked, deletion_index(domain)).collect()}
    token = F.upper(F.trim("raw_value"))
    near = asked.filter("domain = 'd'").crossJoin(domain.select("value")).withColumn("l", F.levenshtein(token, "value", 2))
    near = near.filter("l >= 0").groupBy("raw_value").agg(F.min(F.struct("l", "value")).alias("m")).collect()
    want = {r.raw_value: (r.m.l, r.m.value if r.m.l * 3 <= len(r.raw_value.strip()) else None) for r in near}
    assert {k: v for k, v in got.items() if v[0] is not None} == want and len(want) > 20
    assert len(got) == len({v for _, v in raw})
    assert nearest_values(asked.withColumnRenamed("raw_value", "token").limit(0), deletion_index(domain)).count() == 0


# ------------------------------------------------------------------ S08, S12, S13
def fingerprint(root: Path) -> dict[str, str]:
    return {
        str(p.relative_to(root)): hashlib.sha256(p.read_bytes()).hexdigest() for p in sorted(root.rglob("*")) if p.is_file()
    }


def test_a_failing_check_leaves_the_published_tables(spark, small_layers, tmp_path):
    wh, prefix = tmp_path / "wh", f"p{random.randrange(10**8)}_"
    good = warehouse.build(spark, small_layers, str(wh), db_prefix=prefix)
    files, rows = fingerprint(wh), canon(spark.table(good.tables["silver_policies"]).collect())
    faulty = dict(small_layers.raw)
    faulty["policies"] = faulty["policies"].withColumn("currency", F.lit("EUR"))
    with pytest.raises(warehouse.CheckFailure, match="K12"):
        warehouse.build(spark, Layers(faulty), str(wh), db_prefix=prefix)
    after = fingerprint(wh)
    assert {k: after.get(k) for k in files} == files
    assert canon(spark.table(good.tables["silver_policies"]).collect()) == rows
    assert warehouse.published(spark, str(wh))["silver", "silver_policies"].count(good.run)

    # A build that passes is published whole, and the earlier one can be again.
    fewer = dict(small_layers.raw)
    fewer["claims"] = fewer["claims"].filter("_batch % 2 = 0")
    second = warehouse.build(spark, Layers(fewer), str(wh), db_prefix=prefix)
    n = spark.table(second.tables["silver_claims"]).count()
    assert 0 < n < small_layers.silver["silver_claims"].count()
    assert all(second.run in p for p in warehouse.published(spark, str(wh)).values())
    warehouse.rollback(spark, str(wh), good.run, prefix)
    assert spark.table(second.tables["silver_claims"]).count() == small_layers.silver["silver_claims"].count()
    with pytest.raises(ValueError):
        warehouse.rollback(spark, str(wh), "unknown")
    for result in (good, second):
        warehouse.drop(spark, result)
    assert SF_SMALL and not (wh / "runs" / good.run).exists()
