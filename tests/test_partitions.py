"""What a task holds stays the same as tables grow, and spans are put together before strings are sorted."""

from __future__ import annotations

import datetime as dt

from quarry import session
from quarry.operators.scd2 import scd2_from_snapshots
from quarry.operators.sequential import change_versions
from quarry.streaming.incremental import disagreeing_keys


def test_partitions_grow_with_the_rows(spark):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.task_count(spark, 10) == own
    assert session.task_count(spark, 1_000_001, per_task=1000) == max(own, 1001)


def test_a_segment_holds_no_more_than_a_task_should(spark, monkeypatch):
    monkeypatch.setattr("quarry.operators.sequential.task_count", lambda spark, rows: -(-rows // 20))
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(40 * own).selectExpr("id % 3 AS k", "id AS t", "cast(id % 7 AS string) AS a")
    out = change_versions(rows, "k", ["t"], ["a"], segments=2, start="t")
    assert out.rdd.getNumPartitions() > own
    assert out.filter("version = 1").count() == 3


def test_spans_are_collapsed_by_hash_first(spark):
    rows = [(1, dt.date(2020, m, 1), "x" if m < 5 else "y", "c") for m in range(1, 9)]
    df = spark.createDataFrame(rows, "k int, p date, a string, b string")
    out = scd2_from_snapshots(df, "k", "p", ["a"], ["b"], sk_col=None)
    assert "HashAggregate" in out._jdf.queryExecution().executedPlan().toString()
    assert [r["valid_from"].month for r in out.orderBy("valid_from").collect()] == [1, 5]


def test_disagreeing_keys_by_one_join(spark):
    day = dt.date
    history = spark.createDataFrame(
        [(1, "x", day(2020, 1, 1), day(2020, 5, 1)), (1, "y", day(2020, 5, 1), None), (2, "x", day(2020, 1, 1), None)],
        "k int, a string, valid_from date, valid_to date",
    )
    late = spark.createDataFrame(
        [(1, day(2020, 2, 1), "x"), (1, day(2020, 6, 1), "y"), (2, day(2020, 3, 1), "z"), (3, day(2020, 3, 1), "x")],
        "k int, p date, a string",
    )
    wrong = disagreeing_keys(history, late, "k", "p", ["a"])
    assert {r["k"] for r in wrong.collect()} == {2, 3}
    assert wrong._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
