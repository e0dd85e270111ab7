from __future__ import annotations

import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm.mixing import (
    MAX_PASSES,
    fill,
    mix_documents,
    op10_mix_sources,
    own_source,
    plan_mix,
    solve,
    with_copies,
    with_keys,
)
from tests.conftest import SF_MID
from tests.llm.messy import empty, messy


def test_fill_shares_by_weight_up_to_the_most():
    assert fill([100, 100, 100], [5, 2, 1], 450, 2) == [200, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert fill([10, 1000], [5, 2], 100, 2) == [20, 80]
    assert fill([0, 10], [1, 1], 15, 2) == [0, 15]
    assert fill([], [], 0, 2) == []


def test_flow_against_brute_force():
    """Patterns over two sources: as little repetition as any split of the shared one."""
    r = random.Random(10)
    for _ in range(60):
        sizes = {'["a"]': r.randint(0, 6), '["b"]': r.randint(0, 6), '["a","b"]': r.randint(0, 6)}
        mix = solve(sizes, (r.randint(1, 5), r.randint(1, 5)), 1.0, 2)
        target = {s: t for s, _, t in mix.sources}
        taken = {k: t for k, _, t in mix.patterns}
        for k, n in sizes.items():
            assert -1e-6 <= taken[k] <= 2 * n + 1e-6

        def cost(k, words, sizes=sizes):
            return max(0.0, words - sizes[k])  # words of a second pass cost 1

        best = None
        for part in itertools.product(range(0, 25), repeat=1):
            a_shared = min(part[0] / 2, 2 * sizes['["a","b"]'], target["a"])
            a_own = min(target["a"] - a_shared, 2 * sizes['["a"]'])
            b_shared = min(2 * sizes['["a","b"]'] - a_shared, target["b"])
            for drop in range(0, 25):
                b_part = max(0.0, b_shared - drop / 2)
                b_own = min(target["b"] - b_part, 2 * sizes['["b"]'])
                met = a_shared + a_own + b_part + b_own
                spent = cost('["a"]', a_own) + cost('["b"]', b_own) + cost('["a","b"]', a_shared + b_part)
                best = max(best or (-1, 0), (round(met, 6), -spent))
        got = round(sum(taken.values()), 6)
        spent = sum(cost(k, t) for k, t in taken.items())
        assert got >= best[0] - 1e-6
        if abs(got - best[0]) < 1e-6:
            assert spent <= -best[1] + 1.0


def reference_targets(rows):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = [(5, 2, 1)[k % 3] for k in range(len(names))]
    left, open_, targets = 1.5 * sum(sizes.values()), set(range(len(names))), {}
    while open_:
        over = {k for k in open_ if left * weights[k] / sum(weights[i] for i in open_) > 2 * sizes[names[k]]}
        if not over:
            targets |= {names[k]: left * weights[k] / sum(weights[i] for i in open_) for k in open_}
            break
        targets |= {names[k]: 2 * sizes[names[k]] for k in over}
        left -= sum(2 * sizes[names[k]] for k in over)
        open_ -= over
    return sizes, targets


def check(rows, sources):
    rows = [{**r.asDict(), "source": sources[r["doc_id"]]} for r in rows]
    sizes, targets = reference_targets(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, t in targets.items():
        assert abs(taken[s] - t) <= largest[s] / 2 + 1e-6


def test_query(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = op10_mix_sources(spark, SF_MID).collect()
    assert {r["doc_id"]: r["size"] for r in got} == {
        k: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for k, r in docs.items()
    }
    check(got, {k: r["source"] for k, r in docs.items()})
    assert sorted(map(tuple, got)) == sorted(map(tuple, op10_mix_sources(spark, SF_MID).collect()))


def test_defined_cases(spark):
    docs = messy(spark)
    keyed = with_keys(docs, own_source(), "text", "doc_id", 20)
    mix, plan = plan_mix(keyed)
    assert [s for s, _, _ in mix.sources] == ["", "books", "web", "é", "\U0001f600", None]
    rows = with_copies(keyed, plan)
    assert rows.count() == docs.count()
    assert rows.agg(F.max("_mix_copies")).first()[0] <= MAX_PASSES
    taken = mix_documents(docs)
    assert taken.columns == docs.columns
    assert taken.count() == rows.agg(F.sum("_mix_copies")).first()[0]
    assert mix_documents(empty(spark)).count() == 0
    alone = spark.createDataFrame([(1, "", "s"), (2, None, "s")], "doc_id bigint, text string, source string")
    assert mix_documents(alone).count() == 0 or all(not (r["text"] or "") for r in mix_documents(alone).collect())


def test_overlapping_sources(spark):
    """Documents of two sources serve the one that has too little."""
    rows = [(k, "w " * 10, ["a"]) for k in range(40)] + [(100 + k, "w " * 10, ["b", "a", "b"]) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, both array<string>")
    keyed = with_keys(docs, F.col("both"), "text", "doc_id", 1)
    mix, plan = plan_mix(keyed, weights=(1.0, 1.0), share=1.0)
    assert {k: t for k, _, t in mix.patterns} == {'["a"]': pytest.approx(400), '["a","b"]': pytest.approx(400)}
    copies = with_copies(keyed, plan).groupBy("_mix_key").agg(F.sum("_mix_copies")).collect()
    assert {r[0]: r[1] for r in copies} == {'["a"]': 40, '["a","b"]': 40}
