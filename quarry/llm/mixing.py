"""Mixing overlapping sources to target weights by min-cost flow (operator 10).

Documents are aggregated by membership pattern (the set of sources that they
belong to) with partial sums; only the patterns' totals reach the driver. Words
flow from each pattern, level by level of repetition with convex costs, over its
sources to their quotas: a source is filled from words that no other source needs
before any text is repeated. The flow through a pattern says how many words of it
the mix takes: so many whole passes, and a seeded part of one more.

That part is found without sorting a source in one task: documents are dealt into
SLICES slices by a seeded hash, summed per (pattern, slice); slices before the cut
are taken whole, later ones are not, and only the slice at the cut, one in SLICES
of the pattern's rows, is put in order. The words that are then still open go to
the document whose size is closest to them.

Defined cases: a null source is a source of its own, ranked last; a document
without sources (null or empty list) belongs to that source; a document of no
words is passed on with none; rows that repeat a document are documents of their own;
an empty table gives no rows; more than MAX_PATTERNS patterns are refused.
"""

from __future__ import annotations

import json
import math
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import WORD_PATTERN, checkpointed, table

#: Weights of the sources in order, repeating, and the mix as a share of all words.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_PASSES = 2
SEED = 20
SLICES = 4096
#: What the driver solves for; a mix over more patterns is an error, never cut short.
MAX_PATTERNS = 100_000


class Flow:
    """Min-cost flow by successive shortest paths over real capacities."""

    EPS = 1e-9

    def __init__(self, nodes: int):
        self.arcs: list[list] = []  # head, capacity left, cost; arc i ^ 1 is its reverse
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: float, cost: float) -> int:
        for tail, head, cap, c in ((a, b, capacity, cost), (b, a, 0.0, -cost)):
            self.out[tail].append(len(self.arcs))
            self.arcs.append([head, cap, c])
        return len(self.arcs) - 2

    def sent(self, arc: int) -> float:
        return self.arcs[arc ^ 1][1]

    def run(self, source: int, sink: int) -> None:
        while True:
            cost, by = {source: 0.0}, {}
            queue, waits = deque([source]), {source}
            while queue:
                a = queue.popleft()
                waits.discard(a)
                for i in self.out[a]:
                    b, cap, c = self.arcs[i]
                    if cap > self.EPS and cost[a] + c < cost.get(b, math.inf) - self.EPS:
                        cost[b], by[b] = cost[a] + c, i
                        if b not in waits:
                            waits.add(b)
                            queue.append(b)
            if sink not in by:
                return
            path, at = [], sink
            while at != source:
                path.append(by[at])
                at = self.arcs[by[at] ^ 1][0]
            step = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= step
                self.arcs[i ^ 1][1] += step


def fill(sizes: Sequence[float], weights: Sequence[float], words: float, most: float) -> list[float]:
    """Targets that share ``words`` by weight; none above ``most`` times its size,
    what is over is shared again by weight among the others."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        share = {i: words * weights[i] / total for i in open_}
        full = {i for i in open_ if share[i] > most * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = share[i]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            words -= targets[i]
        open_ -= full
    return targets


@dataclass(frozen=True)
class Mix:
    sources: list[tuple[str | None, int, float]]  # name, size, target
    patterns: list[tuple[str, int, float]]  # key, size, words taken


def solve(patterns: dict[str, int], weights: Sequence[float], share: float, most: int) -> Mix:
    """The mix for pattern sizes; keys are JSON lists of source names."""
    members = {k: json.loads(k) for k in sorted(patterns)}
    names = sorted({s for m in members.values() for s in m}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for k, m in members.items():
        for s in m:
            sizes[at[s]] += patterns[k]
    ranked = [weights[i % len(weights)] for i in range(len(names))]
    targets = fill(sizes, ranked, share * sum(patterns.values()), most)
    flow = Flow(len(names) + len(members) + 2)
    start, end = len(names) + len(members), len(names) + len(members) + 1
    levels: dict[str, list[int]] = {}
    for j, (k, m) in enumerate(members.items()):
        node = len(names) + j
        # The cost of a pass over a text grows with each repetition.
        levels[k] = [flow.add(start, node, patterns[k], float(level**2)) for level in range(most)]
        for s in m:
            flow.add(node, at[s], math.inf, 0.0)
    for i, target in enumerate(targets):
        flow.add(i, end, target, 0.0)
    flow.run(start, end)
    taken = {k: sum(flow.sent(a) for a in levels[k]) for k in members}
    return Mix(list(zip(names, sizes, targets, strict=True)), [(k, patterns[k], taken[k]) for k in members])


def pattern_key(sources: Column) -> Column:
    """The canonical key of an array of source names."""
    named = F.when((sources.isNull()) | (F.size(sources) == 0), F.array(F.lit(None).cast("string"))).otherwise(sources)
    # Nulls last; to_json keeps them.
    return F.to_json(F.array_sort(F.array_distinct(named)))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def with_keys(docs: DataFrame, sources: Column, text_col: str, id_col: str, seed: int) -> DataFrame:
    """_mix_key, _mix_size, _mix_hash, _mix_slice and _mix_id of each row of ``docs``.

    The row itself is in the struct ``_mix_row``, so that none of its columns can clash.
    """
    shuffled = F.xxhash64(F.lit(seed), F.col(id_col))
    return docs.select(
        F.struct("*").alias("_mix_row"),
        pattern_key(sources).alias("_mix_key"),
        words(F.col(text_col)).alias("_mix_size"),
        shuffled.alias("_mix_hash"),
        F.pmod(shuffled, F.lit(SLICES)).cast("int").alias("_mix_slice"),
        F.col(id_col).alias("_mix_id"),
    )


def plan_mix(
    keyed: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MAX_PASSES
) -> tuple[Mix, DataFrame]:
    """The mix, and for each pattern its whole passes and where the last one is cut."""
    spark = keyed.sparkSession
    slices = checkpointed(keyed.groupBy("_mix_key", "_mix_slice").agg(F.sum("_mix_size").alias("_mix_words")))
    totals = slices.groupBy("_mix_key").agg(F.sum("_mix_words").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    mix = solve({r["_mix_key"]: r["n"] for r in totals}, weights, share, most)
    passes = []
    for key, size, taken in mix.patterns:
        whole = min(most, int(taken / size + 1e-9)) if size else 0
        passes.append((key, whole, float(max(0.0, taken - whole * size))))
    plan = spark.createDataFrame(passes, "_mix_key string, _mix_whole int, _mix_rest double")
    upto = Window.partitionBy("_mix_key").orderBy("_mix_slice")  # at most SLICES rows each
    before = F.sum("_mix_words").over(upto) - F.col("_mix_words")
    cuts = (
        slices.withColumn("_mix_before", before)
        .join(F.broadcast(plan), "_mix_key")
        .filter("_mix_before <= _mix_rest")
        .groupBy("_mix_key")
        .agg(F.max(F.struct("_mix_slice", "_mix_before")).alias("cut"))
    )
    located = checkpointed(
        plan.join(cuts, "_mix_key", "left").select(
            "_mix_key",
            "_mix_whole",
            F.lit(most).alias("_mix_most"),
            F.col("cut._mix_slice").alias("_mix_cut"),
            (F.col("_mix_rest") - F.col("cut._mix_before")).alias("_mix_open"),
        )
    )
    columns = ["_mix_key", "_mix_size", "_mix_hash", "_mix_id", "_mix_slice"]
    edge = checkpointed(in_order(keyed.select(*columns).join(F.broadcast(located), "_mix_key")))
    in_edge = F.max(F.when(F.col("_mix_run") <= F.col("_mix_open"), F.col("_mix_run")))
    gaps = edge.groupBy("_mix_key", "_mix_open").agg(F.coalesce(in_edge, F.lit(0)).alias("n"))
    gaps = checkpointed(gaps.select("_mix_key", (F.col("_mix_open") - F.col("n")).alias("_mix_gap")))
    later = keyed.select(*columns).join(F.broadcast(located), "_mix_key").filter("_mix_slice > _mix_cut")
    left_out = later.select(*columns).unionByName(edge.filter("_mix_run > _mix_open").select(*columns))
    off = F.abs(F.col("_mix_size") - F.col("_mix_gap"))
    last = (
        left_out.join(F.broadcast(gaps), "_mix_key")
        .filter(off < F.col("_mix_gap"))
        .groupBy("_mix_key")
        .agg(F.min(F.struct(off, "_mix_hash", "_mix_id")).alias("last"))
        .select("_mix_key", F.col("last._mix_hash").alias("_mix_last_hash"), F.col("last._mix_id").alias("_mix_last_id"))
    )
    return mix, checkpointed(located.join(last, "_mix_key", "left"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows of the slices at the cut with _mix_run, the words of their slice up to them."""
    order = Window.partitionBy("_mix_key").orderBy("_mix_hash", "_mix_id", "_mix_size")
    run = F.sum("_mix_size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.filter("_mix_slice = _mix_cut").withColumn("_mix_run", run)


def with_copies(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """``keyed`` with _mix_copies, the times that the mix takes each row.

    The plan has one row per pattern (at most MAX_PATTERNS) and is broadcast; only
    rows of the slices at the cut are shuffled.
    """
    rows = keyed.join(F.broadcast(plan), "_mix_key")
    last = F.coalesce(
        (F.col("_mix_hash") == F.col("_mix_last_hash")) & F.col("_mix_id").eqNullSafe(F.col("_mix_last_id")), F.lit(False)
    )
    before = (F.col("_mix_slice") < F.col("_mix_cut")) | last
    sure = rows.filter("_mix_slice <> _mix_cut").withColumn("_mix_copies", F.col("_mix_whole") + before.cast("int"))
    within = (F.col("_mix_run") <= F.col("_mix_open")) | last
    edge = in_order(rows).withColumn("_mix_copies", F.col("_mix_whole") + within.cast("int")).drop("_mix_run")
    # Documents without words lie before any cut; they too are taken no more than the most times.
    return sure.unionByName(edge).withColumn("_mix_copies", F.least("_mix_copies", "_mix_most"))


def own_source(col: str = "source") -> Column:
    return F.array(F.col(col).cast("string"))


def mix_documents(docs: DataFrame, sources: Column | None = None, seed: int = SEED) -> DataFrame:
    """The rows that the mix takes, repeated as often as it takes them; columns as given.

    ``sources``: an array of the sources that a row belongs to; by default its ``source``.
    """
    keyed = with_keys(docs, own_source() if sources is None else sources, "text", "doc_id", seed)
    _, plan = plan_mix(keyed)
    taken = with_copies(keyed, plan).filter("_mix_copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))
    return taken.withColumn("_mix_copy", copies).select("_mix_row.*")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    keyed = checkpointed(with_keys(docs, own_source(), "text", "doc_id", SEED).drop("_mix_row"))
    mix, plan = plan_mix(keyed)
    sources = spark.createDataFrame(mix.sources, "source string, source_size bigint, target double").select(
        pattern_key(own_source()).alias("_mix_key"), "source_size", "target"
    )
    return (
        with_copies(keyed, plan)
        .join(F.broadcast(sources), "_mix_key")
        .select(
            F.col("_mix_id").alias("doc_id"),
            F.col("_mix_size").alias("size"),
            "source_size",
            "target",
            (F.col("_mix_size") * F.col("_mix_copies")).cast("bigint").alias("taken"),
        )
    )
