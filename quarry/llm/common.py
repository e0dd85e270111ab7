"""Helpers shared by the training-data operators.

* ``table``: a table of the input folder.
* ``checkpointed``, ``stored``: cut lineage into the shared folder of ``spark.checkpoint.dir``.
* ``attach``: joins rows to their group's row without a hot group in one task.
* ``connected_components``: distributed components of an edge table.
* ``map_groups``, ``map_group_lists``: stream bounded groups through a Python function, one or some at a time.
* ``worker_state``: caches that the tasks of a Python worker share.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, shared_dir

#: A group is hot when it holds more than one row in HOT_SHARE; there are fewer
#: than HOT_SHARE hot groups, whatever the input, so they may be broadcast.
HOT_SHARE = 1000

#: ASCII white space, the only characters that separate words or are ignored.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read again."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their group, joined on ``key``.

    ``groups`` has one row per key and the number of its rows in ``size``; every
    key of ``rows`` is in it; ``total`` is the number of rows. Groups with more
    than ``total / HOT_SHARE`` rows (fewer than HOT_SHARE of them) are broadcast,
    so none of their rows is shuffled; all other keys are small and go through
    a shuffle join. Both inputs should be stored: each is read twice.
    """
    hot = F.col(size) * HOT_SHARE > F.lit(total)
    few = groups.filter(hot)
    on_map_side = rows.join(F.broadcast(few), key)
    others = rows.join(F.broadcast(few.select(key)), key, "left_anti")
    return on_map_side.unionByName(others.join(groups.filter(~hot), key))


def connected_components(edges: DataFrame, rounds: list | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the
    smallest node that links reach. Null ends are ignored; repeated, reversed
    and self links are harmless; no links give no rows.

    Each round gives every node a new random rank (a hash of the node and the round),
    hooks it to the node of lowest rank at most two links away and contracts the links.
    Whatever the order of the ids, nodes that are nobody's lowest go: a star goes in one
    round, a chain shrinks to a third or less, and rounds grow with the logarithm of the
    longest path. Then the rounds' hooks are
    put together from the last to the first, each a table that shrinks like the links,
    and the smallest node of each root is found with partial aggregation.

    Joins are plain shuffle joins of stored tables, whose hot keys AQE can split. Nothing
    but the emptiness of the links left reaches the driver. ``rounds`` receives an entry
    per round.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    start = checkpointed(pairs.filter("a is not null and b is not null").distinct())
    left = start.filter("a <> b")
    hooks: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = [F.struct(F.xxhash64(F.lit(len(hooks)), F.col(c)).alias("r"), F.col(c).alias("x")) for c in "ab"]
        near = both.select("a", ranked[0].alias("me"), ranked[1].alias("other")).groupBy("a").agg(
            F.least(F.min("other"), F.first("me")).alias("low")
        )
        near = checkpointed(near)
        far = both.join(near.toDF("b", "m"), "b").groupBy("a").agg(F.min("m").alias("m"))
        hook = checkpointed(near.join(far, "a").select(F.col("a").alias("x"), F.least("low", "m")["x"].alias("p")))
        left = checkpointed(
            left.join(hook.toDF("a", "pa"), "a")
            .join(hook.toDF("b", "pb"), "b")
            .filter("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct()
        )
        hooks.append(hook)
        if rounds is not None:
            rounds.append(len(hooks))
    nodes = start.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if not hooks:
        return nodes.withColumn("component", F.col("node"))
    # Roots of the nodes of a round: those of the next round, reached by one more hook.
    roots = hooks[-1]
    for hook in reversed(hooks[:-1]):
        up = roots.toDF("p", "root")
        roots = checkpointed(hook.join(up, "p", "left").select("x", F.coalesce("root", "p").alias("p")))
    # Every linked node is in the first round; the others are linked with themselves only.
    smallest = roots.groupBy("p").agg(F.min("x").alias("component"))
    linked = checkpointed(roots.join(smallest, "p").select(F.col("x").alias("node"), "component"))
    alone = nodes.join(linked.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return linked.unionByName(alone)


_STATE: dict[str, object] = {}


def worker_state(key: str, make: Callable[[], object]) -> object:
    """What the tasks of a Python worker share, such as a cache of words.

    A worker keeps the state of one operator only: another one's is let go.
    """
    if key not in _STATE:
        _STATE.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _STATE[key] = make()
    return _STATE[key]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches, a slice at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def map_groups(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    fn: Callable[[tuple, list[dict]], Iterator[tuple]],
    schema: str,
) -> DataFrame:
    """``fn(key, rows)`` for every group of ``df``; the groups must be bounded.

    Rows are dealt out by ``keys`` and sorted, then groups are cut from the
    sorted stream, one in memory at a time.
    """
    return map_group_lists(df, keys, order, lambda groups: fn(*groups[0]), schema, 1)


def map_group_lists(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    fn: Callable[[list[tuple[tuple, list[dict]]]], Iterator[tuple]],
    schema: str,
    size: int,
) -> DataFrame:
    """``map_groups`` with ``fn(groups)`` for up to ``size`` neighbouring groups (key, rows)
    at a time, for work that is done for many groups at once."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results() -> Iterator[tuple]:
            now, groups = None, []
            for row in rows_of(batches):
                key = tuple(row[k] for k in keys)
                if groups and key == now:
                    groups[-1][1].append(row)
                    continue
                if len(groups) == size:
                    yield from fn(groups)
                    groups = []
                now = key
                groups.append((key, [row]))
            if groups:
                yield from fn(groups)

        yield from to_batches(results(), names, types)

    types = arrow_types(df.sparkSession, schema)
    dealt = df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, schema)


def arrow_types(spark: SparkSession, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in spark.createDataFrame([], schema).schema.fields]


def to_batches(rows: Iterator[tuple], names: list[str], types: list, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows each."""
    held: list[tuple] = []
    for row in chain(rows, [None]):
        if row is not None:
            held.append(row)
        if held and (row is None or len(held) >= size):
            cols = [pa.array(col, type=t) for col, t in zip(zip(*held, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=names)
            held = []
