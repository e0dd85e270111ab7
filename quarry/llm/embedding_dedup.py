"""Near-duplicate embeddings by sorted projection passes (operator 3).

Similarity is the cosine in double precision. Each pass gives every vector BITS
random-hyperplane bits, sorts all vectors lexicographically by them and compares
each with the WINDOW vectors after it. Similar vectors share long prefixes and so
come to stand side by side in some pass; links found in any pass are united.

1. Equal vectors form a class; one member of each stands for it.
2. (pass, bits) of all classes are range-partitioned and sorted in one job, whose
   result is stored; ranks follow from the sizes of its partitions. Ranks are cut
   into blocks of BLOCK rows, and the WINDOW rows after a block are handed to it too,
   so no neighbours are lost at a border and no group is larger than both together.
3. A block emits only links that connect its vectors, at most one per vector.
4. Components of the links. Within each component all pairs are compared once, tile
   by tile, and only counts leave a tile: links that the windows were too small to
   see within a dense group are counted as well, so that ``n_links`` is exact for the
   components found.

The number of passes grows with the number of vectors so that a pair at the
threshold is missed with a probability of at most MISS if bits are balanced.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, as do vectors of different lengths; a row without an
id links with nothing, is kept and has no component; rows that repeat an id are rows
of their own; an empty table gives no rows; other columns (labels too) are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import (
    arrow_types,
    attach,
    checkpointed,
    connected_components,
    map_groups,
    rows_of,
    table,
    to_batches,
)

COSINE = 0.9
BITS = 62
WINDOW = 256
BLOCK = 2048
TILE = 512
MISS = 0.003
SEED = 3


def unit_vector(components: list | None) -> np.ndarray | None:
    """The vector scaled to length 1; None if it has no direction."""
    if not components or any(c is None for c in components):
        return None
    v = np.array(components, float)
    most = np.abs(v).max()
    if not np.isfinite(v).all() or most == 0:
        return None
    v = v / most
    return v / np.sqrt(v @ v)


def unit_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, digest, unit): the unit vector as bytes of doubles, null if there is none."""
    schema = "vec_id bigint, digest binary, unit binary"
    types = arrow_types(rows.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def units() -> Iterator[tuple]:
            for r in rows_of(batches):
                v = unit_vector(r["v"])
                packed = None if v is None else v.tobytes()
                yield r["vec_id"], packed and xxhash.xxh3_128_digest(packed), packed

        yield from to_batches(units(), ["vec_id", "digest", "unit"], types)

    vectors = F.col(vector_col).cast("array<double>").alias("v")
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), vectors).mapInArrow(run, schema)


def passes_for(n: int, cosine: float, window: int) -> int:
    """Passes after which a pair at the threshold is missed with a probability of MISS."""
    agree = 1 - math.acos(cosine) / math.pi
    found = agree ** max(0.0, math.log2(max(n, 1) / window))  # in one pass
    return max(4, math.ceil(math.log(MISS) / math.log(1 - found))) if found < 1 - MISS else 4


def projections(vectors: DataFrame, passes: int) -> DataFrame:
    """(id, pass, key): the bits of each vector in each pass; vectors of different lengths apart."""
    schema = "id bigint, keys array<bigint>"
    types = arrow_types(vectors.sparkSession, schema)
    places = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}

        def keys() -> Iterator[tuple]:
            for r in rows_of(batches):
                v = np.frombuffer(r["unit"])
                if len(v) not in planes:
                    planes[len(v)] = np.random.default_rng([SEED, len(v)]).standard_normal((passes * BITS, len(v)))
                bits = (planes[len(v)] @ v > 0).reshape(passes, BITS)
                yield r["id"], (bits @ places).tolist()

        yield from to_batches(keys(), ["id", "keys"], types)

    return vectors.mapInArrow(run, schema).select("id", F.posexplode("keys").alias("pass", "key"))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their rank in the order of all rows.

    The order is computed once and stored, so every later use sees the same ranks.
    One number per partition passes through the driver.
    """
    place = F.monotonically_increasing_id()  # partition and place within it
    stored = checkpointed(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", place)
        .withColumns({"part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND((1 << 33) - 1)})
    )
    sizes = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, at = [], 0
    for part, n in sizes:
        offsets.append((part, at))
        at += n
    before = rows.sparkSession.createDataFrame(offsets, "part bigint, before bigint")
    return stored.join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("place"))


def neighbour_links(vectors: DataFrame, passes: int, cosine: float, window: int, block: int) -> DataFrame:
    """Links (a, b) that connect the vectors linked within a window of some pass."""
    order = ranked(projections(vectors, passes), ["pass", "key", "id"])
    own = F.floor(F.col("rank") / block)
    ahead = F.when((F.col("rank") % block < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    placed = order.select("id", "rank", F.explode(ahead).alias("block"))
    rows = placed.join(vectors, "id").select("block", "rank", "id", "unit")

    def links(_: tuple, rows: list[dict]) -> Iterator[tuple]:
        ids = [r["id"] for r in rows]
        root = list(range(len(ids)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, members in by_length(rows):
            for at in range(0, len(members), window):
                near = x[at : at + window] @ x[at : at + 2 * window].T >= cosine
                for i, j in zip(*np.nonzero(near), strict=True):
                    if 0 < j - i <= window:
                        a, b = find(members[at + i]), find(members[at + j])
                        if a != b:
                            root[b] = a
                            yield ids[members[at + i]], ids[members[at + j]]

    return map_groups(rows, ["block"], ["rank"], links, "a bigint, b bigint").filter("a <> b").distinct()


def by_length(rows: list[dict]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Matrices of the rows' unit vectors, one for each length of vector, with the rows' places."""
    of: dict[int, list[int]] = {}
    for k, r in enumerate(rows):
        of.setdefault(len(r["unit"]), []).append(k)
    for members in of.values():
        yield np.stack([np.frombuffer(rows[k]["unit"]) for k in members]), members


def link_counts(vectors: DataFrame, groups: DataFrame, cosine: float, tile: int) -> DataFrame:
    """(id, n): rows of other classes that each class links with, over all pairs of its component."""
    sizes = checkpointed(
        groups.groupBy("component")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    placed = attach(groups, sizes, "component", "n", total).select(
        F.col("node").alias("id"),
        "component",
        F.pmod(F.xxhash64(F.lit(SEED), "node"), F.col("tiles")).cast("int").alias("tile"),
        F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"),
    )
    rows = placed.join(vectors, "id").select(
        "component",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        "tile",
        "id",
        "size",
        "unit",
    )

    def counts(key: tuple, rows: list[dict]) -> Iterator[tuple]:
        for x, members in by_length(rows):
            size = np.array([rows[k]["size"] for k in members])
            side = np.array([rows[k]["tile"] for k in members])
            near = x @ x.T >= cosine
            np.fill_diagonal(near, False)
            if key[1] != key[2]:  # pairs within a tile are counted where it meets itself
                near &= side[:, None] != side[None, :]
            for k, n in zip(members, (near @ size).tolist(), strict=True):
                if n:
                    yield rows[k]["id"], n

    found = map_groups(rows, ["component", "low", "high"], ["id"], counts, "id bigint, n bigint")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


def near_embeddings(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    window: int = WINDOW,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    units = checkpointed(unit_vectors(rows, id_col, vector_col))
    valid = units.filter("unit is not null and vec_id is not null")
    classes = checkpointed(
        valid.groupBy("digest").agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size"), F.first("unit").alias("unit")
        )
    )
    vectors = classes.select("id", "size", "unit")
    links = neighbour_links(vectors, passes_for(classes.count(), cosine, window), cosine, window, block)
    groups = connected_components(links)
    counts = link_counts(vectors, groups, cosine, tile)
    named = checkpointed(
        classes.select("digest", "id", "size")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .join(counts, "id", "left")
        .select(
            "digest",
            "size",
            F.coalesce("component", "id").alias("component_id"),
            (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        )
    )
    total = named.agg(F.sum("size")).first()[0] or 0
    linked = attach(valid.select("vec_id", "digest"), named, "digest", "size", total)
    alone = units.filter("unit is null or vec_id is null").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        linked.select("vec_id", "n_links", "component_id")
        .unionByName(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"))
