"""Near-duplicate documents by MinHash with tensored banding (operator 4).

Similarity is the Jaccard index of sets of distinct word shingles. Two collections
of COLLECTION bands of ROWS minhashes each are computed; a table key joins a band
of the first collection with a band of the second, so COLLECTION^2 tables of
2 * ROWS minhashes cost 2 * COLLECTION * ROWS minhashes instead of
2 * ROWS * COLLECTION^2. Two sets meet in a table if they share a band in each
collection: at a Jaccard index of 0.8 that fails for 7 pairs in 10,000, and links
are redundant within a group.

The tensor also prunes: a band that only one set holds can't be part of a shared
key, so keys are formed only from bands that at least two sets share.

1. Equal sets form a class; one member of each stands for it.
2. Sets that share a table key are joined in stars; their components hold all links.
3. Within each component full sets are compared exactly (100 * intersection >=
   80 * union). Components are cut into blocks of bounded size, each pair of blocks is
   a task's group, and only links that connect sets leave it. No pairs are emitted
   but these, and no set is left out, however large a component is.
4. The components of the verified links, by their smallest id.

The 64-bit hashes of shingles stand for them: two different shingles of a pair of
texts agree with a probability of about 1e-13.

Defined cases: null texts and texts without words have an empty set and link with
nothing; a text of fewer words than a shingle has one element, its whole sequence;
rows that repeat an id are rows of their own, kept if the id is, and an id that
bears several texts is linked by each of them; a row without an
id links with nothing, is kept and has no component; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

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
from quarry.llm.shingles import linked_pairs, mixed, odd_numbers, shingle_hashes, word_hashes

PERCENT = 80
COLLECTION = 12  # bands of each of the two collections
ROWS = 3  # minhashes of a band
SEED = 4
BLOCK_SETS = 256  # sets of a block, about
BLOCK_SHINGLES = 1 << 19  # shingles of a block, about
SIGNATURES = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>"


def set_digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def bands_of(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Keys of the 2 * COLLECTION bands of a set of shingle hashes."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        np.minimum(least, (factors[:, None] * s[None, at : at + 4096]).min(1), out=least)
    rows = mixed(least).reshape(2 * COLLECTION, ROWS)
    weights = odd_numbers(SEED + 1, ROWS)
    names = mixed(np.arange(1, 2 * COLLECTION + 1, dtype=np.uint64))
    return mixed((rows * weights).sum(1, dtype=np.uint64) + names)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bands) of every row; empty sets have no bands."""
    types = arrow_types(docs.sparkSession, SIGNATURES)
    names = [c.split()[0] for c in SIGNATURES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = odd_numbers(SEED, 2 * COLLECTION * ROWS)

        def rows() -> Iterator[tuple]:
            for r in rows_of(batches):
                s = np.unique(shingle_hashes(word_hashes(r["text"]), words))
                bands = bands_of(s, factors).view(np.int64).tolist() if len(s) else None
                yield r["doc_id"], len(s), set_digest(s), bands

        yield from to_batches(rows(), names, types)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SIGNATURES)


def shared(rows: DataFrame, key: str, size: str, *more) -> DataFrame:
    """``rows`` whose key others have too, with the number of them in ``size``."""
    groups = rows.groupBy(key).agg(F.count(F.lit(1)).alias(size), *more).filter(f"{size} > 1")
    groups = checkpointed(groups)
    total = groups.agg(F.sum(size)).first()[0] or 0
    return attach(rows, groups, key, size, total)


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(node, component) of the sets (id, bands) that share a table key with others."""
    bands = sets.select("id", F.posexplode("bands").alias("band", "key"))
    common = shared(bands, "key", "n")
    first = F.col("band") < COLLECTION
    held = common.groupBy("id").agg(  # at most COLLECTION of each
        F.collect_list(F.when(first, F.col("key"))).alias("a"), F.collect_list(F.when(~first, F.col("key"))).alias("b")
    )
    keys = checkpointed(
        held.withColumn("a", F.explode("a")).select("id", F.explode("b").alias("b"), "a").select(
            "id", F.xxhash64("a", "b").alias("key")
        )
    )
    stars = shared(keys, "key", "n", F.min("id").alias("hub")).filter("id <> hub")
    return connected_components(stars.select(F.col("hub").alias("a"), F.col("id").alias("b")))


def verified_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) between the sets of each group that connect all that are linked."""
    members = checkpointed(
        groups.join(sets.select(F.col("id").alias("node"), "digest", "n_shingles"), "node").select(
            F.col("node").alias("doc_id"), "component", "digest", "n_shingles"
        )
    )
    sizes = checkpointed(
        members.groupBy("component")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
        .select(
            "component",
            "n",
            F.ceil(F.greatest(F.col("n") / BLOCK_SETS, F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
        )
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    placed = attach(members, sizes, "component", "n", total).select(
        "doc_id",
        "component",
        "digest",
        "blocks",
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.col("blocks")).cast("int").alias("block"),
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Texts are the stream side; the built side has ids only.
    wanted = texts.join(placed.hint("shuffle_hash"), "doc_id")
    schema = "doc_id bigint, component bigint, blocks int, block int, shingles binary"
    types = arrow_types(docs.sparkSession, schema)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for r in rows_of(batches):
                s = np.unique(shingle_hashes(word_hashes(r["text"]), words))
                if set_digest(s) == r["digest"]:  # else another row with that id
                    yield r["doc_id"], r["component"], r["blocks"], r["block"], s.tobytes()

        yield from to_batches(rows(), names, types, 64)

    # Each pair of blocks of a component meets in one group.
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = (
        wanted.mapInArrow(run, schema)
        .withColumn("other", others)
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .select("component", "low", "high", "doc_id", "block", "shingles")
    )

    def links(_: tuple, rows: list[dict]) -> Iterator[tuple]:
        rows = list({(r["doc_id"], r["shingles"]): r for r in rows}.values())
        held = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        for i, j in linked_pairs(held, [r["block"] for r in rows], percent):
            yield rows[i]["doc_id"], rows[j]["doc_id"]

    return map_groups(met, ["component", "low", "high"], ["doc_id"], links, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    rows = checkpointed(signatures(docs, words))
    filled = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = checkpointed(
        filled.groupBy("digest").agg(
            F.min("doc_id").alias("id"),
            F.count(F.lit(1)).alias("size"),
            F.first("bands").alias("bands"),
            F.first("n_shingles").alias("n_shingles"),
        )
    )
    groups = candidate_groups(classes)
    links = verified_links(docs, classes, groups, words, percent)
    found = connected_components(links)
    named = classes.select("digest", "id", "size").join(
        found.withColumnRenamed("node", "id"), "id", "left"
    )
    named = checkpointed(named.select("digest", "size", F.coalesce("component", "id").alias("component_id")))
    total = named.agg(F.sum("size")).first()[0] or 0
    linked = attach(filled.drop("bands"), named, "digest", "size", total)
    alone = rows.filter("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    return (
        linked.select("doc_id", "n_shingles", "component_id")
        .unionByName(alone.select("doc_id", "n_shingles", "component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near(docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """``docs`` (doc_id, text, ...) with one document of each group, columns as given."""
    stays = checkpointed(near_duplicates(docs, words, percent).filter("kept").select(F.col("doc_id").alias("_stay_id")))
    # The caller's columns travel in a struct, so none can bear a name used here.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("_key"))
    same = F.col("_key").eqNullSafe(F.col("_stay_id"))
    return rows.join(stays.hint("shuffle_hash"), same, "left_semi").select("row.*")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
