"""Proportional stratified interleaving into shards (operator 11).

Rows are shuffled within their source by a seeded hash and ranked; a row's fractional
rank is (rank - 1/2) / rows of its source. Sorted by fractional rank, every stretch of
the sequence holds the sources in the proportions of the whole, so cutting it into
equal stretches gives shards that match the mixture: row counts differ by one at most
(law ``rows``), and a source's share of a shard differs from its share of all rows by
little more than one row.

No source is sorted in one task. Both orders are made by range partitions: rows are
dealt by (source, hash, ...) or (fractional rank, hash, ...), numbered within their
partition, and offset by the counts of the partitions before, so a source with a third
of all rows spans a third of the partitions. What is known per partition (one row per
partition and source) is joined back; partitions of one source only number as many as
it fills. Only ids, sizes, checksums and hashes are shuffled, never texts.

Range bounds are sampled, so rows are stored with their partition before anything is
counted: rows and offsets see the same cut.

Defined cases: a null source is a source of its own; a null text has no bytes and the
checksum of an empty one; rows that repeat an id, or everything, are rows of their own
in neighbouring places; ties of the hash go by id (null first), checksum and size; an
empty table gives no rows; more shards than rows leave shards empty; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, table

SHARDS = 16
SEED = 11
#: Ranks and places are made in this many range partitions, or in those of a shuffle if they are more.
RANGES = 32


def sized_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED
) -> DataFrame:
    """(doc_id, source, size, text_crc32, shuffle): what sharding needs of a document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("bigint")
    seeded = F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"))
    return docs.select(
        doc_id.alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        F.md5(seeded.cast("binary")).alias("shuffle"),
    )


def numbered(rows: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "place") -> DataFrame:
    """``rows`` with ``name``: the number from 0 of each row in ``order``, within its ``group``
    if one is given (``order`` then has to begin with it).

    Rows that ``order`` doesn't tell apart are numbered in any order.
    """
    spark = rows.sparkSession
    parts = max(RANGES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = checkpointed(
        rows.repartitionByRange(parts, *[F.col(c) for c in order]).withColumn("_part", F.spark_partition_id())
    )
    # One row per partition and group that meet: partitions are contiguous, so there are
    # no more of them than partitions plus groups.
    counts = dealt.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy(*group).orderBy("_part")
    offsets = counts.withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows"))
    here = Window.partitionBy("_part", *group).orderBy(*order)
    local = dealt.withColumn("_local", F.row_number().over(here)).alias("r")
    offsets = offsets.select("_part", "_before", *group).alias("o")
    same = F.col("r._part") == F.col("o._part")
    for c in group:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    return local.join(offsets, same).select(
        *[F.col(f"r.{c}") for c in rows.columns],
        (F.col("o._before") + F.col("r._local") - 1).cast("bigint").alias(name),
    )


def interleaved(rows: DataFrame) -> DataFrame:
    """``rows`` of ``sized_rows`` with ``place``: their place from 0 in the interleaved sequence."""
    ties = ["shuffle", "doc_id", "text_crc32", "size"]
    ranked = numbered(rows, ["source", *ties], ["source"], "rank")
    # One row per source: aggregated on the map side, and joined by its own key.
    totals = rows.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_total"))
    with_total = ranked.join(totals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    fraction = (F.col("rank") * 2 + 1).cast("double") / (F.col("_total") * 2).cast("double")
    return numbered(with_total.withColumn("fraction", fraction), ["fraction", *ties, "source"]).drop("_total")


def into_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot): every row's shard and its place in it from 0."""
    if shards < 1:
        raise ValueError("there has to be a shard")
    rows = checkpointed(sized_rows(docs, id_col, text_col, source_col, seed))
    n = rows.count()
    placed = interleaved(rows)
    # Whole-number division: shard s holds the places from ceil(s * n / shards) on.
    shard = F.expr(f"cast(place * {shards}L div {max(n, 1)}L as int)").alias("shard")
    start = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return placed.select("doc_id", "source", "size", "text_crc32", shard, "place").select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("place") - start).alias("slot")
    )


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = into_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


#: The checksum is that of reflected polynomial EDB88320, made from the rule, byte by byte.
OP11_SQL = """
with recursive steps(i, k, v) as (
  select range::bigint, 0, range::bigint from range(256)
  union all
  select i, k + 1, case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from steps where k < 8
), lookup as (
  select list(v order by i) as t from steps where k = 8
), d as (
  select doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 as size,
         md5('11:' || doc_id::varchar) as h,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::bigint) as bytes
  from documents
), c as (
  select doc_id, source, size, h,
         xor(4294967295, list_reduce(list_prepend(4294967295::bigint, bytes),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) as crc
  from d, lookup
), r as (
  select *, row_number() over (partition by source order by h, doc_id, crc, size) - 1 as rank,
         count(*) over (partition by source) as total, count(*) over () as n
  from c
), p as (
  select *, row_number() over (order by (rank * 2 + 1)::double / (total * 2)::double, h, doc_id, crc, size, source) - 1
            as place
  from r
), s as (
  select *, (place * 16 // n)::int as shard from p
)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'rows' as law, shard,
       (place - (shard * n + 15) // 16)::bigint as slot, null::int as grown_shard, source
from s
"""
