"""Exact deduplication against a persistent digest index (operator 8).

The index is a bucketed table, sorted by digest within each bucket: one row per
distinct normalised text ever seen, naming the document that stands for it. A
batch of documents is reduced to digests, its new digests are found by a
sort-merge anti join with the index (whose side needs no shuffle), and they are
appended. Everything is DataFrame work on the JVM.

Texts are equal when identical after deleting ASCII white space; a null text
counts as empty. Of equal texts in one batch, the row with the most code points
in the original text stays, then the smallest id (a null id last); a text that
the index holds already stays with its earlier document. Adding a batch twice
changes nothing and returns the same decisions: a step that is run again after a
failure is safe.

Defined cases: an empty batch adds nothing and returns no rows; rows that repeat
an id and a text are members of the group like any other and all kept if that id
is the one that stays; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import SPACE_CLASS, attach, checkpointed, table

BUCKETS = 32


class DigestIndex:
    """A table (digest, keep_id, n_points, n_buckets), bucketed and sorted by digest."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS, location: str | None = None):
        """Open or create the index ``name``; ``location`` keeps it outside the warehouse.

        An index keeps the number of buckets that it was created with.
        """
        self.spark, self.name = spark, name
        if not spark.catalog.tableExists(name):
            where = f" LOCATION '{location}'" if location else ""
            spark.sql(
                f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, n_points BIGINT, n_buckets INT) "
                f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS{where}"
            )
        first = spark.table(name).select("n_buckets").limit(1).collect()
        self.buckets = first[0][0] if first else self._declared()
        if self.buckets != self._declared():
            raise ValueError(f"index {name} was written with {self.buckets} buckets")

    def _declared(self) -> int:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}")
        return int(described.filter("col_name = 'Num Buckets'").select("data_type").first()[0])

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append the batch's new texts; return (doc_id, keep_id, group_size, kept, text_sha256).

        ``group_size`` counts the batch's rows with that text.
        """
        rows = checkpointed(digests(docs, id_col, text_col))
        # The best row first: most code points, then smallest id, null ids last.
        rank = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"))
        groups = checkpointed(
            rows.groupBy("digest")
            .agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
            .select("digest", "group_size", F.col("best.id").alias("first_id"), (-F.col("best.n")).alias("n_points"))
        )
        new = groups.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")
        (
            new.repartition(self.buckets, "digest")
            .select("digest", F.col("first_id").alias("keep_id"), "n_points", F.lit(self.buckets).alias("n_buckets"))
            .write.mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .format("parquet")
            .saveAsTable(self.name)
        )
        stays = self.entries().select("digest", "keep_id").hint("merge")
        decided = checkpointed(groups.select("digest", "group_size").join(stays, "digest"))
        total = decided.agg(F.sum("group_size")).first()[0] or 0
        return attach(rows, decided, "digest", "group_size", total).select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, digest, n): SHA-256 of the text without white space, code points of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.unhex(F.sha2(squeezed(F.col(text_col)), 256)).alias("digest"),
        F.char_length(text).cast("bigint").alias("n"),
    )


def squeezed(text: Column) -> Column:
    """The text without ASCII white space; empty for null."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE_CLASS + "+", "")


def exact_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The decisions for one table of documents, through an index of its own."""
    index = DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}")
    try:
        return checkpointed(index.add(docs, id_col, text_col))
    finally:
        index.drop()


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) without the rows that an equal text stands for, columns as given.

    Of rows that repeat an id and a text that stay, one stays. Texts are the stream
    side of a hash join with the ids and digests that stay.
    """
    stays = exact_decisions(docs).filter("kept").select(
        F.col("doc_id").alias("_stay_id"), F.unhex("text_sha256").alias("_stay_digest")
    )
    stays = checkpointed(stays.groupBy("_stay_id", "_stay_digest").agg(F.count(F.lit(1)).alias("_stay_rows")))
    # The caller's columns travel in a struct, so none can bear a name used here.
    marked = docs.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("bigint").alias("_stay_key"),
        F.unhex(F.sha2(squeezed(F.col("text")), 256)).alias("_text_digest"),
    )
    found = marked.join(
        stays.hint("shuffle_hash"),
        F.col("_stay_key").eqNullSafe(F.col("_stay_id")) & (F.col("_text_digest") == F.col("_stay_digest")),
    )
    once = found.filter("_stay_rows = 1")
    # The few that repeat an id and a text: one of them.
    repeated = found.filter("_stay_rows > 1").dropDuplicates(["_stay_key", "_text_digest"])
    return once.unionByName(repeated).select("row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_decisions(table(spark, sf_dir, "documents"))


OP8_SQL = """
with t as (
  select doc_id, length(coalesce(text, '')) as n,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') as norm
  from documents
), w as (
  select doc_id, norm,
         first_value(doc_id) over (partition by norm order by n desc, doc_id nulls last) as keep_id,
         count(*) over (partition by norm) as group_size
  from t
)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept,
       sha256(norm) as text_sha256
from w
"""
