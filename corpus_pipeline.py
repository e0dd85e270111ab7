"""The corpus pipeline: documents to training tokens in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. Every stage works on all rows that its predecessor kept. All but the last
return the columns of ``docs``.

1. toxicity: drops the documents that the tagger, fitted on the table's labels,
   predicts to be toxic.
2. exact_dedup: of documents with equal texts one stays.
3. near_dedup: of each group of near duplicates one stays.
4. mixing: gives each document as often as the mix of sources takes it.
5. tokens: encodes the texts; returns ids and digests.

Defined cases are those of the operators: empty tables give empty results, null
texts count as empty, null sources are a source of their own; other columns pass
through the first four stages. Rows that repeat a document entirely are exact
duplicates: one stays after the second stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.bpe import token_digests
from quarry.llm.common import stored, table
from quarry.llm.exact_dedup import drop_exact
from quarry.llm.minhash_dedup import drop_near
from quarry.llm.mixing import mix_documents
from quarry.llm.toxicity import without_toxic

#: Near duplicates share word shingles of this length.
SHINGLE_WORDS = 5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs, SHINGLE_WORDS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_digests(docs, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: SQL can't express the tagger, MinHash or BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
