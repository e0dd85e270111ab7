"""Ranked lexical search over norm buckets (operator 12).

A document is a vector of impacts: for each term, its weight w times
(10^9 * tf) div (1000 * tf + 12 * m). A query is a vector of term counts, and a score
their inner product, as in LEMP's search for large entries of a matrix product:

1. Statistics. One pass over the whole texts counts each document's terms and keeps the
   frequencies of those that a query has. N, L and df are sums over all documents.
2. Vectors with their lengths (Euclidean norms) are stored. A histogram of the lengths
   (a fixed number of bins per doubling) gives the length above which the first HEAD
   vectors lie.
3. The head is searched without thresholds; the k-th best score of each query so far is
   a threshold that no result may miss.
4. All others whose length can reach a threshold at all are ordered by length (range
   partitions, ties dealt by a hash of the id) and searched bucket by bucket: a query
   skips a bucket, and all later ones of the partition, if its own length times the
   bucket's longest vector is below its threshold (Cauchy-Schwarz). Inside a bucket the
   query's rarest coordinates are summed first; what the others can add is bounded for
   each vector by the lengths of what is left, and by each coordinate's largest value in
   the bucket. Vectors whose bound is below the threshold go.
5. Survivors are scored again, exactly, in 64-bit integers; each partition keeps k for a
   query, and the best k of those are the result.

Bounds are computed in doubles with a slack far above their rounding error, and only
drop what is strictly below a threshold, so equal scores always meet and the result is
that of scoring every document.

Queries are equal texts taken once and dealt into blocks of at most BLOCK_TERMS terms
by a hash of the text; a block's vocabulary is collected and broadcast, and the corpus
is read once per block. A single text longer than that is a block of its own.

Terms are the maximal matches of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, in whole
texts, with A-Z in lower case: on UTF-8, runs of ASCII letters, digits and bytes above 7F.

Defined cases: a null or empty text has no terms: as a document it is found by nothing
and not counted, as an item it finds nothing; rows that repeat an id are documents (or
items) of their own; a null doc_id comes last among equal scores; empty tables give no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, stored, table

TOP = 20
HEAD = 4096  # vectors searched without a threshold, at least
BUCKET = 1024  # vectors of one bucket
FOCUS = 8  # coordinates summed before the bounds are applied
BLOCK_TERMS = 400_000  # terms, with repeats, of the queries of one block
BINS = 16  # of the length histogram, per doubling
SLACK = 1e-9
NO_ID = (1 << 63) - 1  # stands for a null id in ties; put back as null

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
#: Separators to spaces, A-Z to lower case, all other bytes as they are.
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else 0x20 if b in _SEPARATORS else b for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# ------------------------------------------------------------------ queries
def query_texts(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, text, digest) of all items; ``digest`` names equal texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return items.select(
        F.col(id_col).alias("item_id"), text.alias("text"), F.md5(text.cast("binary")).alias("digest")
    )


def query_blocks(items: DataFrame, block_terms: int) -> Iterator[list[tuple[str, Counter]]]:
    """Distinct query texts as (digest, term counts), block by block."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(terms_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], names=["digest", "text", "n"])

    texts = items.groupBy("digest").agg(F.first("text").alias("text")).select("digest", "text")
    texts = checkpointed(texts.mapInArrow(counted, "digest string, text string, n long").filter("n > 0"))
    total = texts.agg(F.sum("n")).first()[0] or 0
    blocks = -(-2 * total // block_terms) if total > block_terms else 1
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("digest"), F.lit(blocks)))
    for block in range(blocks):
        held, n = [], 0
        # Half full on average: a fuller block is cut once more.
        for row in dealt.filter(F.col("block") == block).select("digest", "text", "n").toLocalIterator():
            if held and n + row["n"] > block_terms:
                yield held
                held, n = [], 0
            held.append((row["digest"], Counter(terms_of(row["text"]))))
            n += row["n"]
        if held:
            yield held


# ------------------------------------------------------------------ documents
def document_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms counted, frequencies of those in ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, sizes, terms, tfs = [], [0], [], []
                for text in part.column("text").to_pylist():
                    words = terms_of(text)
                    n.append(len(words))
                    which, tf = np.unique(
                        np.fromiter((known[w] for w in words if w in known), np.int32), return_counts=True
                    )
                    terms.append(which)
                    tfs.append(tf.astype(np.int64))
                    sizes.append(sizes[-1] + len(which))
                offsets = pa.array(sizes, pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x))) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"]
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>")


class Vectors:
    """Sparse vectors of a batch, flat: row, term and exact impact of each entry."""

    def __init__(self, batch: pa.RecordBatch, stats: tuple[int, int], weights: np.ndarray):
        n_docs, n_terms = stats
        n = batch.column("n").to_numpy()
        terms, tfs = batch.column("terms"), batch.column("tfs")
        sizes = np.diff(terms.offsets.to_numpy())
        self.rows = len(n)
        self.row = np.repeat(np.arange(self.rows), sizes)
        self.term = terms.flatten().to_numpy()
        tf = tfs.flatten().to_numpy()
        # Whole numbers of any size: 25 * n * N may pass 64 bits before it is divided.
        m = np.array([75 + (25 * int(k) * n_docs) // n_terms for k in n], np.int64)
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[self.row])
        self.value = weights[self.term].astype(np.float64) * self.impact
        self.length = np.sqrt(np.bincount(self.row, self.value**2, self.rows))


def with_lengths(counts: DataFrame, shared, stats: tuple[int, int]) -> DataFrame:
    """Documents that have a query's term, with the length of their vectors."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = Vectors(batch, stats, shared.value.weights).length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length)], names=[*batch.schema.names, "length"])

    schema = "doc_id long, n long, terms array<int>, tfs array<long>, length double"
    return counts.filter("size(terms) > 0").mapInArrow(measure, schema).filter("length > 0")


# ------------------------------------------------------------------ search
class Queries:
    """The queries of a block as sparse vectors over its vocabulary."""

    def __init__(self, block: list[tuple[str, Counter]], vocabulary: dict[bytes, int], weights: np.ndarray):
        self.weights = weights
        self.terms, self.counts, self.length = [], [], []
        for _, counted in block:
            terms = np.array([vocabulary[w] for w in counted], np.int64)
            counts = np.array(list(counted.values()), np.int64)
            # Heaviest coordinates first: the rarest say most about a score.
            order = np.argsort(-(counts * weights[terms]), kind="stable")
            order = order[weights[terms[order]] > 0]
            self.terms.append(terms[order])
            self.counts.append(counts[order])
            self.length.append(float(np.sqrt((counts[order].astype(np.float64) ** 2).sum())))
        self.length = np.array(self.length)


class Best:
    """The best ``top`` (score, document) of each query, and what a newcomer must reach."""

    def __init__(self, thresholds: np.ndarray, top: int):
        self.top, self.least = top, np.maximum(thresholds, 1).astype(np.int64)
        self.held: list[list[tuple[int, int]]] = [[] for _ in thresholds]

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        heap = self.held[query]
        for score, doc in zip(scores.tolist(), ids.tolist(), strict=True):
            if len(heap) < self.top:
                heapq.heappush(heap, (score, -doc))
            elif (score, -doc) > heap[0]:
                heapq.heapreplace(heap, (score, -doc))
        if len(heap) == self.top:
            self.least[query] = max(self.least[query], heap[0][0])


class Bucket:
    """Vectors of similar length, entries sorted by coordinate."""

    def __init__(self, vectors: Vectors, ids: np.ndarray):
        self.ids, self.rows, self.length = ids, vectors.rows, vectors.length
        self.longest = float(vectors.length.max())
        order = np.argsort(vectors.term, kind="stable")
        term = vectors.term[order]
        self.row, self.value, self.impact = vectors.row[order], vectors.value[order], vectors.impact[order]
        self.terms, start = np.unique(term, return_index=True)
        self.bounds = np.append(start, len(term))
        self.peak = np.maximum.reduceat(self.value, start) if len(term) else np.empty(0)

    def column(self, term: int) -> tuple[slice, float]:
        """Where the entries of a coordinate are, and the largest of them."""
        k = int(np.searchsorted(self.terms, term))
        if k == len(self.terms) or self.terms[k] != term:
            return slice(0, 0), 0.0
        return slice(self.bounds[k], self.bounds[k + 1]), float(self.peak[k])

    def search(self, queries: Queries, q: int, best: Best, focus: int) -> None:
        least = best.least[q]
        columns = [self.column(t) for t in queries.terms[q]]
        counts = queries.counts[q]
        rest = np.sqrt((counts[focus:].astype(np.float64) ** 2).sum())
        peaks = sum(float(c) * peak for c, (_, peak) in zip(counts[focus:], columns[focus:], strict=True))
        part, square = np.zeros(self.rows), np.zeros(self.rows)
        for c, (at, _) in zip(counts[:focus], columns[:focus], strict=True):
            part[self.row[at]] += float(c) * self.value[at]
            square[self.row[at]] += self.value[at] ** 2
        left = np.sqrt(np.maximum(self.length**2 * (1 + SLACK) - square, 0))
        bound = (part + np.minimum(rest * left, peaks)) * (1 + SLACK)
        survivors = np.flatnonzero(bound >= least)
        if not len(survivors):
            return
        # Exactly, in integers.
        number = np.full(self.rows, -1)
        number[survivors] = np.arange(len(survivors))
        scores = np.zeros(len(survivors), np.int64)
        for t, c, (at, _) in zip(queries.terms[q], counts, columns, strict=True):
            to = number[self.row[at]]
            hit = to >= 0
            scores[to[hit]] += int(c) * int(queries.weights[t]) * self.impact[at][hit]
        hit = scores >= least
        best.add(q, scores[hit], self.ids[survivors[hit]])


def search(vectors: DataFrame, shared, stats: tuple[int, int], thresholds: np.ndarray, top: int) -> DataFrame:
    """(query, doc_id, score): the best ``top`` of each partition, thresholds or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, best = shared.value, Best(thresholds, top)
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                vectors = Vectors(part, stats, queries.weights)
                ids = part.column("doc_id").fill_null(NO_ID).to_numpy()
                bucket = Bucket(vectors, ids)
                for q in np.flatnonzero(queries.length * bucket.longest * (1 + SLACK) >= best.least).tolist():
                    bucket.search(queries, q, best, FOCUS)
        found = [(q, -doc, score) for q, heap in enumerate(best.held) for score, doc in heap]
        if found:
            q, ids, scores = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([q, ids, scores], names=["query", "doc_id", "score"])

    return vectors.mapInArrow(run, "query long, doc_id long, score long")


def best_of(found: DataFrame, top: int) -> DataFrame:
    """``found`` with ``rank``, up to ``top``; ranks are limited before the shuffle as well as after."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def search_block(docs: DataFrame, block: list[tuple[str, Counter]], top: int, id_col: str, text_col: str, head: int):
    """(digest, rank, doc_id, score) for the queries of one block."""
    spark = docs.sparkSession
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, counted in block for w in counted}))}
    counts = stored(document_counts(docs, vocabulary, id_col, text_col), "lexical_counts")
    n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block: bounded by BLOCK_TERMS.
    df = np.zeros(len(vocabulary), np.int64)
    for term, n in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        df[term] = n
    weights = np.array([weight(n_docs, int(n)) for n in df], np.int64)
    queries = Queries(block, vocabulary, weights)
    shared, stats = spark.sparkContext.broadcast(queries), (n_docs, n_terms)
    vectors = checkpointed(with_lengths(counts, shared, stats))

    # Where the longest vectors begin: lengths differ by a few hundred doublings at most.
    bins = vectors.groupBy(F.floor(F.log2("length") * BINS).alias("bin")).count().collect()
    seen, cut = 0, 0.0
    for bin_, n in sorted(bins, reverse=True):
        seen += n
        cut = 2.0 ** (bin_ / BINS) * (1 - SLACK)
        if seen >= head:
            break
    first = checkpointed(best_of(search(vectors.filter(F.col("length") >= cut), shared, stats, np.zeros(len(block)), top), top))
    thresholds = np.zeros(len(block), np.int64)
    for q, score in first.filter(F.col("rank") == top).select("query", "score").collect():  # one row per query
        thresholds[q] = score
    reach = np.divide(thresholds, queries.length, out=np.full(len(block), np.inf), where=queries.length > 0)
    least = float(reach.min()) * (1 - SLACK)
    rest = vectors.filter((F.col("length") < cut) & (F.col("length") >= least))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rest.repartitionByRange(parts, F.desc("length"), F.xxhash64("doc_id")).sortWithinPartitions(F.desc("length"))
    found = first.drop("rank").unionByName(search(ordered, shared, stats, thresholds, top))
    names = spark.createDataFrame([(k, digest) for k, (digest, _) in enumerate(block)], "query long, digest string")
    return best_of(found, top).join(F.broadcast(names), "query").select("digest", "rank", "doc_id", "score")


def ranked(
    items: DataFrame,
    docs: DataFrame,
    top: int = TOP,
    item_id: str = "item_id",
    item_text: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
    head: int = HEAD,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item, best first."""
    asked = checkpointed(query_texts(items, item_id, item_text))
    found = None
    for block in query_blocks(asked, block_terms):
        part = checkpointed(search_block(docs, block, top, id_col, text_col, head))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "digest string, rank int, doc_id long, score long")
    no_id = F.col("doc_id") == NO_ID
    return (
        asked.select("item_id", "digest")
        .join(found, "digest")
        .select("item_id", "rank", F.when(~no_id, F.col("doc_id")).alias("doc_id"), "score")
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), i as (
  select row_number() over () as q, item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from benchmark
), s as (
  select count(*)::bigint as n_docs, sum(len(terms))::bigint as n_terms from d where len(terms) > 0
), a as (
  select q, item_id, term, count(*) as c from (select q, item_id, unnest(terms) as term from i) group by all
), t as (
  select r, doc_id, n, term, count(*) as tf
  from (select r, doc_id, len(terms) as n, unnest(terms) as term from d) group by all
), w as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from t, s group by term, n_docs
), x as (
  select q, item_id, r, doc_id,
         sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
  from a join t using (term) join w using (term), s
  group by q, item_id, r, doc_id
), k as (
  select *, row_number() over (partition by q order by score desc, doc_id nulls last)::int as rank from x where score > 0
)
select item_id, rank, doc_id, score from k where rank <= 20
"""
