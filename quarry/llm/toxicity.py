"""Toxic spans and document scores from a linear-chain CRF (operator 6).

Only documents are labelled, so tokens are labelled first: a token of a toxic
training document is toxic if its word or one of its affixes occurs significantly
more often in toxic than in clean training documents (G test, corrected for the
number of features). A two-state linear-chain CRF
(word and affix features, transitions) is fitted to these tokens by gradient
ascent with exact forward-backward marginals. To score a document its whole text
is tagged; the largest, summed and mean toxic marginals go through a logistic
function, fitted on the training documents, to its score, and runs of tokens with
a marginal of 0.5 or more are its offending spans.

The model is fitted on a bounded sample of labelled rows (SAMPLE per class, by
smallest seeded hash of the id) on the driver and broadcast: its size depends on
the sample and MAX_FEATURES only. Scoring runs row by row on the executors,
without a shuffle, on the text alone.

Defined cases: a null or empty text has no tokens and gets the lowest score that
the model gives; a null id counts as held out; null labels and labels without a
document are not used, of repeated labels the largest counts; without labels of
both classes every score is the smoothed share of toxic labels; other columns are
ignored; no documents give no rows.
"""

from __future__ import annotations

import re
import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import arrow_types, checkpointed, rows_of, table, to_batches, worker_state

SAMPLE = 2500  # labelled rows of each class that the model is fitted on, at most
FOLDS, HELD_OUT = 5, 0
SEED = 6
MAX_FEATURES = 50_000
MIN_DOCS = 4  # toxic documents that a feature must occur in
MIN_ODDS = 4.0  # times more frequent in toxic documents, to label tokens
STEPS = 40
CACHE_WORDS = 150_000
SLICE_TOKENS = 1 << 20
CHUNK_TOKENS = 1 << 18  # of the sample, to keep the driver's arrays small
SCORES = (
    "doc_id bigint, held_out boolean, score double, predicted int, "
    "n_toxic_tokens bigint, spans array<struct<start:int,end:int>>"
)

_EDGES = string.punctuation + "«»“”„’‘…¡¿–—"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def features(token: bytes) -> list[str]:
    """The word without punctuation at its ends, and its affixes."""
    w = token.decode("utf-8", "replace").lower().strip(_EDGES)
    if not w:
        return []
    return ["=" + w, *(w[:k] + "+" for k in (3, 4, 5, 6) if len(w) > k), *(["+" + w[-4:]] if len(w) > 4 else [])]


class Ragged:
    """Sequences of different lengths laid out step by step: those that reach step t
    are the first ones at t, so that recursions run over all sequences at once."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        sorted_lengths = lengths[self.order]
        steps = int(sorted_lengths[0]) if len(lengths) else 0
        # Sequences that reach each step.
        self.alive = np.searchsorted(-sorted_lengths, -np.arange(1, steps + 1), side="right")
        self.at = np.concatenate([[0], np.cumsum(self.alive)]).astype(np.int64)
        rank = np.empty(len(lengths), np.int64)
        rank[self.order] = np.arange(len(lengths))
        starts = np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
        self.place = (self.at[step] + np.repeat(rank, lengths)).astype(np.int32)

    def lay(self, flat: np.ndarray) -> np.ndarray:
        out = np.empty(len(flat))
        out[self.place] = flat
        return out


def marginals(emission: np.ndarray, grid: Ragged, trans: np.ndarray, pairs: bool = False):
    """P(toxic) of each token, and the expected transitions if ``pairs``.

    ``emission``: log odds of the toxic state, sequence after sequence, laid out as
    ``grid`` says; ``trans``: 2 x 2 log potentials. Forward and backward messages are kept as the ratio of
    the two states, which neither under- nor overflows.
    """
    if not len(emission):
        return np.empty(0), np.zeros((2, 2))
    e = grid.lay(np.exp(np.clip(emission, -30, 30)))
    (t00, t01), (t10, t11) = np.exp(trans)
    f, b = np.empty_like(e), np.ones_like(e)
    at, alive = grid.at, grid.alive
    f[: alive[0]] = e[: alive[0]]
    for t in range(1, len(alive)):
        n = alive[t]
        r = f[at[t - 1] : at[t - 1] + n]
        f[at[t] : at[t] + n] = e[at[t] : at[t] + n] * (t01 + r * t11) / (t00 + r * t10)
    for t in range(len(alive) - 1, 0, -1):
        n = alive[t]
        s = e[at[t] : at[t] + n] * b[at[t] : at[t] + n]
        b[at[t - 1] : at[t - 1] + n] = (t10 + t11 * s) / (t00 + t01 * s)
    odds = f * b
    found = (odds / (1 + odds))[grid.place]
    expected = np.zeros((2, 2))
    if pairs and len(alive) > 1:
        later = np.arange(at[1], len(e))
        n = np.repeat(alive[:-1], alive[1:])  # tokens of the step before
        r, s = f[later - n], e[later] * b[later]
        weights = np.stack([np.full(len(r), t00), t01 * s, r * t10, r * t11 * s])
        expected = (weights / weights.sum(0)).sum(1).reshape(2, 2)
    return found, expected


@dataclass
class Tagger:
    """The fitted model; small enough to broadcast."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    score: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def emission(self, token: bytes) -> float:
        get = self.weights.get
        return self.bias + sum(get(f, 0.0) for f in features(token))

    def documents(self, toxic: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Largest, summed and mean marginal of each document, as inputs of the score."""
        out = np.zeros((len(lengths), 3))
        some = lengths > 0
        starts = (np.cumsum(lengths) - lengths)[some]
        if len(starts):
            out[some, 0] = np.maximum.reduceat(toxic, starts)
            total = np.add.reduceat(toxic, starts)
            out[some, 1] = np.log1p(total)
            out[some, 2] = np.log1p(1000 * total / lengths[some])
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.score[0] + x @ np.array(self.score[1:]), -500, 500)))


class Sequences:
    """Some training documents as token counts and their (token, feature) pairs."""

    def __init__(self, toxic: np.ndarray, lengths: np.ndarray, of_token: np.ndarray, of_feature: np.ndarray):
        self.toxic, self.lengths, self.of_token, self.of_feature = toxic, lengths, of_token, of_feature
        self.n = int(lengths.sum())
        self.grid = Ragged(lengths)

    def label(self, marks: np.ndarray) -> None:
        """A token of a toxic document is toxic if one of its features marks it."""
        labels = np.zeros(self.n, bool)
        labels[self.of_token[marks[self.of_feature]]] = True
        labels &= np.repeat(self.toxic > 0, self.lengths)
        first = (np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]
        follows = np.ones(self.n, bool)
        follows[first] = False
        at = np.flatnonzero(follows)
        here, before = labels[at], labels[at - 1]
        self.labels = labels
        self.pairs = np.array([[(a & b).sum() for b in (~here, here)] for a in (~before, before)], float)

    def marginals(self, w: np.ndarray, pairs: bool = False):
        """Under weights of the features, the bias and the four transitions."""
        emission = w[-5] + np.bincount(self.of_token, w[self.of_feature], minlength=self.n)
        return marginals(emission, self.grid, w[-4:].reshape(2, 2), pairs)

    def gradient(self, w: np.ndarray) -> np.ndarray:
        p, expected = self.marginals(w, pairs=True)
        gap = self.labels - p
        by_feature = np.bincount(self.of_feature, gap[self.of_token], minlength=len(w) - 5)
        return np.concatenate([by_feature, [gap.sum()], (self.pairs - expected).ravel()])


def constant(shares: tuple[float, float]) -> Tagger:
    """Without labels of both classes: the smoothed share of toxic labels for every text."""
    p = (shares[1] + 0.5) / (sum(shares) + 2)
    return Tagger(score=(float(np.log(p / (1 - p))), 0.0, 0.0, 0.0))


def fit(docs: list[Sequences], telling: dict[str, float], shares: tuple[float, float]) -> Tagger:
    """A tagger from sequences in chunks; ``telling``: features in order, with how many times more
    frequent they are in toxic documents; ``shares``: labelled rows of class 0 and 1."""
    odds = np.array(list(telling.values()))
    for d in docs:
        d.label(odds >= MIN_ODDS)
    # Adam on the penalised log likelihood: feature weights, bias, transitions.
    w = np.concatenate([np.minimum(3.0, np.log(odds)) / 3, [-4.0], np.zeros(4)])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        grad = sum(d.gradient(w) for d in docs) - 0.1 * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w + 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model = Tagger(dict(zip(telling, w[:-5].tolist(), strict=True)), float(w[-5]), w[-4:].reshape(2, 2))
    x = np.concatenate([model.documents(d.marginals(w)[0], d.lengths) for d in docs])
    x = np.column_stack([np.ones(len(x)), x])
    y = np.concatenate([d.toxic for d in docs])
    n0, n1 = float((y == 0).sum()), float((y == 1).sum())
    weight = np.where(y == 1, shares[1] / n1, shares[0] / n0)
    weight *= len(y) / weight.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps of a ridge logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(beta))
        beta = beta + np.linalg.solve(hess, x.T @ (weight * (y - q)) - 0.05 * beta)
    model.score = tuple(beta.tolist())
    return model


def fold_of(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo FOLDS (null id: of an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def telling_features(sample: DataFrame, sizes: tuple[int, int]) -> dict[str, float]:
    """Features that are significantly more frequent in toxic documents of ``sample``
    (text, toxic), most telling first, with that ratio; at most MAX_FEATURES."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[str]] = {}
        for batch in batches:
            found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, toxic in zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True):
                own = set()
                for w in set(tokens(text)):
                    if w not in seen:
                        seen[w] = features(w)
                    own.update(seen[w])
                for f in own:
                    found[f][toxic] += 1
            if len(seen) > CACHE_WORDS:
                seen.clear()
            clean, bad = zip(*found.values(), strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.string()), pa.array(clean, pa.int64()), pa.array(bad, pa.int64())],
                names=["feature", "c0", "c1"],
            )

    counts = (
        sample.select("text", "toxic")
        .mapInArrow(count, "feature string, c0 bigint, c1 bigint")
        .groupBy("feature")
        .agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
        .filter(F.col("c1") >= MIN_DOCS)
    )
    counts = checkpointed(counts)
    n0, n1 = sizes
    base = n1 / (n0 + n1)
    least = 2 * float(np.log(max(counts.count(), 1))) + 4
    c0, c1, c = F.col("c0"), F.col("c1"), F.col("c0") + F.col("c1")
    odds = ((c1 + 0.5) / (n1 + 1)) / ((c0 + 0.5) / (n0 + 1))
    # G statistic of a feature's share of toxic documents against the base rate.
    clean_part = F.when(c0 > 0, c0 * F.log(c0 / (c * (1 - base)))).otherwise(0.0)
    surprise = 2 * (c1 * F.log(c1 / (c * base)) + clean_part)
    rows = counts.filter((odds > 2) & (surprise >= least)).select("feature", odds.alias("odds"))
    rows = rows.orderBy(F.desc("odds"), "feature").limit(MAX_FEATURES).collect()
    return {r["feature"]: r["odds"] for r in rows}


def encoded(sample: DataFrame, telling: dict[str, float]) -> list[Sequences]:
    """The sample's documents as sequences: only telling features reach the driver."""
    ids = sample.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(telling)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list[int]] = {}

        def rows() -> Iterator[tuple]:
            for r in rows_of(batches):
                at, of = [], []
                words = tokens(r["text"])
                for k, w in enumerate(words):
                    if w not in known:
                        known[w] = [ids.value[f] for f in features(w) if f in ids.value]
                    at += [k] * len(known[w])
                    of += known[w]
                if len(known) > CACHE_WORDS:
                    known.clear()
                packed = (np.array(x, np.int32).tobytes() for x in (at, of))
                yield r["doc_id"], r["toxic"], len(words), *packed

        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        yield from to_batches(rows(), ["doc_id", "toxic", "n", "at", "of"], types)

    found = sample.mapInArrow(run, "doc_id bigint, toxic int, n bigint, at binary, of binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["n"], r["at"], r["of"]))
    chunks, at = [], 0
    ends = np.cumsum([r["n"] for r in found])
    while at < len(found):  # chunks of at most CHUNK_TOKENS tokens, or one document
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_TOKENS, side="right")))
        chunks.append(sequences(found[at:last]))
        at = last
    return chunks


def sequences(rows: list) -> Sequences:
    lengths = np.array([r["n"] for r in rows], np.int64)
    starts = np.cumsum(lengths) - lengths
    at = [start + np.frombuffer(r["at"], np.int32) for start, r in zip(starts, rows, strict=True)]
    of = [np.frombuffer(r["of"], np.int32) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], float)
    return Sequences(toxic, lengths, np.concatenate(at).astype(np.int32), np.concatenate(of))


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Tagger:
    """Fits on at most ``sample`` labelled rows of each class, none of them held out."""
    own = (
        labels.filter("doc_id is not null and toxic is not null")
        .filter(fold_of(F.col("doc_id")) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    shares = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_hash = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    few = [own.filter(F.col("toxic") == c).orderBy(*by_hash).limit(sample) for c in (0, 1)]
    # At most 2 * sample ids are broadcast to the scan of the texts.
    chosen = F.broadcast(few[0].union(few[1]))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = checkpointed(texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = (float(shares.get(0, 0)), float(shares.get(1, 0)))
    if len(sizes) < 2:
        return constant(known)
    telling = telling_features(rows, (sizes[0], sizes[1]))
    if not telling:
        return constant(known)
    return fit(encoded(rows, telling), telling, known)


def toxicity_scores(docs: DataFrame, model: Tagger) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_toxic_tokens, spans) of every row; spans in code points."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    names = spark.createDataFrame([], SCORES).columns
    types = arrow_types(spark, SCORES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        yield from to_batches(_score_rows(tagger, batches), names, types)

    return rows.mapInArrow(run, SCORES)


class _Emissions(dict):
    """Emission of a token; forgets all when it has grown to CACHE_WORDS."""

    def __init__(self, tagger: Tagger):
        super().__init__()
        self.tagger = tagger

    def __missing__(self, token: bytes) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[token] = value = self.tagger.emission(token)
        return value


def _score_rows(tagger: Tagger, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    emission = worker_state(f"toxicity {hash(tagger.score)} {len(tagger.weights)}", lambda: _Emissions(tagger))
    held: list[tuple] = []
    n = 0

    def flush() -> Iterator[tuple]:
        lengths = np.array([len(h[2]) for h in held], np.int64)
        flat = np.concatenate([h[2] for h in held]) if held else np.empty(0)
        toxic, _ = marginals(flat, Ragged(lengths), tagger.trans)
        x = tagger.documents(toxic, lengths)
        scores = tagger.scores(x)
        starts = np.cumsum(lengths) - lengths
        for k, (doc_id, held_out, _, text) in enumerate(held):
            own = toxic[starts[k] : starts[k] + lengths[k]] >= 0.5
            hits = np.flatnonzero(own)
            spans = toxic_spans(text, hits) if len(hits) else []
            yield doc_id, held_out, float(scores[k]), int(scores[k] >= 0.5), len(hits), spans

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for doc_id, held_out, text in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                e = np.array([emission[w] for w in tokens(text)])
                held.append((doc_id, held_out, e, text))
                n += len(e)
                if n >= SLICE_TOKENS:
                    yield from flush()
                    held, n = [], 0
    yield from flush()


def toxic_spans(text: str, hits: np.ndarray) -> list[dict]:
    """Offsets of runs of neighbouring toxic tokens."""
    wanted, spans, last = set(hits.tolist()), [], -2
    for k, m in enumerate(_WORDS.finditer(text)):
        if k in wanted:
            if k == last + 1:
                spans[-1]["end"] = m.end()
            else:
                spans.append({"start": m.start(), "end": m.end()})
            last = k
    return spans


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted to be toxic, columns as given.

    Rows are filtered where they are scored: nothing is shuffled or joined.
    """
    tagger = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at).cast(pa.string())
            none = pa.nulls(batch.num_rows, pa.int64())
            plain = pa.RecordBatch.from_arrays([none, none, text], names=["doc_id", "held_out", "text"])
            clean = [row[3] == 0 for row in _score_rows(tagger.value, iter([plain]))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity_scores(docs, fit_toxicity(docs, labels))
