"""Passages that repeat across documents, by collinear chaining of seeds (operator 7).

1. Seeds: of every run of WINDOW k-mers (SEED_WORDS words) the one with the smallest
   hash is a minimizer; two neighbouring ones with their distance are a seed, so equal
   runs of SEED_WORDS + 2 * WINDOW - 1 words have a common seed. K-mers are short, as
   substituted words leave only short runs of a fuzzy repeat equal; pairs of them are
   rare, so that a common phrase doesn't tie a passage to an unrelated document.
2. Occurrences of a seed with the same seed before or after them are matched in stars
   with the smallest document: matches of copies grow with the occurrences, not with their
   square. Occurrences in different surroundings are matched with each other where two
   such seeds are near each other, in blocks. Seeds held by thousands of documents are
   kept, and spread over tasks. A match with no other of the same pair of documents near
   it is left out, whatever its place.
3. The matches of a pair of documents are chained in order in both: the best chain
   into each match is found in a Fenwick tree of prefix maxima, over scores that
   charge gaps by their length; chains are cut where a gap is over MAX_GAP words.
4. Chains are aligned: word hashes of both passages are cut out of their documents,
   the gaps between seeds and up to REACH words beyond the outer ones are aligned within
   a band, and chains of at least MIN_CHAIN words and IDENTITY remain.
5. Passages of a document that overlap or touch are united over its partners; those of
   at least MIN_WORDS words are returned. A passage whose parts are first seen in
   different documents is found whole in this way.

A result row is a passage of ``doc_id`` that also occurs in the documents ``others``
(each a smaller one that holds one of its seeds), as half-open ranges of words and of
code points. The document that others point to is not repeated as a row of its own.

Defined cases: null texts and texts of fewer than two minimizers hold no passages;
rows without an id are ignored; rows that repeat an id count as one document, which
isn't compared with itself, and ranges may then refer to either text; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import arrow_types, attach, checkpointed, map_group_lists, map_groups, rows_of, stored, table, to_batches
from quarry.llm.shingles import mixed, odd_numbers, shingle_hashes, word_bounds, word_hashes

SEED_WORDS = 3  # of each of the two minimizers of a seed
WINDOW = 4
BLOCK = 256  # documents that are matched with each other at once
PART = 20_000  # occurrences of one seed that are held at once
MAX_GAP = 30  # words between seeds of a chain, in either document
GAP_COST = 0.25  # of each word by which the gaps differ, in words matched
SKIP_COST = 0.02  # of each word skipped
MIN_CHAIN = 10
MIN_WORDS = 50
IDENTITY = 0.8  # words in common, of the longer side of a chain
PIECE_WORDS = 2048  # long chains are aligned in pieces of about this length
REGION_WORDS = 4 * PIECE_WORDS  # words of neighbouring pieces that travel together, at most
REGIONS = 256  # regions whose ends are aligned at once
RANGES = 256  # ranges cut out of a document in one row, about
THIN = 8  # words between the seeds that are kept of an equal run
#: How far a chain is extended beyond its outer seeds, at most: seeds may be missing for as long as a passage.
REACH = MIN_WORDS
END_COSTS = (1, 4)  # of a word that differs in an end; at 4 common words pay for one, as IDENTITY says
BAND = 10  # words inserted or left out beyond the outer seeds, at most: what IDENTITY allows in MIN_WORDS


def minimizers(h: np.ndarray) -> np.ndarray:
    """Places of the smallest hash of every WINDOW hashes in a row; the first of equal ones."""
    n = max(1, len(h) - WINDOW + 1)
    low, at = h[:n].copy(), np.arange(n)
    for k in range(1, min(WINDOW, len(h))):
        less = h[k : k + n] < low
        low[less] = h[k : k + n][less]
        at[less] = np.flatnonzero(less) + k
    # Places of minima never go back.
    return at[np.concatenate([[True], at[1:] != at[:-1]])]


def seeds_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and word positions of a text's seeds: neighbouring minimizers and their distance."""
    words = word_hashes(text)
    if len(words) <= SEED_WORDS:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = shingle_hashes(words, SEED_WORDS)
    at = minimizers(h)
    one, two, three = odd_numbers(SEED_WORDS, 3)
    gap = np.diff(at).astype(np.uint64)
    return mixed(h[at[:-1]] * one + h[at[1:]] * two + gap * three), at[:-1]


def seeds(docs: DataFrame) -> DataFrame:
    """(seed, doc_id, at) for every seed of every document."""
    schema = "doc_id bigint, seeds array<bigint>, places array<int>"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = [seeds_of(t) for t in part.column("text").to_pylist()]
                ends = pa.array(np.cumsum([0, *(len(at) for _, at in found)]), pa.int32())
                hashes = pa.array(np.concatenate([h for h, _ in found]).view(np.int64))
                places = pa.array(np.concatenate([at for _, at in found]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, values) for values in (hashes, places)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], names=names)

    # Stored in lists, as range bounds and the rows themselves are read from them.
    found = stored(docs.select("doc_id", "text").mapInArrow(run, schema), "seeds")
    return found.mapInArrow(with_sides, "seed bigint, doc_id bigint, at int, sides int")


def with_sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, doc_id, at, sides) of lists of seeds: 16 bits each of the seed before and the one after."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            lists = part.column("seeds")
            seed = lists.flatten().to_numpy(zero_copy_only=False)
            n = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            doc = np.repeat(part.column("doc_id").to_numpy(zero_copy_only=False), n)
            # At a text's ends there is no seed: the document's own hash is like no other's.
            ends = np.cumsum(n)
            short, own = seed.view(np.uint64) >> np.uint64(48), mixed(doc.view(np.uint64)) >> np.uint64(48)
            left, right = np.roll(short, 1), np.roll(short, -1)
            first, last = (ends - n)[n > 0], ends[n > 0] - 1
            left[first], right[last] = own[first], own[last]
            sides = (left << np.uint64(16) | right).astype(np.uint32).view(np.int32)
            columns = [pa.array(seed), pa.array(doc), part.column("places").flatten(), pa.array(sides)]
            yield pa.RecordBatch.from_arrays(columns, names=["seed", "doc_id", "at", "sides"])


def hubs(seed: np.ndarray, side: np.ndarray) -> np.ndarray:
    """For each occurrence, the first one with the same seed and side."""
    order = np.lexsort((side, seed))
    same_as = (seed[order][1:] == seed[order][:-1]) & (side[order][1:] == side[order][:-1])
    starts = np.flatnonzero(np.concatenate([[True], ~same_as]))
    hub = np.empty(len(seed), np.int64)
    hub[order] = np.repeat(order[starts], np.diff(np.append(starts, len(seed))))
    return hub


def matched(seed: np.ndarray, doc: np.ndarray, at: np.ndarray, sides: np.ndarray) -> tuple[tuple, np.ndarray]:
    """Matches (a, b, at_a, at_b) among occurrences sorted by seed, document and place, and
    the occurrences that are the first of their seed on both sides."""
    own = np.arange(len(seed))
    left, right, both = (hubs(seed, x) for x in (sides >> 16, sides & 0xFFFF, sides))
    first = hubs(seed, np.zeros_like(sides))
    # Each pair once, though an occurrence may be the first of several kinds.
    news = left != first, (right != first) & (right != left), (both != left) & (both != right)
    x = np.concatenate([first, *(hub[new] for hub, new in zip((left, right, both), news, strict=True))])
    y = np.concatenate([own, *(own[new] for new in news)])
    x, y = (i[doc[x] != doc[y]] for i in (x, y))
    return (doc[x], doc[y], at[x], at[y]), (left == own) & (right == own)


def star_matches(found: DataFrame) -> DataFrame:
    """(a, b, at_a, at_b): the occurrences of each seed in different documents, a smaller than b.

    Each occurrence is matched with the first one of its seed, and, as copies there, with the
    first that has the same seed before it, after it, or both: four stars. The same
    phrase in other surroundings is no copy, and its first document may have nothing else of
    a passage: occurrences that are the first on both of their sides stand for the
    surroundings of a seed, and all documents with two such near each other are matched.

    Occurrences are range-partitioned and sorted by seed and document, so a frequent seed
    is spread over tasks, and a task holds at most PART of one seed at once. Where a seed
    is cut, what stands for it in each part is matched with the first that does.
    """
    schema = "seed bigint, a bigint, b bigint, at_a int, at_b int, cut boolean"
    types = arrow_types(found.sparkSession, schema)
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(part: tuple[np.ndarray, ...], begins: bool, ends: bool) -> pa.RecordBatch:
        """Matches, and what stands for seeds of several surroundings or that may go on
        elsewhere: the first one if the part ``begins`` there, the last if it ``ends`` there."""
        seed = part[0]
        change = seed[1:] != seed[:-1]
        starts = np.flatnonzero(np.concatenate([[True], change]))
        cut = (begins & (seed == seed[0])) | (ends & (seed == seed[-1]))
        shared = cut | np.repeat(np.diff(np.append(starts, len(seed))) > 1, np.diff(np.append(starts, len(seed))))
        seed, doc, at, sides, cut = (x[shared] for x in (*part, cut))
        if not len(seed):
            return pa.RecordBatch.from_arrays([pa.array([], t) for t in types], names=names)
        matches, stands = matched(seed, doc, at, sides)
        starts = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
        several = np.repeat(np.add.reduceat(stands, starts) > 1, np.diff(np.append(starts, len(seed))))
        k = np.flatnonzero(stands & (several | cut))
        none, n = [pa.nulls(len(k), t) for t in types], len(matches[0])
        firsts = [pa.array(seed[k]), pa.array(doc[k]), none[2], pa.array(at[k], types[3]), none[4], pa.array(cut[k])]
        pairs = [pa.nulls(n, types[0]), *(pa.array(x, t) for x, t in zip(matches, types[1:], strict=False)), pa.nulls(n, types[5])]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(pairs, firsts, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        begins = True
        for batch in batches:
            now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            if not len(now[0]):
                continue
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            end = int(np.searchsorted(now[0], now[0][-1]))  # the last seed may go on in the next batch
            whole = end > 0
            if not whole and len(now[0]) > PART:
                end = len(now[0])
            if end:
                yield rows(tuple(x[:end] for x in now), begins, not whole)
                begins = not whole
            held = tuple(x[end:] for x in now) if end < len(now[0]) else None
        if held is not None:
            yield rows(held, begins, True)

    dealt = found.repartitionByRange("seed", "doc_id").sortWithinPartitions("seed", "doc_id", "at")
    # Stored: the uses below must see the same partitions.
    out = checkpointed(dealt.select("seed", "doc_id", "at", "sides").mapInArrow(run, schema))
    columns = ["a", "b", "at_a", "at_b"]
    firsts = out.filter("b is null").select("seed", F.col("a").alias("b"), F.col("at_a").alias("at_b"), "cut")
    cuts = firsts.filter("cut")
    first = cuts.groupBy("seed").agg(F.min(F.struct("b", "at_b")).alias("hub"))
    across = cuts.join(first, "seed").filter("b <> hub.b")
    across = across.select(F.col("hub.b").alias("a"), "b", F.col("hub.at_b").alias("at_a"), "at_b")
    near = near_matches(firsts.select("seed", F.col("b").alias("doc_id"), F.col("at_b").alias("at")))
    return out.filter("b is not null").select(*columns).unionByName(across).unionByName(near)


def near_matches(firsts: DataFrame) -> DataFrame:
    """(a, b, at_a, at_b) of the documents that hold the same two seeds of ``firsts`` (seed,
    doc_id, at), in this order and near enough for a chain."""
    schema = "two bigint, doc_id bigint, at int, to int"
    types = arrow_types(firsts.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = odd_numbers(2, 2)
        held: tuple[np.ndarray, ...] | None = None
        # The last rows of a batch are looked at again with the next one, as beginnings.
        for batch in batches:
            now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            kept = len(held[0]) if held is not None else 0
            if held is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now, strict=True))
            seed, doc, at = now
            k = 1
            while k < len(seed):
                ok = (doc[k:] == doc[:-k]) & (at[k:] - at[:-k] <= MAX_GAP + SEED_WORDS)
                if not ok.any():
                    break
                # Ends among the rows of this batch: those before it were seen with the last one.
                x = np.flatnonzero(ok)
                x = x[(x + k >= kept) & (at[x + k] > at[x])]
                two = mixed(seed[x].view(np.uint64) * one + seed[x + k].view(np.uint64) * other).view(np.int64)
                found = [pa.array(v, t) for v, t in zip((two, doc[x], at[x], at[x + k]), types, strict=True)]
                yield pa.RecordBatch.from_arrays(found, names=["two", "doc_id", "at", "to"])
                k += 1
            if len(seed):
                back = (doc == doc[-1]) & (at >= at[-1] - MAX_GAP - SEED_WORDS)
                held = tuple(x[back] for x in now)

    dealt = firsts.repartition("doc_id").sortWithinPartitions("doc_id", "at", "seed").select("seed", "doc_id", "at")
    twos = checkpointed(dealt.mapInArrow(run, schema))
    # Rows of the same two seeds in blocks, each of which meets itself and every later one.
    of_two = Window.partitionBy("two")
    place = F.row_number().over(of_two.orderBy("doc_id", "at", "to")) - 1
    numbered = twos.select("*", place.alias("k"), F.count(F.lit(1)).over(of_two).alias("n")).filter("n > 1")
    block = F.floor(F.col("k") / BLOCK).cast("int")
    last = F.floor((F.col("n") - 1) / BLOCK).cast("int")
    blocks = numbered.groupBy("two", block.alias("i"), last.alias("last")).agg(
        F.collect_list("doc_id").alias("docs"), F.collect_list("at").alias("at"), F.collect_list("to").alias("to")
    )
    meets = blocks.withColumn("j", F.explode(F.sequence(F.lit(0), "last")))
    meets = meets.select("two", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), F.struct("docs", "at", "to").alias("block"))
    parts = int(firsts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = meets.repartition(parts, "two", "x", "y").groupBy("two", "x", "y").agg(F.collect_list("block").alias("blocks"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            sides = [tuple(np.array(b[c]) for c in ("docs", "at", "to")) for b in row["blocks"]]
            one, other = sides[0], sides[-1]
            x, y = np.triu_indices(len(one[0]), 1) if len(sides) == 1 else np.indices((len(one[0]), len(other[0]))).reshape(2, -1)
            different = one[0][x] != other[0][y]
            x, y = x[different], y[different]
            first = one[0][x] < other[0][y]
            lists = []
            for k in range(3):
                u, v = one[k][x], other[k][y]
                lists.append((np.where(first, u, v), np.where(first, v, u)))
            (a, b), ats, tos = lists
            found = [np.concatenate(v) for v in ((a, a), (b, b), (ats[0], tos[0]), (ats[1], tos[1]))]
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32()
            arrays = [pa.array(v, t) for v, t in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "at_a", "at_b"])

    return pairs.select("blocks").mapInArrow(meet, "a bigint, b bigint, at_a int, at_b int")


def promising(pair: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(pair, at_a, at_b) of the matches that may be part of a passage, pair by pair, of
    matches in order of pair, at_b and at_a; pairs are numbered.

    Matches that stand alone are left out. Their distance says nothing: a passage with a
    share of 1 - IDENTITY of its words changed may have all its seeds at one place. Of
    an equal run the outer seeds and one in THIN words are kept.
    """
    new = np.ones(len(pair), bool)  # a match may come from several stars and pairs of seeds
    new[1:] = (np.diff(pair) != 0) | (np.diff(at_b) != 0) | (np.diff(at_a) != 0)
    pair, at_a, at_b = pair[new], at_a[new].astype(np.int64), at_b[new].astype(np.int64)
    far = (np.diff(pair) != 0) | (np.diff(at_b) > MAX_GAP + SEED_WORDS)
    single = np.concatenate([[True], far]) & np.concatenate([far, [True]])
    pair, at_a, at_b = (x[~single] for x in (pair, at_a, at_b))
    if not len(pair):
        return pair, at_a, at_b
    order = np.lexsort((at_b, at_b - at_a, pair))
    pair, at_a, at_b = (x[order] for x in (pair, at_a, at_b))
    new = np.ones(len(pair), bool)
    new[1:] = (np.diff(pair) != 0) | (np.diff(at_b - at_a) != 0) | (np.diff(at_b) > SEED_WORDS)
    starts = np.flatnonzero(new)
    part = (at_b - np.repeat(at_b[starts], np.diff(np.append(starts, len(at_b))))) // THIN
    keep = new | np.concatenate([new[1:], [True]])
    keep[1:] |= part[1:] != part[:-1]
    return pair[keep], at_a[keep], at_b[keep]


class PrefixMax:
    """A Fenwick tree: the largest (score, item) at places up to a given one."""

    def __init__(self, n: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (n + 1)

    def put(self, place: int, score: float, item: int) -> None:
        place += 1
        while place < len(self.best):
            if score > self.best[place][0]:
                self.best[place] = (score, item)
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        best = (-np.inf, -1)
        place += 1
        while place > 0:
            if self.best[place][0] > best[0]:
                best = self.best[place]
            place -= place & -place
        return best


def chains(matches: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The matches (at_a, at_b) of two documents as chains that ascend in both.

    A match joins the chain with the best score, less a cost for every word skipped
    and every word by which the two gaps differ. The cost of a gap is split into a
    part of each end, so the best predecessor is a prefix maximum: one tree holds
    predecessors on the diagonals up to the match's, the other those from it on.
    """
    matches = sorted(set(matches), key=lambda m: (m[1], m[0]))
    diagonals = sorted({b - a for a, b in matches})
    rank = {d: k for k, d in enumerate(diagonals)}
    n = len(diagonals)
    lower, upper = PrefixMax(n), PrefixMax(n)
    same: dict[int, int] = {}  # the last match of each diagonal
    score, back = [0.0] * len(matches), [-1] * len(matches)
    for k, (a, b) in enumerate(matches):
        d = b - a
        skip, shift = SKIP_COST * b, GAP_COST * d
        best = 0.0
        for item in {lower.upto(rank[d])[1], upper.upto(n - 1 - rank[d])[1], same.get(d, -1)} - {-1}:
            pa_, pb = matches[item]
            if pa_ < a and pb < b:  # a prefix maximum may lie ahead in the other document
                gap = score[item] - SKIP_COST * (b - pb) - GAP_COST * abs(d - (pb - pa_))
                gap -= max(0, SEED_WORDS - min(a - pa_, b - pb))  # words that both seeds hold
                if gap > best:
                    best, back[k] = gap, item
        score[k] = SEED_WORDS + best
        lower.put(rank[d], score[k] + skip + shift, k)
        upper.put(n - 1 - rank[d], score[k] + skip - shift, k)
        same[d] = k
    # Best chains first; a match belongs to one chain, and a chain ends where a gap is too large.
    found, used = [], [False] * len(matches)
    for k in sorted(range(len(matches)), key=lambda i: (-score[i], matches[i])):
        chain: list[tuple[int, int]] = []
        while k >= 0 and not used[k]:
            used[k] = True
            a, b = matches[k]
            if chain and max(chain[-1][0] - a, chain[-1][1] - b) > MAX_GAP + SEED_WORDS:
                found.append(chain[::-1])
                chain = []
            chain.append((a, b))
            k = back[k]
        if chain:
            found.append(chain[::-1])
    return found


def pieces_of(matches: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """The chains as (start_a, end_a, start_b, end_b) in words, in order of start_b.

    Long chains are cut at seeds; their pieces overlap in one seed.
    """
    found = []
    for chain in chains(matches):
        (a0, b0), last = chain[0], chain[-1]
        for a1, b1 in chain:
            if b1 - b0 >= PIECE_WORDS or (a1, b1) == last:
                found.append((a0, a1 + SEED_WORDS, b0, b1 + SEED_WORDS))
                a0, b0 = a1, b1
    return sorted(found, key=lambda p: (p[2], p[0]))


def regions(pieces: list[tuple[int, int, int, int]]) -> list[list]:
    """Pieces in groups that lie close together in both documents: [start_a, end_a,
    start_b, end_b, pieces] of bounded length, so that a region's words travel once."""
    done, open_ = [], []
    for a0, a1, b0, b1 in pieces:
        done += [g for g in open_ if b0 - g[3] > 2 * REACH]
        open_ = [g for g in open_ if b0 - g[3] <= 2 * REACH]
        for g in open_:
            lo, hi, end = min(g[0], a0), max(g[1], a1), max(g[3], b1)
            if a0 - g[1] <= 2 * REACH and g[0] - a1 <= 2 * REACH and max(hi - lo, end - g[2]) <= REGION_WORDS:
                g[0], g[1], g[3] = lo, hi, end
                g[4].append((a0, a1, b0, b1))
                break
        else:
            open_.append([a0, a1, b0, b1, [(a0, a1, b0, b1)]])
    return done + open_


def chained(matches: DataFrame) -> DataFrame:
    """(a, b, k, start_a, end_a, start_b, end_b, pieces) of the regions of each pair, in words."""
    schema = "a bigint, b bigint, k int, start_a int, end_a int, start_b int, end_b int, pieces binary"
    types = arrow_types(matches.sparkSession, schema)
    names = [c.split()[0] for c in schema.split(", ")]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """The sorted matches as arrays, cut between pairs of documents."""
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            now = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            other = np.flatnonzero((now[0] != now[0][-1:]) | (now[1] != now[1][-1:]))
            last = other[-1] + 1 if len(other) else 0
            if held and len(now[0]) and (held[-1][0][-1], held[-1][1][-1]) != (now[0][0], now[1][0]):
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            if last:
                held.append(tuple(x[:last] for x in now))
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            if len(now[0]) > last:
                held.append(tuple(x[last:] for x in now))
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for a, b, at_a, at_b in groups(batches):
                change = np.concatenate([[False], (np.diff(a) != 0) | (np.diff(b) != 0)])
                pair, x, y = promising(np.cumsum(change), at_a, at_b)
                firsts = np.flatnonzero(np.concatenate([[True], change[1:]]))  # rows of ``a`` and ``b``
                starts = np.flatnonzero(np.concatenate([[True], np.diff(pair) != 0])) if len(pair) else pair
                ends = np.append(starts[1:], len(pair))
                for lo, hi, row in zip(starts.tolist(), ends.tolist(), firsts[pair[starts]].tolist(), strict=False):
                    found = regions(pieces_of(list(zip(x[lo:hi].tolist(), y[lo:hi].tolist(), strict=True))))
                    for k, (a0, a1, b0, b1, pieces) in enumerate(found):
                        yield int(a[row]), int(b[row]), k, a0, a1, b0, b1, np.array(pieces, np.int32).tobytes()

        yield from to_batches(rows(), names, types, 256)

    dealt = matches.repartition("a", "b").sortWithinPartitions("a", "b", "at_b", "at_a")
    return dealt.select("a", "b", "at_a", "at_b").mapInArrow(run, schema)


def common_words(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """The most words that an alignment of x and y within a band of diagonals matches."""
    if not len(x) or not len(y):
        return 0
    if len(x) == len(y) and (x == y).all():
        return len(x)
    # What both begin and end with is common in the best alignment; it leaves the diagonals as they are.
    n = min(len(x), len(y))
    differ = x[:n] != y[:n]
    begin = int(differ.argmax()) if differ.any() else n
    x, y, n = x[begin:], y[begin:], n - begin
    differ = x[len(x) - n :][::-1] != y[len(y) - n :][::-1]
    end = int(differ.argmax()) if differ.any() else n
    x, y = x[: len(x) - end], y[: len(y) - end]
    # Longest common subsequence, a bit vector over y for each word of x.
    places: dict[int, int] = {}
    for k, w in enumerate(y.tolist()):
        places[w] = places.get(w, 0) | (1 << k)
    full = (1 << len(y)) - 1
    row = full
    for i, w in enumerate(x.tolist()):
        seen = places.get(w, 0)
        lo, hi = max(0, i - band), min(len(y), i + band + 1)
        seen &= ((1 << max(hi, 0)) - 1) & ~((1 << lo) - 1)
        u = row & seen
        row = ((row + u) | (row - u)) & full
    return begin + end + len(y) - row.bit_count()


def like(x: np.ndarray, y: np.ndarray, band: int) -> bool:
    """Do x and y have IDENTITY of the longer one's words in common within the band?"""
    n, needed = min(len(x), len(y)), IDENTITY * max(len(x), len(y))
    if np.count_nonzero(x[:n] == y[:n]) >= needed:
        return True
    # Words that agree counted from both starts up to a place, and from both ends beyond it:
    # an alignment, so enough of them settle it.
    front = np.concatenate([[0], np.cumsum(x[:n] == y[:n])])
    back = np.concatenate([[0], np.cumsum(x[len(x) - n :][::-1] == y[len(y) - n :][::-1])])
    return bool((front + back[::-1]).max() >= needed) or common_words(x, y, band) >= needed


def extended(ends: list[tuple[np.ndarray, np.ndarray]], most: int, cost: int) -> np.ndarray:
    """Words of x and of y by which two passages go on, for each pair (x, y) of what follows
    them: the end of the alignment with the most common words, less ``cost`` for each word
    that is changed, inserted or left out; the last of equal ends without gaps."""
    out = np.zeros((len(ends), 2), np.int64)
    if not ends or not most:
        return out
    sizes = np.array([(min(len(x), most), min(len(y), most)) for x, y in ends])
    # Padded: what is beyond an end is like no word.
    xs, ys = np.full((len(ends), most), -1, np.int64), np.full((len(ends), most), -2, np.int64)
    for k, (x, y) in enumerate(ends):
        xs[k, : sizes[k, 0]], ys[k, : sizes[k, 1]] = x[:most], y[:most]
    place, n = np.arange(most), sizes.min(axis=1)
    same = xs == ys
    walk = np.where(same, 1, -cost).cumsum(axis=1)
    walk[place >= n[:, None]] = -(10**6)
    best = most - 1 - walk[:, ::-1].argmax(axis=1)
    at = np.where(walk[np.arange(len(ends)), best] >= 0, best + 1, 0)
    out[:] = at[:, None]
    # Words inserted or left out, at least one before each run of common words, pay only if
    # a run is longer than their cost: rows without such a run in common go no further.
    run = cost + 1
    some = np.flatnonzero((same.sum(axis=1) < n) & (n - at >= run))
    if len(some):
        grams = []
        for k, w in enumerate((xs[some], ys[some])):
            hashes = shingle_hashes(w.ravel().view(np.uint64), run)
            hashes = np.append(hashes, np.zeros(run - 1, np.uint64)).reshape(w.shape)[:, : most - run + 1]
            inside = (place[: most - run + 1] >= at[some, None]) & (place[run - 1 :] < sizes[some, k : k + 1])
            # The last bit says whose it is; what lies outside is like nothing.
            grams.append(np.where(inside, hashes & ~np.uint64(1) | np.uint64(k), np.uint64(3 * k)))
        both = np.sort(np.concatenate(grams, axis=1), axis=1)
        k = some[((both[:, 1:] ^ both[:, :-1]) == 1).any(axis=1)]
        if len(k):
            out[k] += _gapped(*(_moved(w[k], at[k], fill) for w, fill in ((xs, -1), (ys, -2))), cost)
    return out


def _moved(words: np.ndarray, by: np.ndarray, fill: int) -> np.ndarray:
    """Each row of ``words`` from its place ``by`` on, filled up."""
    at = np.arange(words.shape[1]) + by[:, None]
    return np.where(at < words.shape[1], np.take_along_axis(words, np.minimum(at, words.shape[1] - 1), 1), fill)


def _gapped(p: np.ndarray, q: np.ndarray, cost: int) -> np.ndarray:
    """The first of the best ends of alignments of the rows of p and q within BAND, for all
    rows at once. A line of the alignments' tables, with what the words of q up to a place
    cost added, is a prefix maximum of what comes from the line before. Padding is like no
    word, so no end beyond a row's words is the first of the best."""
    width, n = q.shape[1], len(p)
    p, q = (np.ascontiguousarray(w.T) for w in (p, q))
    paid = cost * np.arange(width + 1, dtype=np.int32)[:, None]
    line = np.full((width + 1, n), -(10**6), np.int32)
    line[: BAND + 1] = 0
    top, end = np.zeros(n, np.int32), np.zeros((n, 2), np.int64)
    for i in range(1, width + 1):
        lo, hi = max(0, i - BAND), min(width, i + BAND) + 1
        first = max(lo, 1)
        now = line[lo:hi] - cost
        pays = (p[i - 1] == q[first - 1 : hi - 1]) * np.int32(cost + 1)
        np.maximum(now[first - lo :], line[first - 1 : hi - 1] + pays, out=now[first - lo :])
        line[lo:hi] = np.maximum.accumulate(now, axis=0, out=now)
        now -= paid[lo:hi]
        score = now.max(axis=0)
        better = np.flatnonzero(score > top)
        if len(better):
            top[better] = score[better]
            end[better, 0], end[better, 1] = i, now[:, better].argmax(axis=0) + lo
    return end


def united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unions of ranges that overlap or touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def aligned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, other, start, end, char_start, char_end) of chains that stand the alignment, united per region."""
    found = checkpointed(found)
    columns = ["a", "b", "k", "side", "start", "end", "pieces"]
    sides = [
        found.select(
            F.col(doc).alias("doc_id"),
            *["a", "b", "k"],
            F.lit(k).alias("side"),
            F.col(f"start_{doc}").alias("start"),
            F.col(f"end_{doc}").alias("end"),
            (F.col("pieces") if k else F.lit(None).cast("binary")).alias("pieces"),
        )
        for k, doc in enumerate("ab")
    ]
    ranges = sides[0].union(sides[1])
    sizes = checkpointed(ranges.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    # Ranges travel to their document in lists of about RANGES, so that the text of a
    # document with many partners isn't repeated for each.
    part = F.pmod(F.xxhash64("a", "b", "k"), F.ceil(F.col("n") / RANGES))
    lists = (
        attach(ranges, sizes, "doc_id", "n", total)
        .groupBy("doc_id", part.alias("part"))
        .agg(F.collect_list(F.struct(*columns)).alias("ranges"))
    )
    wanted = docs.join(lists.hint("shuffle_hash"), "doc_id").select("text", "ranges")
    schema = (
        "a bigint, b bigint, k int, side int, words binary, before int, "
        "pieces binary, char_start int, chars binary"
    )
    types = arrow_types(docs.sparkSession, schema)
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row in rows_of(batches):
                words, places = word_hashes(row["text"]).astype(np.uint32), None
                for r in row["ranges"]:
                    lo, hi = max(0, r["start"] - REACH), min(len(words), r["end"] + REACH)
                    at, chars = None, None
                    if r["side"]:
                        if places is None:
                            points = row["text"].encode("utf-32-le", "surrogatepass")
                            places = word_bounds(np.frombuffer(points, np.uint32))
                        own = places[2 * lo : 2 * hi]
                        if len(own):  # the steps from each word's start to its end and on
                            at, chars = int(own[0]), steps(np.diff(own))
                    chain = (r[c] for c in ("a", "b", "k", "side"))
                    yield *chain, words[lo:hi].tobytes(), lo, r["pieces"], at, chars

        yield from to_batches(rows(), names, types, 256)

    def align(groups: list[tuple[tuple, list[dict]]]) -> Iterator[tuple]:
        regions, todo = [], []
        for key, rows in groups:
            sides = {r["side"]: r for r in reversed(rows)}
            x, y = (np.frombuffer(sides[k]["words"], np.uint32) for k in (0, 1))
            x_at, y_at = (sides[k]["before"] for k in (0, 1))
            if sides[1]["chars"] is None:
                continue
            found: list[tuple[int, int]] = []
            regions.append((key, sides[1], y_at, found))
            for a0, a1, b0, b1 in np.frombuffer(sides[1]["pieces"], np.int32).reshape(-1, 4).tolist():
                x0, x1, y0, y1 = a0 - x_at, a1 - x_at, b0 - y_at, b1 - y_at
                if x1 <= len(x) and y1 <= len(y):  # else a range of another text with that id
                    todo.append((x, y, x0, x1, y0, y1, found))
        # Ends as far as more words are common than not; if that is too much for the
        # whole chain, as far as the ends hold IDENTITY themselves.
        for cost in END_COSTS:
            lefts = extended([(x[:x0][::-1], y[:y0][::-1]) for x, y, x0, _, y0, _, _ in todo], REACH, cost)
            rights = extended([(x[x1:], y[y1:]) for x, y, _, x1, _, y1, _ in todo], REACH, cost)
            again = []
            for piece, left, right in zip(todo, lefts.tolist(), rights.tolist(), strict=True):
                x, y, x0, x1, y0, y1, found = piece
                u0, u1, v0, v1 = x0 - left[0], x1 + right[0], y0 - left[1], y1 + right[1]
                n, m = v1 - v0, u1 - u0
                if n < MIN_CHAIN:
                    continue
                if like(x[u0:u1], y[v0:v1], abs(m - n) + MAX_GAP):
                    found.append((v0, v1))
                else:
                    again.append(piece)
            todo = again
        for key, side, y_at, found in regions:
            if found:
                chars = side["char_start"] + np.concatenate([[0], np.cumsum(unpacked(side["chars"]))])
            for v0, v1 in united(found):
                yield key[1], key[0], v0 + y_at, v1 + y_at, int(chars[2 * v0]), int(chars[2 * v1 - 1])

    return map_group_lists(
        wanted.mapInArrow(cut, schema),
        ["a", "b", "k"],
        ["side", "words"],
        align,
        "doc_id bigint, other bigint, start int, end int, char_start int, char_end int",
        REGIONS,
    )


def steps(gaps: np.ndarray) -> bytes:
    """Gaps as bytes of 8 bits each, or 32 if one is too large; the first byte says which."""
    small = not len(gaps) or gaps.max() < 256
    return (b"\1" if small else b"\4") + gaps.astype(np.uint8 if small else np.uint32).tobytes()


def unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed[1:], np.uint8 if packed[0] == 1 else np.uint32).astype(np.int64)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start_word, end_word, start, end, n_words, others) of passages seen elsewhere before."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("doc_id is not null and text is not null")
    found = aligned(texts, chained(star_matches(seeds(texts))))

    def unite(key: tuple, rows: list[dict]) -> Iterator[tuple]:
        """Unions of ranges that overlap or touch."""
        start = end = c0 = c1 = -1
        others: set[int] = set()
        for r in [*rows, None]:
            if r is None or r["start"] > end:
                if end - start >= min_words:
                    yield key[0], start, end, c0, c1, end - start, sorted(others)
                if r is None:
                    return
                start, end, c0, c1, others = r["start"], r["end"], r["char_start"], r["char_end"], set()
            others.add(r["other"])
            if r["end"] > end:
                end, c1 = r["end"], r["char_end"]

    schema = (
        "doc_id bigint, start_word int, end_word int, start int, end int, n_words int, others array<bigint>"
    )
    return map_groups(found, ["doc_id"], ["start", "end", "other"], unite, schema)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
