"""Phrase collocations: contiguous phrases counted in double-array tries (operator 13).

Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words ``[^\\x20\\x09]+``,
with A-Z in lower case; everything is counted per language. Phrases of 2 to LONGEST words
that occur LEAST times or more are found from one pass over the whole texts, which numbers
the words of each slice of text, and five passes over these numbers (``encoded``):

1. Words are counted by a hash of LOW_BITS bits and those of its range, which can only count
   too much: a slice sends sorted arrays of hashes and counts, cut into ranges that are
   merged one by one. Hashes that reach LEAST are marked in a bitmap of fixed size.
2. Pairs of neighbours that are both marked are counted likewise.
3. So are runs of 3 to LONGEST words whose pairs are all marked. A phrase can't occur more
   often than a part of it, so no frequent one is missed (Apriori); a wrong mark only lets
   another run through.
4. Candidates are the words and runs whose hashes reached LEAST, and whose parts did; a
   pass collects their names.
5. They are laid out as double-array tries of about SHARD phrases at most and broadcast.
   Languages and first words are advanced once for each word of a slice; then numpy
   advances the states of all positions where a phrase goes on at once, one word deeper per
   level, and bincounts the states that accept; the counts of all slices are summed. All
   counts of the result are those of the tries, exact whatever the hashes did.

A slice numbers its words by a hash and compares all of them with the bytes of the word of
their number; if some differ, it numbers its words by their bytes.

Phrases of one word and more are then joined with the counts of their parts for the
scores, and with the longer phrases that contain them.

Memory: a task holds a slice of about SLICE_BYTES (one text cut at its separators), a bitmap
and a trie with one counter per phrase, or one range of hashes, whose number grows with the
texts. The driver holds one bitmap (BITMAP bits) or the packed bytes of one trie at a time;
neither grows with the input. More than SHARD candidates are counted in several passes over
the numbers; phrases that begin with the same word are in the same trie, so that a place is
followed in one of them. Beyond that, bitmaps fill up with the number of frequent words:
they then prune less, and more is shuffled and tried, but nothing is lost.

Two candidates with the same 64-bit hash within one task would be taken for one in pass
4, at a chance of about candidates^2 / 2^65.

Arithmetic: 1000 * a * n and l * r are decimals of 38 digits, divided whole.

Defined cases: a null text is empty; a null lang is ``und``; rows that repeat a document
count again; ties go by score, count and phrase in byte order; no words or no frequent
phrase give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, table, worker_state
from quarry.llm.shingles import hashes_between, mixed, word_bounds

LEAST = 100
LONGEST = 5
TOP = 2000
PERCENT = 100  # of a phrase's occurrences in a longer one, for it to be dropped
UNKNOWN_LANG = "und"
SLICE = 1 << 21  # positions of a task, a quarter of those of a range
SLICE_BYTES = 1 << 23  # of text that a task works on at once
COMPARED = 1 << 14  # words compared with others at once
SHARD = 500_000  # phrases of one trie
SHARE = 8  # one first word's phrases stay together up to this part of a shard
BITMAP = 1 << 27  # bits
BLOCK = 32768  # bits of one row of a bitmap
LOW_BITS = 24  # of the hashes of one range
RANGES = 256  # of the hashes that runs are counted by, at least; more for more text
COUNTERS = 4096  # of a trie in one row
FEW_LANGS = 1000  # languages whose totals are broadcast

_STOP = b"."
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
#: Separators of pieces to one of them, tabs to spaces, A-Z to lower case.
FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else _STOP[0] if b in _BREAKS else 0x20 if b == 9 else b for b in range(256)
)
#: Bytes of text that are split at once, if a piece ends there.
PART = 1 << 22


def parts_of(text: str | None) -> Iterator[bytes]:
    """The bytes of a text, folded, with _STOP at the end; a long text part by part."""
    data = (text or "").encode("utf-8", "replace").translate(FOLD)
    at = 0
    while at < len(data):
        end = data.find(_STOP, at + PART)
        end = len(data) if end < 0 else end
        yield data[at:end] + _STOP
        at = end


def words_in(part: bytes) -> list[bytes]:
    """The words of a part in order, with _STOP after each piece."""
    # Only spaces are left as white space; the split leaves other bytes alone.
    return [w for w in part.replace(_STOP, b" . ").split(b" ") if w]


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, with _STOP after each piece; a long text part by part."""
    return map(words_in, parts_of(text))


# ------------------------------------------------------------------ slices of text
def texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG))
    return docs.select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"))


def slices(
    batches: Iterator[pa.RecordBatch], size: int
) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, list[str]]]:
    """(parts of texts, end of each part, number of its language, languages), ``size`` bytes or more at once."""
    parts, langs, names, held = [], [], {}, 0

    def joined() -> tuple[bytes, np.ndarray, np.ndarray, list[str]]:
        return b"".join(parts), np.cumsum([len(p) for p in parts]), np.array(langs, np.int32), list(names)

    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            for part in parts_of(text.as_py()):
                parts.append(part)
                langs.append(names.setdefault(lang.as_py(), len(names)))
                held += len(part)
                if held >= size:
                    yield joined()
                    parts, langs, names, held = [], [], {}, 0
    if held:
        yield joined()


def lang_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(b"lang " + lang.encode())


def followed(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit hashes of what ``key`` are the hashes of, followed by ``word``."""
    return mixed(key * np.uint64(0x9E3779B97F4A7C15) + word)


def alike(data: bytes, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> bool:
    """Whether each word of ``data`` has the bytes of word ``other``."""
    chars, size, shift = np.frombuffer(data, np.uint8), ends - starts, starts[other] - starts
    if (size != size[other]).any():
        return False
    for lo in range(0, len(starts), COMPARED):
        here = slice(lo, lo + COMPARED)
        first, last = int(starts[here][0]), int(ends[here][-1])
        at = np.arange(first, last) + np.repeat(shift[here], np.diff(np.append(starts[here], last)))
        own = chars[first:last]
        # Separators are counted with the word before them, but not compared.
        if ((chars.take(at, mode="clip") != own) & (own != 0x20) & (own != 0x0A)).any():
            return False
    return True


def numbered(data: bytes, starts: np.ndarray, ends: np.ndarray, lang: np.ndarray, key: np.ndarray):
    """(number of each word's language and bytes, from 0 by falling frequency; a place of each number)."""
    # The upper bits of the hashes, sorted with the words' places below them.
    low = np.uint64(len(key).bit_length())
    order = (key >> low << low) | np.arange(len(key), dtype=np.uint64)
    order.sort()
    new = np.append(True, (order[1:] ^ order[:-1]) >> low != 0)
    order = (order & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    one, group = order[new], np.empty(len(key), np.int32)
    group[order] = np.cumsum(new) - 1
    if (lang[one[group]] != lang).any() or not alike(data, starts, ends, one[group]):
        # Some words share these bits: each is looked up by its bytes.
        words = [w for w in words_in(data.replace(b"\n", _STOP)) if w != _STOP]
        known: dict[tuple[int, bytes], int] = {}
        pairs = zip(lang.tolist(), words, strict=True)
        group = np.fromiter((known.setdefault(p, len(known)) for p in pairs), np.int32, len(key))
        one = np.unique(group, return_index=True)[1]
    by = np.argsort(-np.bincount(group), kind="stable")
    rank = np.empty(len(by), np.int32)
    rank[by] = np.arange(len(by))
    return rank[group], one[by]


ENCODED = (
    "words long, distinct long, spelled long, codes binary, names binary, keys binary, f binary, lang binary, langs array<string>"
)
_COLUMNS = [column.split()[0] for column in ENCODED.split(", ")]
_ZSTD = pa.Codec("zstd", compression_level=1)


def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per slice of text, whose words are numbered from 1 by their language and bytes.

    ``codes``: the words' numbers in order, with 0 after each piece, so that no phrase spans
    two of them; ``names``, ``keys``, ``f``, ``lang``: each number's bytes (joined with line
    feeds), 64-bit hash with the language, occurrences and place in ``langs``. ``words``,
    ``distinct`` and ``spelled`` are how many codes, numbers and bytes of names there are.
    """
    for data, ends_of, langs, names in slices(batches, SLICE_BYTES):
        data = data.replace(_STOP, b"\n")
        chars = np.frombuffer(data, np.uint8)
        bounds = word_bounds(chars)
        starts, ends = bounds[::2], bounds[1::2]
        if not len(starts):
            continue
        lang = langs[np.searchsorted(ends_of, starts, side="right")]
        seeds = np.array([lang_seed(name) for name in names], np.uint64)
        key = followed(seeds[lang], hashes_between(data, starts, ends))
        number, one = numbered(data, starts, ends, lang, key)
        spelled = b"\n".join([data[i:j] for i, j in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
        # Words before which a piece ends, and the end.
        stop = np.zeros(len(starts) + 1, bool)
        stop[np.searchsorted(starts, np.flatnonzero(chars == 0x0A))] = True
        codes = np.zeros(len(starts) + int(stop.sum()), np.int32)
        codes[np.arange(len(starts)) + np.cumsum(stop[:-1])] = number + 1
        blobs = [
            squeezed(codes),
            _ZSTD.compress(spelled, asbytes=True),
            key[one].tobytes(),
            squeezed(np.bincount(number).astype(np.int32)),
            squeezed(lang[one]),
        ]
        sizes = [pa.array([n]) for n in (len(codes), len(one), len(spelled))]
        columns = [*sizes, *(pa.array([b], pa.binary()) for b in blobs), pa.array([names], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, names=_COLUMNS)


def squeezed(values: np.ndarray) -> bytes:
    """32-bit values, compressed: all their first bytes, then all their second bytes, ..."""
    return _ZSTD.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 4).T), asbytes=True)


def unsqueezed(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_ZSTD.decompress(blob, n * 4), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view(np.int32).ravel()


def codes_of(row: dict) -> np.ndarray:
    return unsqueezed(row["codes"], row["words"])


def among(key: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of ``key`` are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(key), bool)
    return known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key


def names_of(row: dict, which: np.ndarray) -> list[bytes]:
    """The bytes of the numbers ``which``, from 0."""
    names = _ZSTD.decompress(row["names"], row["spelled"], asbytes=True)
    ends = np.append(np.flatnonzero(np.frombuffer(names, np.uint8) == 0x0A), len(names))
    starts = np.append(0, ends[:-1] + 1)
    return [names[i:j] for i, j in zip(starts[which].tolist(), ends[which].tolist(), strict=True)]


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Encoded slices, one in memory as Python objects at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


# ------------------------------------------------------------------ bitmaps
def marked(keys: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap_of(rows: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of column ``key``: made on the executors, at most bits / BLOCK rows collected."""
    bit = F.col("key").bitwiseAND(F.lit(bits - 1))
    block, place = F.floor(bit / BLOCK).alias("block"), (bit % BLOCK).alias("place")  # whole below 2^53
    blocks = rows.select(block, place).groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in blocks.collect():
        at = row["block"] * (BLOCK // 8)
        out[at : at + BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


# ------------------------------------------------------------------ candidates
def runs(
    codes: np.ndarray, keys: np.ndarray, bits: np.ndarray, known: int, longest: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, keys) of the runs of 2 to ``longest`` words of one piece: those of up to
    ``known`` words that are marked, as their parts are; longer ones whose parts of ``known``
    words are all marked. ``keys``: of the codes 1 and up. A 0 ends ``codes``."""
    keys = np.append(np.uint64(0), keys)
    ok = np.append(False, marked(keys[1:], bits))[codes]
    at = np.flatnonzero(ok)
    key = keys[codes[at]]
    for k in range(2, longest + 1):
        # The part that begins as much later as to end the run; it lies inside the piece.
        on = ok[at + (k - min(k - 1, known))]
        at = at[on]
        key = followed(key[on], keys[codes[at + (k - 1)]])
        if k <= known:
            hit = marked(key, bits)
            at, key = at[hit], key[hit]
            ok = np.zeros(len(codes), bool)
            ok[at] = True
        yield k, at, key


def often_keys(encoded: DataFrame, bitmap, known: int, longest: int, least: int, ranges: int) -> DataFrame:
    """(key) of the runs of ``known`` + 1 to ``longest`` words (of the words if ``known`` is 0)
    whose hash, cut to the bits of a range and LOW_BITS, is met ``least`` times or more.

    Slices send one row per range of hashes: the hashes' lower bits, byte by byte, and the
    counts. A range is merged by one task.
    """
    low_bits = np.uint64(LOW_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_in(batches):
            key = np.frombuffer(row["keys"], np.uint64)
            if known:
                found = runs(codes_of(row), key, bitmap.value, known, longest)
                key = np.concatenate([key for k, _, key in found if k > known])
            key = key & np.uint64((ranges << LOW_BITS) - 1)
            if not len(key):
                continue
            if known:
                key, f = np.unique(key, return_counts=True)
            else:
                order = np.argsort(key)
                key, f = key[order], unsqueezed(row["f"], row["distinct"])[order]
            # Counts of more than a byte holds are sent in parts.
            parts = (f - 1) // 255 + 1
            key, part = np.repeat(key, parts), np.full(int(parts.sum()), 255, np.uint8)
            part[np.cumsum(parts) - 1] = (f - 1) % 255 + 1
            which = (key >> low_bits).astype(np.int32)
            cuts = np.flatnonzero(np.diff(which, prepend=-1))
            low = np.ascontiguousarray(key.astype(np.uint32).view(np.uint8).reshape(-1, 4).T[:3])
            ends = np.append(cuts[1:], len(key))
            columns = [
                pa.array(which[cuts]),
                pa.array([low[:, i:j].tobytes() for i, j in zip(cuts, ends, strict=True)], pa.binary()),
                pa.array([part[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "low", "f"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for which, group in grouped(batches):
            # Sorted with their counts in the lowest byte.
            low = np.concatenate([np.frombuffer(f + x, np.uint8).reshape(4, -1) for x, f in group], axis=1)
            low = np.ascontiguousarray(low.T).view(np.uint32).ravel()
            low.sort()
            f, low = (low & np.uint32(255)).astype(np.int64), low >> np.uint32(8)
            first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
            often = first[np.add.reduceat(f, first) >= least]
            key = (np.uint64(which) << low_bits) + low[often].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64))], names=["key"])

    columns = ["words", "codes", "keys"] if known else ["distinct", "keys", "f"]
    dealt = encoded.select(columns).mapInArrow(count, "range int, low binary, f binary").repartition("range")
    return dealt.sortWithinPartitions("range").mapInArrow(merge, "key long")


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows of equal first column, one group at a time, from sorted batches."""
    now, held = None, []
    for batch in batches:
        for first, *others in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and first != now:
                yield now, held
                held = []
            now = first
            held.append(tuple(others))
    if held:
        yield now, held


def named(encoded: DataFrame, bitmap, longest: int, ranges: int) -> DataFrame:
    """(lang, phrase) of the runs of 1 to ``longest`` words that are marked, as all their parts
    are, and for each language the phrase of no words.

    Tasks send each phrase once (or once per many), in lists by range of its hash and language.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages: dict[str, int] = {}
        seen, phrases, places = np.array([], np.uint64), [], []

        def flush() -> Iterator[pa.RecordBatch]:
            """A list of phrases for each place: number of the language * ranges + range."""
            phrases.extend([b""] * len(languages))
            where = np.concatenate([*places, np.arange(len(languages)) * ranges])
            order = np.argsort(where, kind="stable")
            where, spelled, langs = where[order], [phrases[i] for i in order.tolist()], list(languages)
            cuts = np.flatnonzero(np.diff(where, prepend=-1)).tolist()
            lists = [b"\n".join(spelled[i:j]) for i, j in zip(cuts, [*cuts[1:], len(where)], strict=True)]
            of, which = np.divmod(where[cuts], ranges)
            columns = [pa.array(which, pa.int32()), pa.array([langs[i] for i in of], pa.string()), pa.array(lists, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "lang", "phrases"])

        for row in rows_in(batches):
            codes, keys = codes_of(row), np.frombuffer(row["keys"], np.uint64)
            number = np.array([languages.setdefault(name, len(languages)) for name in row["langs"]])
            lang = number[unsqueezed(row["lang"], row["distinct"])]
            alone = np.flatnonzero(marked(keys, bitmap.value))
            words, place = names_of(row, alone), np.zeros(len(keys), np.int64)
            place[alone] = np.arange(len(alone))
            # A place of each phrase of the slice.
            found = [(keys[alone], [alone])]
            for k, at, key in runs(codes, keys, bitmap.value, longest, longest):
                order = np.argsort(key)
                order = order[np.append(True, np.diff(key[order]) != 0)[: len(order)]]
                found.append((key[order], [codes[at[order] + j] - 1 for j in range(k)]))
            added = []
            for key, parts in found:
                new = np.flatnonzero(~among(key, seen))
                columns = [[words[i] for i in place[part[new]].tolist()] for part in parts]
                phrases.extend(map(b" ".join, zip(*columns, strict=True)))
                places.append(lang[parts[0][new]] * ranges + (key[new] % np.uint64(ranges)).astype(np.int64))
                added.append(key[new])
            seen = np.sort(np.concatenate([seen, *added]))
            if len(seen) > SLICE // 4:
                yield from flush()
                seen, phrases, places = seen[:0], [], []
        if languages:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in grouped(batches):
            found: dict[str, set[bytes]] = {}
            for lang, phrases in group:
                found.setdefault(lang, set()).update(phrases.split(b"\n"))
            for lang, phrases in found.items():
                names = pa.array([p.decode() for p in sorted(phrases)], pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names], names=["lang", "phrase"])

    columns = encoded.drop("f")
    dealt = columns.mapInArrow(name, "range int, lang string, phrases binary").repartition("range")
    return dealt.sortWithinPartitions("range").mapInArrow(merge, "lang string, phrase string")


# ------------------------------------------------------------------ tries
class DoubleArray:
    """A trie of distinct sequences of codes (1 and up): state t = base[s] + c follows s by
    c if check[t] is s. ``accepts[s]`` is the number of the sequence that ends at s, or -1.

    ``sequences``: a row per sequence, 0 behind its end.
    """

    def __init__(self, sequences: np.ndarray):
        n, depth = sequences.shape
        order = np.lexsort(sequences.T[::-1]) if depth else np.arange(n)
        rows = sequences[order]
        codes = int(rows.max(initial=0)) + 1
        self.base = np.zeros(codes, np.int32)
        self.check = np.full(codes, -1, np.int32)
        self.accepts = np.full(codes, -1, np.int32)
        self.codes, self.free = codes, np.ones(codes, bool)
        self.free[0] = False  # the root
        self.low, self.top = 1, 0  # the first free place and the last taken one
        self.random = np.random.default_rng(13)
        at, states = np.arange(n), np.zeros(n, np.int32)  # sequences that go on, and where they are
        for d in range(depth + 1):
            code = rows[at, d] if d < depth else np.zeros(len(at), np.int32)
            ends = code == 0
            self.accepts[states[ends]] = order[at[ends]]
            at, states, code = at[~ends], states[~ends], code[~ends]
            if not len(at):
                break
            # Children lie side by side, as the sequences are sorted.
            new = np.append(True, (np.diff(states) != 0) | (np.diff(code) != 0))
            parent, child = states[new], code[new]
            first = np.flatnonzero(np.append(True, np.diff(parent) != 0))
            width = np.diff(np.append(first, len(parent)))
            placed = np.empty(len(parent), np.int32)
            # Wide nodes first: what is left between their children fits narrow ones.
            for i in np.argsort(-width, kind="stable")[: int((width > 1).sum())].tolist():
                part = slice(first[i], first[i] + width[i])
                placed[part] = self._place(int(parent[first[i]]), child[part])
            single = first[width == 1]
            placed[single] = self._place_single(parent[single], child[single])
            states = placed[np.cumsum(new) - 1]
        used = int(np.flatnonzero(self.check >= 0).max(initial=0)) + 1
        # Any state and code can be looked up without a test of the bounds.
        pad = max(0, int(self.base.max(initial=0)) + codes - used)
        self.base = self.base[:used]
        self.check = np.append(self.check[:used], np.full(pad, -1, np.int32))
        self.accepts = self.accepts[:used]
        del self.free, self.random

    def _grow(self, size: int) -> None:
        more = max(size - len(self.check), 0)
        if more:
            more = max(more, len(self.check) // 2)
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))
            self.accepts = np.append(self.accepts, np.full(more, -1, np.int32))
            self.free = np.append(self.free, np.ones(more, bool))

    def _place(self, state: int, codes: np.ndarray) -> np.ndarray:
        base = self._fit(codes)
        self._grow(base + int(codes[-1]) + 1)
        at = base + codes
        self.base[state], self.check[at], self.free[at] = base, state, False
        self.top = max(self.top, int(at[-1]))
        return at

    def _fit(self, codes: np.ndarray) -> int:
        """The first base among some free places whose children's places are free; behind
        everything if there is none among them."""
        start = max(int(codes[0]), self.low)
        places = np.flatnonzero(self.free[start : start + (1 << 12)])[:256] + start
        if start == self.low and len(places):
            self.low = int(places[0])
        # Others all over the array: what wide nodes have left free is far apart.
        others = self.random.integers(start, max(self.top, start) + 1, 1024)
        places = np.append(places, others[self.free[np.minimum(others, len(self.free) - 1)]])
        near = places - codes[0]
        near = near[near + codes[-1] < len(self.free)][: max(1, (1 << 20) // len(codes))]
        if len(near):
            fits = self.free[near[:, None] + codes[None, :]].all(axis=1)
            if fits.any():
                return int(near[fits.argmax()])
        return max(self.top + 1 - int(codes[0]), 0)

    def _place_single(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Nodes with one child, all at once: each takes the next free place."""
        self._grow(self.codes + len(states) + int((~self.free).sum()))
        # Behind the largest code, so that no base is below 0.
        at = self.codes + np.flatnonzero(self.free[self.codes :])[: len(states)]
        self.base[states], self.check[at], self.free[at] = at - codes, states, False
        self.top = max(self.top, int(at.max(initial=0)))
        return at

    def advance(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states that follow, and which of the given ones they follow."""
        to = self.base[states] + codes
        alive = np.flatnonzero((self.check[to] == states) & (codes > 0))
        return to[alive], alive


class PhraseTrie:
    """Phrases of one shard: languages and words by code, and their double array."""

    def __init__(self, langs: list[str], phrases: list[str]):
        self.langs = {lang: k for k, lang in enumerate(sorted(set(langs)), 1)}
        sizes = np.array([p.count(" ") + 1 if p else 0 for p in phrases], np.int64)
        known: dict[str, int] = {}
        flat = np.fromiter((known.setdefault(w, len(known)) for p in phrases if p for w in p.split(" ")), np.int32)
        # Frequent words have small codes, so that wide nodes are dense.
        code = np.empty(len(known), np.int32)
        code[np.argsort(-np.bincount(flat, minlength=len(known)), kind="stable")] = np.arange(len(known))
        code += len(self.langs) + 1
        self.codes = {w.encode(): int(code[k]) for w, k in known.items()}
        self.n, self.longest = len(phrases), int(sizes.max(initial=0))
        sequences = np.zeros((self.n, 1 + self.longest), np.int32)
        sequences[:, 0] = [self.langs[lang] for lang in langs]
        row = np.repeat(np.arange(self.n), sizes)
        sequences[row, 1 + np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = code[flat]
        self.trie = DoubleArray(sequences)

    def count(self, batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> np.ndarray:
        """How often each phrase occurs in encoded slices; that of no words as often as its
        language has words. Words that are in phrases are marked in ``bits``."""
        trie, states_n = self.trie, len(self.trie.accepts)
        counts = np.zeros(states_n, np.int64)
        inner = np.zeros(states_n, bool)  # states that others follow
        inner[trie.check[trie.check >= 0]] = True
        for row in rows_in(batches):
            # Languages and first words are advanced once for all occurrences of a word.
            f = unsqueezed(row["f"], row["distinct"])
            lang = np.array([self.langs.get(name, 0) for name in row["langs"]], np.int32)
            lang = lang[unsqueezed(row["lang"], row["distinct"])]
            states, at = trie.advance(np.zeros(len(lang), np.int32), lang)
            counts += np.bincount(states, f[at], states_n).astype(np.int64)  # whole below 2^53
            # Words of candidates are marked.
            alone = np.flatnonzero(marked(np.frombuffer(row["keys"], np.uint64), bits))
            code = np.zeros(len(lang) + 1, np.int32)
            code[1 + alone] = [self.codes.get(w, 0) for w in names_of(row, alone)]
            states, alive = trie.advance(states, code[1 + at])
            at = at[alive]
            counts[states] += f[at]  # no state twice
            first = np.zeros(len(code), np.int32)
            first[1 + at] = np.where(inner[states], states, 0)  # the root is no word's state
            codes = codes_of(row)
            states = first[codes]
            at = np.flatnonzero(states)
            states, met = states[at], []
            while len(at):
                # The words of a run lie inside a piece, which a 0 ends.
                at = at + 1
                states, alive = trie.advance(states, code[codes[at]])
                met.append(states)
                on = inner[states]
                at, states = at[alive[on]], states[on]
            if met:
                counts += np.bincount(np.concatenate(met), minlength=states_n)
        out = np.zeros(self.n, np.int64)
        accepting = trie.accepts >= 0
        out[trie.accepts[accepting]] = counts[accepting]
        return out


def packed(value: object) -> bytes:
    """Pickled and compressed, behind its size."""
    data = pickle.dumps(value)
    return len(data).to_bytes(8) + _ZSTD.compress(data, asbytes=True)


def unpacked(blob: bytes) -> object:
    return pickle.loads(_ZSTD.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8])))


def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the packed trie of all phrases (lang, phrase), and the phrases in its order."""
    langs, phrases = [], []
    for batch in batches:
        langs += batch.column("lang").to_pylist()
        phrases += batch.column("phrase").to_pylist()
    if phrases:
        blobs = [packed(PhraseTrie(langs, phrases)), packed((langs, phrases))]
        yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in blobs], names=["trie", "names"])


def sharded(candidates: DataFrame, shards: int, shard: int) -> DataFrame:
    """``candidates`` (lang, phrase) with the number of their shard.

    Phrases that begin with the same word share one, so that a place of the texts is
    followed in one trie; if there are very many of them, they are dealt over all.
    """
    first = F.substring_index("phrase", " ", 1)
    candidates = candidates.withColumn("first", first)
    many = candidates.groupBy("lang", "first").count().filter(F.col("count") > shard // SHARE).drop("count")
    dealt = candidates.join(F.broadcast(many.withColumn("many", F.lit(True))), ["lang", "first"], "left")
    by = F.when(F.col("many"), F.col("phrase")).otherwise(F.col("first"))
    return dealt.select("lang", "phrase", F.pmod(F.xxhash64("lang", by), F.lit(shards)).alias("shard"))


def trie_counts(encoded: DataFrame, bitmap, candidates: DataFrame, shard: int) -> DataFrame:
    """(lang, phrase, f) of ``candidates`` (lang, phrase), a shard of them at a time.

    A shard's trie is built by one task, which is bounded by the shard, and broadcast; the
    driver only passes its bytes on.
    """
    spark, out = encoded.sparkSession, None
    shards = -(-candidates.count() // shard)
    if shards > 1:
        shards += 1 + shards // 4  # so that no shard gets much more than its share
        candidates = checkpointed(sharded(candidates, shards, shard))
    for k in range(shards):
        part = candidates.filter(F.col("shard") == k).drop("shard") if shards > 1 else candidates
        row = part.coalesce(1).mapInArrow(built, "trie binary, names binary").first()
        if row is None:
            continue
        trie, names = (spark.sparkContext.broadcast(bytes(blob)) for blob in row)
        del row

        def count(batches: Iterator[pa.RecordBatch], trie=trie, key=f"collocations {uuid4()}") -> Iterator[pa.RecordBatch]:
            f = worker_state(key, lambda: unpacked(trie.value)).count(batches, bitmap.value)
            blocks = [(at, f[at : at + COUNTERS]) for at in range(0, len(f), COUNTERS)]
            blocks = [(at, part.tobytes()) for at, part in blocks if part.any()]
            if blocks:
                columns = [pa.array([at for at, _ in blocks], pa.int64()), pa.array([b for _, b in blocks], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["first", "counts"])

        def add(batches: Iterator[pa.RecordBatch], names=names) -> Iterator[pa.RecordBatch]:
            langs, phrases = None, None
            for first, group in grouped(batches):
                if langs is None:
                    langs, phrases = unpacked(names.value)
                total = sum(np.frombuffer(counts, np.int64) for (counts,) in group)
                hit = np.flatnonzero(total)
                columns = [pa.array([of[first + i] for i in hit.tolist()], pa.string()) for of in (langs, phrases)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(total[hit])], names=["lang", "phrase", "f"])

        counted = encoded.mapInArrow(count, "first long, counts binary").repartition("first")
        found = counted.sortWithinPartitions("first").mapInArrow(add, "lang string, phrase string, f long")
        found = checkpointed(found)
        out = found if out is None else out.unionByName(found)
        trie.unpersist()
        names.unpersist()
    return out if out is not None else spark.createDataFrame([], "lang string, phrase string, f long")


# ------------------------------------------------------------------ scores
def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """``phrases`` (lang, phrase, a) with l, r, n and score of their lowest-scoring cut."""
    parts = phrases.select("lang", "phrase", F.col("a").alias("f")).unionByName(
        words.select("lang", F.col("word").alias("phrase"), "f")
    )
    w = F.split("phrase", " ")
    k = F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k")
    cuts = phrases.select("lang", "phrase", "a", k)
    cuts = cuts.withColumn("first", F.array_join(F.slice(w, F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("rest", F.array_join(F.slice(w, F.col("k") + 1, F.size(w) - F.col("k")), " "))
    cuts = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"])
    cuts = cuts.join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    # A hot language's rows stay where they are, unless there are very many languages.
    few = totals.limit(FEW_LANGS + 1).count() <= FEW_LANGS
    cuts = cuts.join(F.broadcast(totals) if few else totals, "lang")
    number = "cast(cast({} as decimal(20,0)) as decimal({},0))"
    over = f"{number.format('a * 1000', 19)} * {number.format('n', 19)}"
    under = f"{number.format('l', 19)} * {number.format('r', 19)}"
    score = F.expr(f"cast(({over}) div ({under}) as bigint)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score")


def contained(phrases: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase) of those inside a longer one that has ``percent`` of their occurrences."""
    w = F.split("phrase", " ")
    size = F.explode(F.sequence(F.lit(2), F.size(w) - 1)).alias("size")
    inner = phrases.filter(F.size(w) > 2).select("lang", "phrase", F.col("a").alias("longer"), size)
    at = F.explode(F.sequence(F.lit(1), F.size(w) - F.col("size") + 1)).alias("at")
    inner = inner.select("lang", "phrase", "longer", "size", at)
    part = F.array_join(F.slice(w, F.col("at"), F.col("size")), " ").alias("phrase")
    most = inner.select("lang", part, "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return most.join(phrases, ["lang", "phrase"]).filter(F.col("longer") * 100 >= F.col("a") * percent).select("lang", "phrase")


def frequent_phrases(
    docs: DataFrame, least: int, longest: int, shard: int, bits: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, phrase, a) of phrases, (lang, word, f) of frequent words, (lang, n) of all words."""
    spark = docs.sparkSession
    kept = checkpointed(docs.mapInArrow(encoded, ENCODED))
    # A range holds at most 4 * SLICE positions.
    size = kept.agg(F.sum("words")).first()[0] or 0
    ranges = RANGES
    while ranges * SLICE * 4 < size:
        ranges *= 2

    def mark(keys: DataFrame):
        return spark.sparkContext.broadcast(bitmap_of(keys, bits))

    often = checkpointed(often_keys(kept, None, 0, 1, least, ranges))
    often = often.unionByName(checkpointed(often_keys(kept, mark(often), 1, 2, least, ranges)))
    if longest > 2:
        often = often.unionByName(often_keys(kept, mark(often), 2, longest, least, ranges))
    bitmap = mark(often)
    candidates = checkpointed(named(kept, bitmap, longest, ranges))
    counted = checkpointed(trie_counts(kept, bitmap, candidates, shard).filter((F.col("f") >= least) | (F.col("phrase") == "")))
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    phrases = counted.filter(size > 1).select("lang", "phrase", F.col("f").alias("a"))
    words = counted.filter((size == 1) & (F.col("f") >= least)).select("lang", F.col("phrase").alias("word"), "f")
    return phrases, words, counted.filter(size == 0).select("lang", F.col("f").alias("n"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    percent: int = PERCENT,
    text_col: str = "text",
    lang_col: str = "lang",
    shard: int = SHARD,
    bits: int = BITMAP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    phrases, words, totals = frequent_phrases(texts(docs, text_col, lang_col), least, longest, shard, bits)
    kept = scored(phrases, words, totals).join(contained(phrases, percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with p as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p
), t as (
  select lang, sum(len(w))::bigint as n from w group by lang
), g as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from w, (select unnest(range(1, 6)) as k) where len(w) >= k)
), f as (
  select lang, k, phrase, count(*)::bigint as a from g group by all having count(*) >= 100
), c as (
  select f.lang, f.phrase, f.k, f.a, x.j, l.a as l, r.a as r, t.n,
         ((1000::hugeint * f.a * t.n) // (l.a::hugeint * r.a))::bigint as score
  from f join (select unnest(range(1, 5)) as j) x on x.j < f.k
  join f l on l.lang = f.lang and l.phrase = array_to_string(string_split(f.phrase, ' ')[1:x.j], ' ')
  join f r on r.lang = f.lang and r.phrase = array_to_string(string_split(f.phrase, ' ')[x.j + 1:], ' ')
  join t on t.lang = f.lang
  where f.k > 1
), s as (
  select * from c qualify row_number() over (partition by lang, phrase order by score, j) = 1
), kept as (
  select * from s where not exists (
    select 1 from f where f.lang = s.lang and f.k > s.k and 100 * f.a >= 100 * s.a
                      and contains(' ' || f.phrase || ' ', ' ' || s.phrase || ' '))
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""
