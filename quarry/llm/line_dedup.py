"""Near-duplicate lines by a segment-partition edit join (operator 5).

Lines are cut at ``\\n``. Two lines of at least MIN_CHARS code points are linked if
their edit distance is at most EDITS. A line is split into EDITS + 1 segments; at
least one of them stands unchanged in every line within EDITS edits, at a place that
the two lengths allow. Index keys are a line's own segments with its length and
their number; probe keys are its substrings that could be such a segment of a line
that is no longer than itself.

1. Equal lines form a class (128-bit digests); links refer to the first 64 bits.
2. (key, line) rows are range-partitioned by both, so that a frequent segment is
   spread over tasks, and rows whose key another line has too are kept.
3. The lines of a key meet with their texts. A key with many lines is cut into blocks;
   each pair of blocks is a task's group. Pairs are sifted by letter counts and checked
   with a banded bit-parallel edit distance. A pair is counted under its first common
   segment only. Counts and links that connect lines leave a group, never all pairs.
4. Components of the links. Of a component the line that comes first stays.
5. ``line_members`` names the class and the component of every occurrence of a line, and
   ``without_repeated_lines`` gives the texts with the occurrences that stay: one of each
   component. A text of which no line stays is empty; null texts stay null.

Defined cases: null texts have no lines, an empty text has one empty line; shorter
lines link with no other lines; rows that repeat an id are texts of their own; a null id
comes after all others; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import arrow_types, attach, checkpointed, connected_components, map_groups, stored, table

EDITS = 2
MIN_CHARS = 20
BLOCK = 256
LETTERS = 32  # buckets of letter counts


@lru_cache(maxsize=4096)
def segments(n: int, edits: int) -> list[tuple[int, int]]:
    """Start and length of the segments of a line of n characters, as even as possible."""
    parts = edits + 1
    short = n // parts
    longer = n - short * parts  # that many of the last segments have one character more
    out, at = [], 0
    for k in range(parts):
        size = short + (k >= parts - longer)
        out.append((at, size))
        at += size
    return out


@lru_cache(maxsize=4096)
def probes(n: int, edits: int, min_chars: int) -> list[tuple[int, int, list[int], int]]:
    """(length of the other line, segment, places, size): where a line of n characters
    may hold a segment of a line that is up to ``edits`` shorter."""
    out = []
    for other in range(max(min_chars, n - edits), n + 1):
        more = n - other
        for k, (at, size) in enumerate(segments(other, edits)):
            # Edits left of the segment are at most k, right of it at most edits - k.
            lo = max(at - k, at + more - (edits - k), 0)
            hi = min(at + k, at + more + (edits - k), n - size)
            if lo <= hi:
                out.append((other, k, list(range(lo, hi + 1)), size))
    return out


def seed_of(n: int, k: int) -> int:
    return n * 64 + k


def key_of(n: int, k: int, piece: str) -> int:
    return xxhash.xxh3_64_intdigest(piece, seed=seed_of(n, k))


@lru_cache(maxsize=4096)
def slices(n: int, edits: int, min_chars: int) -> list[tuple[int, int, int]]:
    """(seed, start, end) of every probe of a line of n characters."""
    return [
        (seed_of(other, k), at, at + size) for other, k, places, size in probes(n, edits, min_chars) for at in places
    ]


def line_keys(line: str, edits: int, min_chars: int) -> set[int]:
    """Probe keys of a line, its own index keys among them."""
    digest = xxhash.xxh3_64_intdigest
    return {digest(line[a:b], s) for s, a, b in slices(len(line), edits, min_chars)}


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``.

    After common ends are cut off, bit i of ``rows[e]`` says that i characters of a match
    the characters of b read so far with at most e edits; only bits within the band
    of ``edits`` diagonals on either side are kept.
    """
    if a == b:
        return True
    if abs(len(a) - len(b)) > edits:
        return False
    lo, least = 0, min(len(a), len(b))
    while lo < least and a[lo] == b[lo]:
        lo += 1
    end = 0
    while end < least - lo and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[lo : len(a) - end], b[lo : len(b) - end]
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    rows = [(1 << (e + 1)) - 1 for e in range(edits + 1)]
    band = (1 << (2 * edits + 1)) - 1
    full = (1 << (len(a) + 1)) - 1
    for j, c in enumerate(b, 1):
        same = places.get(c, 0)
        shift = j - edits
        mask = (band << shift if shift >= 0 else band >> -shift) & full
        before = rows[0]
        rows[0] = ((before & same) << 1) & mask
        for e in range(1, edits + 1):
            now = ((rows[e] & same) << 1) | before | (before << 1) | (rows[e - 1] << 1)
            before, rows[e] = rows[e], now & mask
        if not rows[edits]:
            return False
    return bool(rows[edits] >> len(a) & 1)


def line_hash(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line)


def short_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """doc_id, the columns after the text, and the lines of every row with a text."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for doc_id, text, *more in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                if text is not None:
                    yield doc_id, *more, text.split("\n")


def _batches(rows: Iterator[tuple], names: list[str], types: list, size: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def occurrences(texts: DataFrame) -> DataFrame:
    """(digest, doc_id, line, n_chars, copies) of every line of every text, and its row if texts have one."""
    row = [c for c in texts.columns if c == "row"]
    schema = "digest binary, doc_id bigint, line int, n_chars int, copies bigint" + ", row bigint" * len(row)
    types = arrow_types(texts.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for doc_id, *more, lines in _lines(batches):
                for k, line in enumerate(lines):
                    yield line_hash(line), doc_id, k, len(line), 1, *more

        yield from _batches(rows(), ["digest", "doc_id", "line", "n_chars", "copies", *row], types)

    return texts.mapInArrow(run, schema)


def line_classes(texts: DataFrame) -> DataFrame:
    """(digest, id, doc_id, line, n_chars, copies): distinct lines with their first occurrence,
    and its row if texts have one."""
    row = [c for c in texts.columns if c == "row"]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "line", *row)).alias("first")
    return (
        occurrences(texts)
        .groupBy("digest", "n_chars")
        .agg(first, F.sum("copies").alias("copies"))
        .select(
            "digest",
            F.conv(F.substring(F.hex("digest"), 1, 16), 16, -10).cast("bigint").alias("id"),
            F.col("first.doc_id").alias("doc_id"),
            F.col("first.line").alias("line"),
            *[F.col("first.row").alias(c) for c in row],
            "n_chars",
            "copies",
        )
    )


def shared_keys(texts: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(key, id) of lines that may share the key with another line.

    Rows at the ends of a partition are kept in any case, as their like may be in the next.
    """

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a line's copies in a task need no keys of their own
        made: list[int] = []
        ids: list[int] = []
        counts: list[int] = []

        def batch() -> pa.RecordBatch:
            key = np.array(made, np.uint64).view(np.int64)
            line = np.repeat(np.array(ids, np.int64), counts)
            for x in (made, ids, counts):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(line)], names=["key", "id"])

        for *_, lines in _lines(batches):
            for line in lines:
                if len(line) >= min_chars:
                    line_id = short_id(line_hash(line))
                    if line_id not in seen:
                        if len(seen) >= 1 << 17:
                            seen.clear()
                        seen.add(line_id)
                        own = line_keys(line, edits, min_chars)
                        made.extend(own)
                        ids.append(line_id)
                        counts.append(len(own))
            if len(made) >= 1 << 14:
                yield batch()
        yield batch()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of the key that is being read are judged when it is over.
        rest = (np.empty(0, np.int64), np.empty(0, np.int64))
        at_start = True

        def judged(key: np.ndarray, line: np.ndarray, first: bool, last: bool) -> pa.RecordBatch:
            cut = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(key)]])
            keep = line[starts] != line[ends - 1]  # sorted by line: more than one
            keep[0] |= first
            keep[-1] |= last
            wanted = np.repeat(keep, ends - starts)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
            wanted &= new
            return pa.RecordBatch.from_arrays([pa.array(key[wanted]), pa.array(line[wanted])], names=["key", "id"])

        for batch in batches:
            key, line = (
                np.concatenate([r, batch.column(c).to_numpy(zero_copy_only=False)]) for c, r in enumerate(rest)
            )
            if not len(key):
                continue
            done = int(np.searchsorted(key, key[-1]))
            if done:
                yield judged(key[:done], line[:done], at_start, False)
                at_start = False
            # Of the last key so far, distinct lines are enough.
            ids = np.unique(line[done:])
            rest = (np.full(len(ids), key[-1]), ids)
        if len(rest[0]):
            yield judged(*rest, at_start, True)

    found = texts.mapInArrow(keys, "key bigint, id bigint")
    dealt = found.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return dealt.mapInArrow(meet, "key bigint, id bigint").distinct()


def letter_counts(line: str) -> np.ndarray:
    return np.bincount(np.frombuffer(line.encode("utf-32-le"), np.uint32) % LETTERS, minlength=LETTERS).astype(np.int16)


def verified(texts: DataFrame, shared: DataFrame, edits: int, min_chars: int, block: int) -> DataFrame:
    """(a, b, n): links that connect lines, and numbers of links of a line (b null)."""
    sizes = checkpointed(
        shared.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    placed = attach(shared, sizes, "key", "n", total).select(
        "key", "id", "blocks", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int").alias("block")
    )
    keys_of = placed.groupBy("id").agg(F.collect_list(F.struct("key", "blocks", "block")).alias("keys"))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            seen: set[int] = set()
            for *_, found in _lines(batches):
                for line in found:
                    if len(line) >= min_chars:
                        line_id = short_id(line_hash(line))
                        if line_id not in seen:
                            if len(seen) >= 1 << 17:
                                seen.clear()
                            seen.add(line_id)
                            yield line_id, line

        yield from _batches(rows(), ["id", "text"], [pa.int64(), pa.string()], 2048)

    # Texts are the stream side; a line's keys are at most a few dozen.
    held = texts.mapInArrow(lines, "id bigint, text string").join(keys_of.hint("shuffle_hash"), "id")
    met = (
        held.select("id", "text", F.explode("keys").alias("k"))
        .select(
            F.col("k.key").alias("key"),
            F.col("k.block").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("k.blocks") - 1)).alias("other"),
            "id",
            "text",
        )
        .select(
            "key",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
            "block",
            "id",
            "text",
        )
    )

    def check(group: tuple, rows: list[dict]) -> Iterator[tuple]:
        rows = list({r["id"]: r for r in rows}.values())  # copies of a line met from several tasks
        key = group[0] % (1 << 64)
        which = next((w for r in rows for w in key_places(r["text"], key, edits, min_chars)), None)
        if which is None or len(rows) < 2:
            return
        n, k = which
        at, size = segments(n, edits)[k]
        holds = [len(r["text"]) == n and key_of(n, k, r["text"][at : at + size]) == key for r in rows]
        counts = np.stack([letter_counts(r["text"]) for r in rows])
        root, links = list(range(len(rows))), [0] * len(rows)

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for i in np.flatnonzero(holds).tolist():
            a = rows[i]
            near = np.abs(counts - counts[i]).sum(1) <= 2 * edits
            for j in np.flatnonzero(near).tolist():
                b = rows[j]
                if i == j or (group[1] != group[2] and a["block"] == b["block"]):
                    continue
                # The shorter line is the indexed one; of equal lengths that with the smaller id.
                if (len(a["text"]), a["id"]) > (len(b["text"]), b["id"]):
                    continue
                if first_common(a["text"], b["text"], edits, min_chars) != k or not within(a["text"], b["text"], edits):
                    continue
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                if x != y:
                    root[y] = x
                    yield a["id"], b["id"], 0
        for r, n_links in zip(rows, links, strict=True):
            if n_links:
                yield r["id"], None, n_links

    return map_groups(met, ["key", "low", "high"], ["id"], check, "a bigint, b bigint, n bigint")


def key_places(line: str, key: int, edits: int, min_chars: int) -> Iterator[tuple[int, int]]:
    """The length and segment that a key of a line stands for."""
    for other, k, places, size in probes(len(line), edits, min_chars):
        if any(key_of(other, k, line[at : at + size]) == key for at in places):
            yield other, k


def first_common(a: str, b: str, edits: int, min_chars: int) -> int:
    """The first segment of a that b holds at an allowed place; -1 if there is none."""
    own = segments(len(a), edits)
    for other, k, places, size in probes(len(b), edits, min_chars):
        if other == len(a):
            piece = a[own[k][0] : own[k][0] + size]
            if any(b[at : at + size] == piece for at in places):
                return k
    return -1


def near_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK
) -> DataFrame:
    """One row per distinct line: its first place (doc_id, line), n_chars, n_copies, n_links
    (other distinct lines linked directly), the first place of its component, and kept."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return near_classes(texts, edits, min_chars, block)


def near_classes(texts: DataFrame, edits: int, min_chars: int, block: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """``near_lines`` of (doc_id, text), with ``extra`` columns of ``line_classes``."""
    min_chars = max(min_chars, edits + 1)
    classes = checkpointed(line_classes(texts))
    found = checkpointed(verified(texts, checkpointed(shared_keys(texts, edits, min_chars)), edits, min_chars, block))
    groups = connected_components(found.filter("b is not null").select("a", "b"))
    counts = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links"))
    named = checkpointed(
        classes.drop(*{"digest"}.difference(extra)).join(groups.withColumnRenamed("node", "id"), "id", "left").join(counts, "id", "left")
    )
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "line")
    heads = checkpointed(
        named.filter("component is not null")
        .groupBy("component")
        .agg(F.min(place).alias("head"), F.count(F.lit(1)).alias("size"))
    )
    total = heads.agg(F.sum("size")).first()[0] or 0
    linked = attach(named.filter("component is not null"), heads, "component", "size", total).drop("size")
    alone = named.filter("component is null").withColumn("head", place)
    return linked.unionByName(alone).select(
        *extra,
        "doc_id",
        "line",
        "n_chars",
        F.col("copies").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.col("head.doc_id").alias("component_doc_id"),
        F.col("head.line").alias("component_line"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("line") == F.col("head.line"))).alias("kept"),
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``docs``, stored as structs ``doc``, with a number of each row in ``_row``: ids may repeat."""
    return stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("_row")), "numbered")


def members(rows: DataFrame, edits: int, min_chars: int, block: int) -> DataFrame:
    """``line_members`` of ``numbered`` documents, with ``row``."""
    texts = rows.select(
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.col("doc.text").cast("string").alias("text"),
        F.col("_row").alias("row"),
    )
    classes = checkpointed(
        near_classes(texts, edits, min_chars, block, ("digest", "row")).select(
            "digest",
            "n_copies",
            F.col("doc_id").alias("class_doc_id"),
            F.col("line").alias("class_line"),
            F.col("row").alias("class_row"),
            "component_doc_id",
            "component_line",
            F.col("kept").alias("class_kept"),
        )
    )
    total = classes.agg(F.sum("n_copies")).first()[0] or 0
    places = occurrences(texts).select("digest", "doc_id", "line", "row")
    first = (F.col("row") == F.col("class_row")) & (F.col("line") == F.col("class_line"))
    return attach(places, classes, "digest", "n_copies", total).select(
        "row",
        "doc_id",
        "line",
        "class_doc_id",
        "class_line",
        "component_doc_id",
        "component_line",
        (F.col("class_kept") & first).alias("kept"),
    )


def line_members(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK
) -> DataFrame:
    """One row per occurrence of a line: its place (doc_id, line), the first place of the
    lines equal to it, the first place of its component, and kept: one of a component."""
    return members(numbered(docs.select("doc_id", "text")), edits, min_chars, block).drop("row")


def without_repeated_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, block: int = BLOCK
) -> DataFrame:
    """``docs``, their texts without the lines that aren't kept."""
    rows = numbered(docs)
    flags = (
        members(rows, edits, min_chars, block)
        .groupBy(F.col("row").alias("_row"))
        .agg(F.sort_array(F.collect_list(F.struct("line", "kept"))).alias("_lines"))
    )
    parts = F.split(F.col("doc.text").cast("string"), "\n")
    text = F.array_join(F.zip_with(parts, F.col("_lines"), lambda part, line: F.when(line["kept"], part)), "\n")
    # As given but for the text; a struct's fields are found by their names as they are.
    columns = [(text if c.lower() == "text" else F.col("doc")[c]).alias(c) for c in docs.columns]
    return rows.join(flags, "_row", "left").select(*columns)


def op5_line_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_members(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_lines(table(spark, sf_dir, "documents"))
