"""Byte-level BPE encoding and decoding (operator 9).

``BpeCodec`` encodes as a byte-level BPE tokenizer file says: added tokens are cut
out, the rest is split by the pre-token pattern, and the symbols of each pre-token
are merged by rank with a priority queue over a doubly linked list. Entries of the
queue whose symbols have changed are skipped. Decoding concatenates vocabulary
strings. Both work per pre-token, so a pre-token's ids and their decoded bytes are kept
in a bounded cache that the tasks of a Python worker share.

The tokenizer file is read on the driver and broadcast: its size does not depend
on the data. ``encode`` and ``decode`` add real ids and texts to a table; each row
is handled on its own, without a shuffle.

Defined cases: a null text is empty; an empty text has no ids and decodes to an
empty text; other columns pass through ``encode`` and ``decode`` unless they bear
the new column's name, which is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import arrow_types, rows_of, table, to_batches, worker_state

#: Fixed value: how byte-level BPE splits text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_ENTRIES = 100_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 for itself, the
    others, in order, for the characters from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


class _Cache(dict):
    """Keeps at least the CACHE_ENTRIES values used last, and at most twice as many."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        if len(self) >= CACHE_ENTRIES:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class BpeCodec:
    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        symbols = byte_symbols()
        self.byte_ids = [vocab[s] for s in symbols]
        of = {s: b for b, s in enumerate(symbols)}
        self.strings = {i: bytes(of[c] for c in s) for s, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None
        self.split = regex.compile(PATTERN)
        self.runs = _Cache(lambda w: self.run(self.merge(w.encode("utf-8", "replace"))))

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        merges = self.merges
        after = list(range(1, n + 1))  # n: no symbol
        before = list(range(-1, n - 1))
        queue = []
        for k in range(n - 1):
            if found := merges.get((ids[k], ids[k + 1])):
                queue.append((found[0], k, ids[k], ids[k + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, k, a, b, new = heapq.heappop(queue)
            j = after[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue  # stale: a symbol of the pair has been merged meanwhile
            ids[k], ids[j] = new, -1
            after[k] = j = after[j]
            if j < n:
                before[j] = k
                if found := merges.get((new, ids[j])):
                    heapq.heappush(queue, (found[0], k, new, ids[j], found[1]))
            if (i := before[k]) >= 0 and (found := merges.get((ids[i], new))):
                heapq.heappush(queue, (found[0], i, ids[i], new, found[1]))
        return [i for i in ids if i >= 0]

    def run(self, ids: list[int]) -> tuple[bytes, str, bytes]:
        """A run of ids: as 32-bit integers, as text ("12,345"), and decoded."""
        return array("i", ids).tobytes(), ",".join(map(str, ids)), b"".join([self.strings[i] for i in ids])

    def encode_runs(self, text: str) -> list[tuple[bytes, str, bytes]]:
        """The runs of ids of each pre-token and added token."""
        if self.cut is None or not any(t in text for t in self.added):
            return [self.runs[w] for w in self.split.findall(text)]
        out = []
        for k, part in enumerate(self.cut.split(text)):
            out += [self.run([self.added[part]])] if k % 2 else [self.runs[w] for w in self.split.findall(part)]
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join([run[0] for run in self.encode_runs(text)]), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.strings[i] for i in ids]).decode("utf-8", "replace")


def codec_of(spec: Broadcast) -> BpeCodec:
    """The worker's codec for a tokenizer; tasks that run in one worker share its cache."""
    key = hashlib.sha256(spec.value.encode()).hexdigest()
    return worker_state(f"bpe {key}", lambda: BpeCodec(spec.value))


def tokenizer_file(path: str | None = None) -> str:
    """The text of a tokenizer file; by default the public 50k byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def _map_rows(df: DataFrame, fn, schema: str, tokenizer: str | None, size: int) -> DataFrame:
    """fn(codec, row) -> tuple for every row of ``df``, in the workers."""
    spark = df.sparkSession
    spec = spark.sparkContext.broadcast(tokenizer_file(tokenizer))
    types = arrow_types(spark, schema)
    names = spark.createDataFrame([], schema).columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(spec)
        yield from to_batches((fn(codec, r) for r in rows_of(batches)), names, types, size)

    return df.mapInArrow(run, schema)


def _with_column(df: DataFrame, read: str, made: str, kind: str, fn, tokenizer: str | None) -> DataFrame:
    """``df`` with ``made`` = fn(codec, value of ``read``); rows pass by place, whatever their names."""
    names, kept = df.columns, [k for k, f in enumerate(df.schema.fields) if f.name != made]
    schema = ", ".join([*(f"c{k} {df.schema.fields[k].dataType.simpleString()}" for k in kept), f"made {kind}"])
    value = f"c{names.index(read)}"

    def row(codec: BpeCodec, r: dict) -> tuple:
        return *[r[f"c{k}"] for k in kept], fn(codec, r[value])

    placed = df.toDF(*[f"c{k}" for k in range(len(names))])
    return _map_rows(placed, row, schema, tokenizer, 256).toDF(*[names[k] for k in kept], made)


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """``df`` with the token ids of its texts (array<int>)."""
    return _with_column(df, text_col, ids_col, "array<int>", lambda c, text: c.encode(text or ""), tokenizer)


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """``df`` with the text that its ids stand for."""
    return _with_column(df, ids_col, text_col, "string", lambda c, ids: c.decode(ids or []), tokenizer)


def token_digests(docs: DataFrame, with_ids: bool = False, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of whole texts: encoded, then decoded."""

    def row(codec: BpeCodec, r: dict) -> tuple:
        runs = codec.encode_runs(r["text"] or "")
        ids = ",".join([run[1] for run in runs])
        decoded = b"".join([run[2] for run in runs]).decode("utf-8", "replace").encode()
        n = ids.count(",") + 1 if ids else 0
        found = r["doc_id"], n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()
        if not with_ids:
            return found
        return *found, np.frombuffer(b"".join([run[0] for run in runs]), np.int32)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _map_rows(rows, row, schema + ", ids array<int>" * with_ids, tokenizer, 256)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))
