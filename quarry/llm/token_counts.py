"""Token counts by a linear longest-match automaton (operator 2).

A word is cut greedily into the longest vocabulary pieces. The automaton is a trie
of the vocabulary whose states carry a failure link and the number of pieces that
are complete when the link is followed (Aho-Corasick links, specialised to longest
match from the left). Reading a word takes one pass over its bytes, and only the
number of pieces is kept: no piece is ever built.

Vocabulary pieces and words are bytes; a word is read with a space before it, so
pieces that begin with a space begin a word and all others continue one. A word that
the vocabulary can't spell counts as one unknown token. By default the vocabulary is
that of the public 50k byte-level file; it holds every byte, so no word is unknown.
The automaton's size depends on the vocabulary alone; it is broadcast.

Defined cases: a null or empty text has no words and no tokens; every row gives one
row, repeated ids as well; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.bpe import byte_symbols, tokenizer_file
from quarry.llm.common import arrow_types, rows_of, table, to_batches

CACHE_WORDS = 300_000
COUNTS = "doc_id bigint, n_words bigint, n_tokens bigint, longest_word_tokens bigint"


class LongestMatch:
    """States are numbers; 0 is the root. ``step[state]`` maps a byte to the next state."""

    def __init__(self, pieces: Iterable[bytes]):
        self.step: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in pieces:
            at = 0
            for byte in piece:
                if byte not in self.step[at]:
                    self.step[at][byte] = len(self.step)
                    self.step.append({})
                    whole.append(False)
                at = self.step[at][byte]
            whole[at] = at > 0
        # Where to go on when no longer match exists (-1: nowhere), and the pieces done by then.
        self.link, self.done = [-1] * len(self.step), [0] * len(self.step)
        level = [0]
        while level:
            below = []
            for parent in level:
                for byte, state in self.step[parent].items():
                    below.append(state)
                    if whole[state]:
                        self.link[state], self.done[state] = 0, 1
                        continue
                    at, done = self.link[parent], self.done[parent]
                    while at >= 0 and byte not in self.step[at]:
                        done += self.done[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[state], self.done[state] = self.step[at][byte], done
            level = below

    def count(self, word: bytes) -> int:
        """The number of pieces of a word; 1 if it can't be spelled."""
        step, link, done = self.step, self.link, self.done
        at = n = 0
        for byte in word:
            while byte not in step[at]:
                if link[at] < 0:
                    return 1
                n += done[at]
                at = link[at]
            at = step[at][byte]
        while at:
            if link[at] < 0:
                return 1
            n += done[at]
            at = link[at]
        return n


def vocabulary_pieces(tokenizer_json: str) -> list[bytes]:
    """The byte strings of a byte-level vocabulary."""
    of = {s: b for b, s in enumerate(byte_symbols())}
    return [bytes(of[c] for c in piece) for piece in json.loads(tokenizer_json)["model"]["vocab"]]


class _Counts(dict):
    """Token counts of words seen; forgets all when it has grown to CACHE_WORDS."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = n = self.automaton.count(b" " + word)
        return n


def count_tokens(docs: DataFrame, pieces: Iterable[bytes] | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens, longest_word_tokens) of whole texts, row by row, without a shuffle.

    ``longest_word_tokens``: the most tokens that a word of the text has.
    """
    spark = docs.sparkSession
    automaton = LongestMatch(vocabulary_pieces(tokenizer_file()) if pieces is None else pieces)
    shared = spark.sparkContext.broadcast(automaton)
    types = arrow_types(spark, COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(shared.value)

        def rows() -> Iterator[tuple]:
            for r in rows_of(batches):
                found = [counts[w] for w in (r["text"] or "").encode("utf-8", "replace").split()]
                yield r["doc_id"], len(found), sum(found), max(found, default=0)

        yield from to_batches(rows(), [c.split()[0] for c in COUNTS.split(", ")], types)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, COUNTS)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
