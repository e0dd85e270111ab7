from __future__ import annotations

import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe
from quarry.llm.bpe import BpeCodec, decode, encode, op9_bpe, token_digests, tokenizer_file
from quarry.llm.token_counts import LongestMatch, count_tokens, op2_token_counts, vocabulary_pieces
from tests.conftest import SF_SMALL
from tests.llm.messy import empty, messy

STRANGE = [
    "",
    "a",
    "\x1c\x1d hi\x85 there\xa0​ x",
    "<|endoftext|>ab <|endoftext|> <|endoftext|",
    "  \n\n  a \t\r\n",
    "日本語 テキスト ١٢٣ ½ ²",
    "é \U0001f600\U0001f468‍\U0001f469",
    "'s 'S don't I'LL we'll",
    "a" * 5000,
    "　 x ﻿ y ᠎ z",
    "\x00\x01 \x7f",
    "ab " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_codec_equals_library(library):
    codec = BpeCodec(tokenizer_file())
    r = random.Random(9)
    texts = STRANGE + ["".join(r.choice("abz é'\n 1!ß中") for _ in range(r.randint(0, 40))) for _ in range(500)]
    for text in texts:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == wanted, text
        assert codec.decode(wanted) == library.decode(wanted, skip_special_tokens=False) == text
        assert b"".join(run[2] for run in codec.encode_runs(text)).decode() == text


def test_decode_of_broken_ids_equals_library(library):
    codec = BpeCodec(tokenizer_file())
    r = random.Random(3)
    for _ in range(300):
        ids = [r.randrange(50_257) for _ in range(r.randint(1, 6))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    codec = BpeCodec(tokenizer_file())
    text = "one two three four five six one two three four"
    assert codec.encode(text) == BpeCodec(tokenizer_file()).encode(text) and len(codec.runs) <= 3


def expected(library, docs):
    out = []
    for r in docs:
        text = r["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        out.append((r["doc_id"], len(ids), digest, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_against_library(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert sorted(map(tuple, op9_bpe(spark, SF_SMALL).collect()), key=str) == expected(library, docs)


def test_defined_cases(spark, library):
    docs = messy(spark)
    assert sorted(map(tuple, token_digests(docs).collect()), key=str) == expected(library, docs.collect())
    again = decode(encode(docs, ids_col="key"), ids_col="key", text_col="n")
    assert set(again.columns) == set(docs.columns)
    for r in again.select("text", "key", "n").collect():
        assert r["n"] == (r["text"] or "") and r["key"] == library.encode(r["n"], add_special_tokens=False).ids
    with_ids = token_digests(docs, with_ids=True).filter("doc_id = 6").first()
    assert with_ids["ids"] == library.encode("a", add_special_tokens=False).ids
    assert token_digests(empty(spark)).count() == 0


def naive(word: bytes, pieces: set[bytes], longest: int) -> int:
    n = at = 0
    while at < len(word):
        size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return 1
        at, n = at + size, n + 1
    return n


def test_automaton_against_greedy_cut():
    r = random.Random(1)
    for _ in range(800):
        pieces = {bytes(r.choice(b"abc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 9))}
        automaton = LongestMatch(pieces)
        for _ in range(6):
            word = bytes(r.choice(b"abc") for _ in range(r.randint(0, 12)))
            assert automaton.count(word) == naive(word, pieces, 5)


def counts(docs, pieces, longest):
    out = []
    for r in docs:
        found = [naive(b" " + w, pieces, longest) for w in (r["text"] or "").encode().split()]
        out.append((r["doc_id"], len(found), sum(found), max(found, default=0)))
    return sorted(out, key=str)


def test_token_counts_against_greedy_cut(spark):
    pieces = set(vocabulary_pieces(tokenizer_file()))
    longest = max(map(len, pieces))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert sorted(map(tuple, op2_token_counts(spark, SF_SMALL).collect()), key=str) == counts(docs, pieces, longest)
    docs = messy(spark)
    assert sorted(map(tuple, count_tokens(docs).collect()), key=str) == counts(docs.collect(), pieces, longest)
    assert count_tokens(empty(spark)).count() == 0
    few = count_tokens(spark.createDataFrame([(1, "ab xb")], "doc_id int, text string"), [b" ", b"a", b"b"]).first()
    assert tuple(few) == (1, 2, 4, 3)  # " ", a, b; x is unknown


def test_a_workers_cache_of_rare_words_stays_small():
    """Several workers of an executor keep one: it may hold 100 MB at most, however many words there are."""
    codec = BpeCodec(tokenizer_file())
    tracemalloc.start()
    try:
        for k in range(2 * bpe.CACHE_ENTRIES):
            codec.runs[f" {k:x}"]
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert held < 100e6
