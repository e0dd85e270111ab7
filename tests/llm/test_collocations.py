from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import collocations as c
from quarry.llm.collocations import OP13_SQL, DoubleArray, collocations, op13_collocations, scored, words_of
from tests.conftest import SF_MID
from tests.llm.messy import empty, messy

LOWER = {k: k + 32 for k in range(65, 91)}


def pieces(text: str | None) -> list[list[str]]:
    cut = re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))
    return [re.findall(r"[^\x20\x09]+", p) for p in cut]


def brute(docs: list[tuple], least: int, longest: int, top: int, percent: int = 100) -> list[tuple]:
    f, total = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for at in range(len(words) - k + 1):
                    f[lang, tuple(words[at : at + k])] += 1
    often = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    longer = Counter()  # the most occurrences of a longer phrase around each
    for (lang, q), n in often.items():
        for k in range(2, len(q)):
            for i in range(len(q) - k + 1):
                longer[lang, q[i : i + k]] = max(longer[lang, q[i : i + k]], n)
    out = defaultdict(list)
    for (lang, p), a in often.items():
        inside = longer[lang, p] > 0 and 100 * longer[lang, p] >= percent * a
        if not inside:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    rows = []
    for lang, found in out.items():
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(rows)


def test_words():
    r = random.Random(1)
    for _ in range(300):
        text = "".join(r.choice("aB Z\t.,;!?\n\x0b\r\x1c\x85\xa0é日:") for _ in range(40))
        got = [w.decode() for part in words_of(text) for w in part]
        want = [w for p in pieces(text) for w in p]
        assert [w for w in got if w != "."] == want
    assert list(words_of(None)) == list(words_of("")) == []


def test_long_texts_are_cut_at_separators(monkeypatch):
    monkeypatch.setattr(c, "PART", 10)
    text = "one two three four. five six, seven eight nine ten eleven " * 20
    parts = list(words_of(text))
    assert len(parts) > 20 and all(p[-1] == b"." for p in parts)
    joined = b" ".join(w for p in parts for w in p).decode()
    assert pieces(joined) != [] and [p for p in pieces(joined) if p] == [p for p in pieces(text) if p]


@pytest.mark.parametrize("seed", range(6))
def test_double_array_accepts_its_sequences_only(seed):
    r = random.Random(seed)
    width = r.choice([2, 30, 2000])
    made = {tuple(r.randint(1, width) for _ in range(r.randint(1, 5))) for _ in range(r.choice([0, 1, 50, 3000]))}
    sequences = list(made)
    rows = np.array([s + (0,) * (5 - len(s)) for s in sequences], np.int32).reshape(len(sequences), 5)
    trie = DoubleArray(rows)
    tried = sequences + [tuple(r.randint(0, width) for _ in range(r.randint(1, 5))) for _ in range(500)]
    for s in tried:
        state = np.zeros(1, np.int32)
        for code in s:
            code = code if code < trie.codes else 0
            state, _ = trie.advance(state, np.array([code], np.int32))
        found = trie.accepts[state[0]] if len(state) else -1
        assert (found >= 0 and sequences[found] == s) == (s in made)


def test_double_array_stays_compact():
    """Phrases of words by Zipf's law: few wide nodes, many narrow ones with codes far apart."""
    r = np.random.default_rng(3)
    words = np.minimum(r.zipf(1.3, (60_000, 3)), 20_000)
    rows = np.unique(np.vstack([words * [1, 1, 0], words, np.arange(1, 20_001)[:, None] * [1, 0, 0]]), axis=0)
    trie = DoubleArray(rows.astype(np.int32))
    assert len(trie.check) < 8 * len(rows) + 20 * trie.codes


def random_docs(n: int) -> list[tuple]:
    r = random.Random(n)
    words = ["the", "of", "New", "york", "city", "hall", "a", "b", "é", "日本", "x-y"]
    phrases = ["new York City hall", "the new york", "of the", "a b a b a b", "日本 é"]
    docs = []
    for _ in range(n):
        parts = [r.choice(phrases if r.random() < 0.5 else words) + r.choice([" ", " ", "\t", ". ", "\n"]) for _ in range(40)]
        docs.append(("".join(parts), r.choice(["en", "en", "fr", None, "und"])))
    return docs


@pytest.mark.parametrize("shard,bits,slice_", [(10**6, 1 << 27, 1 << 21), (60, 1 << 16, 50)])
def test_against_brute_force(spark, monkeypatch, shard, bits, slice_):
    """Also with several tries, a bitmap that marks much wrongly and slices of one text."""
    docs = random_docs(150)
    monkeypatch.setattr(c, "SLICE", slice_)
    df = spark.createDataFrame(docs, "text string, lang string").withColumns(
        {n: F.lit(1) for n in ("word", "f", "hash", "phrase", "n", "number")}
    )
    got = collocations(df, least=12, top=25, shard=shard, bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(docs, 12, 5, 25)


def test_messy_documents_and_other_parameters(spark):
    docs = [(r["text"], r["lang"]) for r in messy(spark).collect()]
    got = collocations(messy(spark), least=2, longest=3, top=400, percent=50)
    assert sorted(map(tuple, got.collect())) == brute(docs, 2, 3, 400, 50)
    assert collocations(empty(spark)).collect() == []


def test_scores_beyond_64_bits(spark):
    a, n = 10**13, 9 * 10**17
    phrases = spark.createDataFrame([("en", "x y", a)], "lang string, phrase string, a long")
    words = spark.createDataFrame([("en", "x", 3 * a), ("en", "y", a + 7)], "lang string, word string, f long")
    row = scored(phrases, words, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert row["score"] == 1000 * a * n // (3 * a * (a + 7))


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_MID}/documents.parquet'")
    want = sorted(con.execute(OP13_SQL).fetchall())
    got = sorted(map(tuple, op13_collocations(spark, SF_MID).collect()))
    assert got == want and len(got) > 50


@pytest.mark.parametrize("weak", [False, True])
def test_encoded_slices_have_the_words(monkeypatch, weak):
    """Every word in order, with its language, bytes and count; also if all words share few hashes."""
    if weak:
        hashes = c.hashes_between
        monkeypatch.setattr(c, "hashes_between", lambda *given: hashes(*given) & np.uint64(3))
    monkeypatch.setattr(c, "SLICE_BYTES", 4000)
    monkeypatch.setattr(c, "COMPARED", 7)
    docs = random_docs(60) + [(None, "fr"), ("", "en"), (" .\n. ", "xx"), ("x" * 90 + "y " + "x" * 90 + "z a\x1cb \x85", "en")]
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": lang or "und"} for t, lang in docs])
    got, rows = [], list(c.rows_in(c.encoded(iter([batch]))))
    for row in rows:
        codes, langs, f = c.codes_of(row), c.unsqueezed(row["lang"], row["distinct"]), c.unsqueezed(row["f"], row["distinct"])
        names = c.names_of(row, np.arange(row["distinct"]))
        words = [(row["langs"][of], w.decode()) for of, w in zip(langs.tolist(), names, strict=True)]
        assert len(set(words)) == len(words) and codes[-1] == 0
        assert Counter(codes[codes > 0].tolist()) == dict(enumerate(f.tolist(), 1))
        found = [words[code - 1] if code else None for code in codes.tolist()]
        got += [list(g) for at, g in itertools.groupby(found, lambda w: w is None) if not at]
    assert len(rows) > 3
    assert got == [[(lang or "und", w) for w in p] for text, lang in docs for p in pieces(text) if p]


def test_texts_are_read_once(spark):
    """However many tries there are."""
    read = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = random_docs(80)
    df = spark.createDataFrame(docs, "text string, lang string").mapInArrow(through, "text string, lang string")
    got = collocations(df, least=8, top=30, shard=40)
    assert sorted(map(tuple, got.collect())) == brute(docs, 8, 5, 30)
    assert read.value == len(docs)


def test_shards_of_phrases(spark):
    """One first word's phrases are in one shard, unless they are a large part of it."""
    few = [(lang, f"{a} {b}") for lang in ("en", "fr") for a in "abcdefgh" for b in ("x", "y", "z z", "a b c")]
    many = [("en", f"of {k}") for k in range(400)]
    given = spark.createDataFrame([*few, *many, ("en", "")], "lang string, phrase string")
    got = [tuple(r) for r in c.sharded(given, 5, 100).collect()]
    assert sorted(r[:2] for r in got) == sorted([*few, *many, ("en", "")])
    of = defaultdict(set)
    for lang, phrase, shard in got:
        of[lang, phrase.split(" ")[0]].add(shard)
    assert of.pop(("en", "of")) == set(range(5)) and all(len(x) == 1 for x in of.values())
    assert max(Counter(shard for _, phrase, shard in got if phrase.startswith("of ")).values()) < 130
