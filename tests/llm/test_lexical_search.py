from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import lexical_search
from quarry.llm.lexical_search import OP12_SQL, Best, Bucket, op12_lexical_search, ranked, terms_of
from tests.conftest import SF_MID
from tests.llm.messy import empty, messy

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id bigint, text string, doc_id bigint, score bigint, digest string, query bigint"


def brute(items: list[tuple], docs: list[tuple], top: int) -> list[tuple]:
    bags = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        asked, scores = Counter(TERM.findall((text or "").translate(LOWER))), []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_terms
            score = 0
            for w, c in asked.items():
                if w in b:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += c * weight * (10**9 * b[w] // (1000 * b[w] + 12 * m))
            if score > 0:
                scores.append((-score, d is None, d))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r, d, -s) for r, (s, _, d) in enumerate(scores[:top], 1)]
    return sorted(out, key=str)


def test_terms():
    assert terms_of("Ab-c_d É日 \x7f x9.\x00Y") == [w.encode() for w in ["ab", "c", "d", "É日", "x9", "y"]]
    r = random.Random(3)
    for _ in range(300):
        text = "".join(r.choice("aZ09 _-\x00\x1c\x85\xa0éÉ日\U0001f600@[`{\n.") for _ in range(30))
        assert [w.decode() for w in terms_of(text)] == TERM.findall(text.translate(LOWER))
    assert terms_of(None) == terms_of("") == []


def random_tables(seed: int, n: int) -> tuple[list, list]:
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    docs = [(k, " ".join(r.choices(vocabulary, weights, k=r.choice([1, 5, 40, 300])))) for k in range(n)]
    docs += [(n + k, docs[0][1]) for k in range(n // 3)]  # a third are copies: equal scores
    items = [(k, " ".join(r.choices(vocabulary, weights if k % 2 else None, k=r.randint(1, 30)))) for k in range(25)]
    return docs, items + [(3, "w1 w1 w399 w399 w399"), (99, None), (100, "..."), (101, "unknown words")]


@pytest.mark.parametrize("block_terms", [60, 10**6])
@pytest.mark.parametrize("head", [1, 100])
def test_against_scoring_every_document(spark, head, block_terms):
    docs, items = random_tables(head, 300)
    got = ranked(
        spark.createDataFrame([(*i, None, None, "x", None) for i in items], ITEMS),
        spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n", F.lit("clash")),
        top=7, head=head, block_terms=block_terms,
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute(items, docs, 7)


def test_messy_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in messy(spark).collect()]
    items = [(1, "the quick brown FOX"), (1, "a"), (None, "w5x5 text"), (2, "日本語 ünïcode")]
    asked = spark.createDataFrame([(*i, None, None, None, None) for i in items], ITEMS)
    got = sorted(map(tuple, ranked(asked, messy(spark)).collect()), key=str)
    assert got == brute(items, docs, 20)


def test_empty_tables(spark):
    asked = spark.createDataFrame([(1, "a b", None, None, None, None)], ITEMS)
    assert ranked(asked, empty(spark)).collect() == []
    assert ranked(asked.limit(0), messy(spark)).collect() == []


def test_buckets_and_coordinates_are_pruned(monkeypatch, spark):
    """What is skipped: whole buckets by length, most vectors of a bucket by their bounds."""
    weights = np.array([8000, 100, 100], np.int64)
    vectors = lexical_search.Vectors.__new__(lexical_search.Vectors)
    vectors.rows, vectors.row = 50, np.repeat(np.arange(50), 2)
    vectors.term = np.tile([1, 2], 50)
    vectors.term[0] = 0  # only the first vector has the rare term
    vectors.impact = np.full(100, 500_000)
    vectors.value = weights[vectors.term].astype(float) * vectors.impact
    vectors.length = np.sqrt(np.bincount(vectors.row, vectors.value**2))
    block = [("q", Counter({b"a": 1, b"b": 1, b"c": 1}))]
    queries = lexical_search.Queries(block, {b"a": 0, b"b": 1, b"c": 2}, weights)
    best = Best(np.array([4 * 10**9]), 5)
    bucket = Bucket(vectors, np.arange(50))
    seen = []
    monkeypatch.setattr(best, "add", lambda q, scores, ids: seen.append(ids.tolist()))
    bucket.search(queries, 0, best, 1)
    assert seen == [[0]]
    shorter = np.flatnonzero(queries.length * bucket.length[1] >= best.least)
    assert not len(shorter)


def test_query_against_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF_MID}/{name}.parquet'")
    want = sorted(con.execute(OP12_SQL).fetchall(), key=str)
    got = sorted(map(tuple, op12_lexical_search(spark, SF_MID).collect()), key=str)
    assert got == want and len(got) > 100
    ranks = defaultdict(list)
    for item, rank, *_ in got:
        ranks[item].append(rank)
    assert all(sorted(r) == list(range(1, len(r) + 1)) for r in ranks.values())
