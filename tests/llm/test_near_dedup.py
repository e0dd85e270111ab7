from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from quarry.llm import minhash_dedup
from quarry.llm.common import connected_components
from quarry.llm.embedding_dedup import near_embeddings, op3_embedding_dedup, passes_for, unit_vector
from quarry.llm.minhash_dedup import bands_of, drop_near, near_duplicates, op4_minhash_dedup
from quarry.llm.shingles import linked_pairs, odd_numbers, shingle_hashes, word_hashes
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.brute import components
from tests.llm.messy import empty, messy, words_of


def shingles(text, n=4):
    w = words_of(text)
    if 0 < len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1))


def linked(a, b):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= 80 * (len(a) + len(b) - both)


def expected(docs, n=4):
    """(doc_id, n_shingles, component_id, kept) for rows (doc_id, text)."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    named = [(d, s) for d, s in sets if d is not None]
    links = [(a, b) for (a, x), (b, y) in combinations(named, 2) if linked(x, y)]
    comp = components({d for d, _ in named}, links)
    return sorted(((d, len(s), comp.get(d), d == comp.get(d)) for d, s in sets), key=str)


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 700)]
    links += [(1000, 1000 + k) for k in range(500)]
    links += [(5, None), (None, None)]
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    whole = [x for x in links if None not in x]
    assert {x["node"]: x["component"] for x in got} == components({n for x in whole for n in x}, whole)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("shape", ["ascending", "shuffled", "star"])
def test_components_take_few_rounds_whatever_the_order(spark, shape):
    n = 10_000
    ids = list(range(n))
    if shape == "shuffled":
        random.Random(4).shuffle(ids)
    links = list(zip(ids, ids[1:]))
    if shape == "star":
        links = [(5000, k) for k in ids]
    rounds = []
    got = connected_components(spark.createDataFrame(links, "a bigint, b bigint"), rounds)
    nodes = {x for link in links for x in link}
    assert got.count() == len(nodes)
    assert {r["component"] for r in got.select("component").distinct().collect()} == {min(nodes)}
    assert len(rounds) <= 12


def test_linked_pairs_connect_what_is_linked():
    r = random.Random(2)
    for _ in range(100):
        sets = [np.array(sorted(r.sample(range(14), r.randint(1, 12))), np.uint64) for _ in range(12)]
        block = [r.randrange(2) for _ in sets]
        for blocks in ([0] * 12, block):
            two = len(set(blocks)) > 1
            wanted = [
                (i, j)
                for i, j in combinations(range(12), 2)
                if linked(set(sets[i].tolist()), set(sets[j].tolist())) and not (two and blocks[i] == blocks[j])
            ]
            got = list(linked_pairs(sets, blocks, 80))
            assert set(got) <= set(wanted)
            assert components(range(12), got) == components(range(12), wanted)


def test_tensored_tables_meet_at_the_threshold():
    """Pairs at a Jaccard index of 0.8 share a band in both collections nearly always."""
    r = np.random.default_rng(1)
    factors = odd_numbers(minhash_dedup.SEED, 2 * minhash_dedup.COLLECTION * minhash_dedup.ROWS)
    half, met = minhash_dedup.COLLECTION, 0
    for _ in range(400):
        x = r.integers(0, 1 << 63, 180, dtype=np.uint64)
        a, b = (bands_of(np.sort(s), factors) for s in (x[:162], x[18:]))  # 144 / 180 = 0.8
        same = a == b
        met += bool(same[:half].any() and same[half:].any())
    assert met >= 396


def test_shingles_are_of_whole_texts():
    text = "One two\tTHREE four  Five É"
    assert len(shingle_hashes(word_hashes(text), 4)) == 3
    assert len(shingle_hashes(word_hashes("a b"), 4)) == 1
    assert len(shingle_hashes(word_hashes(None), 4)) == 0
    same = shingle_hashes(word_hashes("one TWO three four five É"), 4)
    assert (same == shingle_hashes(word_hashes(text), 4)).all()


def test_documents_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    assert sorted(map(tuple, op4_minhash_dedup(spark, SF_MID).collect()), key=str) == expected(docs)


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_SETS", 8)
    r = random.Random(7)
    base = [f"w{k}" for k in range(60)]
    docs = []
    for k in range(120):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(60)] = f"x{r.randrange(9999)}"
        docs.append((k * 3, " ".join(words)))
    rows = near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(map(tuple, rows.collect()), key=str) == expected(docs)


def test_messy_documents(spark):
    docs = messy(spark)
    got = sorted(map(tuple, near_duplicates(docs).collect()), key=str)
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    left = drop_near(docs, 5)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, _, c, kept in got if kept}
    assert near_duplicates(empty(spark)).count() == 0 and drop_near(empty(spark), 5).count() == 0


VECTORS = "vec_id bigint, embedding array<double>, label int, id bigint, size int, key bigint"


def clusters(n, dims, seed):
    """Vectors of which some are near copies, at cosines around the threshold and far above it."""
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, dims))
    for k in range(n // 4):
        a = r.integers(n)
        x[r.integers(n)] = x[a] + r.uniform(0.0, 0.55) * r.standard_normal(dims)
    x[n // 2 : n // 2 + n // 10] = x[0] + 0.05 * r.standard_normal((n // 10, dims))
    x[-5:] = x[1]
    return x


def expected_vectors(ids, vectors, cosine=0.9):
    units = [unit_vector(v) for v in vectors]
    named = [k for k, u in enumerate(units) if u is not None and ids[k] is not None]
    links = [
        (ids[a], ids[b]) for a, b in combinations(named, 2) if len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine
    ]
    comp = components({i for i in ids if i is not None}, links)
    n = {i: 0 for i in ids}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], comp.get(i)) for i in ids}


def test_vectors_against_brute_force(spark):
    x = clusters(900, 24, 3)
    rows = [(k, x[k].tolist(), k % 3, 1, 2, 3) for k in range(len(x))]
    # Small windows, blocks and tiles, so that all of them have borders.
    got = near_embeddings(spark.createDataFrame(rows, VECTORS), window=32, block=128, tile=40).collect()
    wanted = expected_vectors(list(range(len(x))), x.tolist())
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == wanted
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got) and len(got) == len(x)


def test_vector_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    got = op3_embedding_dedup(spark, SF_SMALL).collect()
    wanted = expected_vectors([r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == wanted


def test_passes_grow_with_the_vectors():
    n = [passes_for(10**k, 0.9, 256) for k in range(3, 9)]
    assert n == sorted(n) and n[0] >= 4


def test_messy_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        [1.0, 0.0],
        [2.0, 0.0],
        [1e300, 1e299],
        [1e-300, 0.0],
        [0.0, 0.0],
        [nan, 1.0],
        [inf, 1.0],
        [None, 1.0],
        [],
        None,
        [1.0, 0.0, 0.0],
        [1.0],
        [0.9, 0.43588989435406736],
        [-1.0, 0.0],
    ]
    rows = [(k, v, 0, 5, 5, 5) for k, v in enumerate(vectors)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_embeddings(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == expected_vectors(list(range(len(vectors))), vectors)
    more = rows + [rows[0], rows[0], (None, [1.0, 0.0], 0, 5, 5, 5)]
    again = near_embeddings(spark.createDataFrame(more, VECTORS)).collect()
    assert len(again) == len(more)
    assert [tuple(r) for r in again if r["vec_id"] is None] == [(None, 0, None, True)]
    assert {r["n_links"] for r in again if r["vec_id"] == 0} == {got[0][0] + 2}
    assert near_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
