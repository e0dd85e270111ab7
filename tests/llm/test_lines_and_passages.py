from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from quarry.llm.line_dedup import (
    first_common,
    line_keys,
    line_members,
    near_lines,
    op5_line_dedup,
    probes,
    segments,
    within,
    without_repeated_lines,
)
from quarry.llm.passages import (
    IDENTITY,
    MIN_WORDS,
    WINDOW,
    PrefixMax,
    chains,
    common_words,
    like,
    minimizers,
    op7_repeated_passages,
    repeated_passages,
    star_matches,
    united,
)
from tests.conftest import SF_SMALL
from tests.llm.brute import components
from tests.llm.messy import empty, messy, words_of


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def edited(r, line, edits):
    for _ in range(edits):
        at, kind = r.randrange(len(line) + 1), r.randrange(3)
        line = line[:at] + (r.choice("abcé") if kind else "") + line[at + (kind != 2) :]
    return line


def test_banded_distance():
    r = random.Random(2)
    for _ in range(5000):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 9))) for _ in range(2))
        k = r.randint(0, 3)
        assert within(a, b, k) == (distance(a, b) <= k), (a, b, k)


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_near_lines_share_a_key(edits):
    r = random.Random(edits)
    for _ in range(3000):
        a = "".join(r.choice("abcdé ") for _ in range(r.randint(8, 40)))
        b = edited(r, a, r.randint(0, edits))
        if len(b) < 8 or distance(a, b) > edits:
            continue
        a, b = sorted((a, b), key=len)
        assert first_common(a, b, edits, 8) >= 0
        assert line_keys(a, edits, 8) & line_keys(b, edits, 8)


def test_segments_cover_a_line():
    for n in range(3, 50):
        parts = segments(n, 2)
        assert sum(size for _, size in parts) == n and [at for at, _ in parts][0] == 0
        assert all(0 <= at and at + size <= n for _, _, places, size in probes(n, 2, 3) for at in places)


def expected_lines(docs, edits, min_chars):
    first, copies = {}, Counter()
    order = lambda d: (d is None, d or 0)
    for doc_id, text in docs:
        for k, line in enumerate([] if text is None else text.split("\n")):
            copies[line] += 1
            first[line] = min(first.get(line, (doc_id, k)), (doc_id, k), key=lambda p: (order(p[0]), p[1]))
    long = [x for x in first if len(x) >= min_chars]
    links = [(a, b) for a, b in combinations(long, 2) if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits]
    n = Counter(x for pair in links for x in pair)
    comp, heads = components(first, links), {}
    for line, c in comp.items():
        heads.setdefault(c, []).append(first[line])
    out = []
    for line, (doc_id, k) in first.items():
        head = min(heads[comp[line]], key=lambda p: (order(p[0]), p[1]))
        out.append((doc_id, k, len(line), copies[line], n[line], *head, head == (doc_id, k)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [4, 256])
def test_lines_against_brute_force(spark, block):
    r = random.Random(4)
    seeds = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(18, 34))) for _ in range(14)]
    head = "a common beginning of many lines, "
    docs = []
    for d in range(40):
        lines = [edited(r, r.choice(seeds), r.randint(0, 3)) for _ in range(4)]
        lines += [head + str(r.randrange(300)), r.choice(["", "x", "short"])]
        docs.append((d, "\n".join(lines)))
    rows = near_lines(spark.createDataFrame(docs, "doc_id bigint, text string"), 2, 20, block)
    assert sorted(map(tuple, rows.collect()), key=str) == expected_lines(docs, 2, 20)


def test_line_query(spark):
    """Against the texts: all lines, copies and exact classes (links: brute force above)."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    copies = Counter(x for r in docs for x in (r["text"] or "").split("\n"))
    got = op5_line_dedup(spark, SF_SMALL).collect()
    texts = {r["doc_id"]: r["text"].split("\n") for r in docs}
    assert {texts[r["doc_id"]][r["line"]]: r["n_copies"] for r in got} == copies and len(got) == len(copies)


def test_messy_lines(spark):
    docs = messy(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, near_lines(docs).collect()), key=str) == expected_lines(rows, 2, 20)
    assert near_lines(empty(spark)).count() == 0


def test_every_occurrence_of_a_line_has_a_class(spark):
    one, near, other = "the very same line in many texts", "the very same line in many tests", "another line of its own"
    docs = [(1, f"{one}\n{other}"), (2, one), (3, f"x\n{one}\n{near}\n"), (3, f"x\n{one}\n{near}\n"), (4, None)]
    docs += [(5, ""), (None, f"{near}\nlast line of a text without id")]
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id bigint, text string, k int")
    rows = [(d, text) for d, text in docs]
    places = {(r["doc_id"], r["line"]): r for r in near_lines(df, 2, 20).collect()}
    got = [r.asDict() for r in line_members(df, 2, 20).collect()]
    lines = [(d, k, x) for d, text in rows if text is not None for k, x in enumerate(text.split("\n"))]
    assert Counter((r["doc_id"], r["line"]) for r in got) == Counter((d, k) for d, k, _ in lines)
    text_at = {(d, k): x for d, k, x in lines}
    for r in got:
        assert text_at[r["doc_id"], r["line"]] == text_at[r["class_doc_id"], r["class_line"]]
        of = places[r["class_doc_id"], r["class_line"]]
        assert (r["component_doc_id"], r["component_line"]) == (of["component_doc_id"], of["component_line"])
    heads = Counter((r["component_doc_id"], r["component_line"]) for r in got if r["kept"])
    assert set(heads.values()) == {1} and set(heads) == {(r["component_doc_id"], r["component_line"]) for r in got}
    left = without_repeated_lines(df, 2, 20)
    assert left.columns == df.columns
    texts = {r["k"]: r["text"] for r in left.collect()}
    assert [texts[k] for k in (0, 1, 4, 5, 6)] == [docs[0][1], "", None, "", "last line of a text without id"]
    assert sorted([texts[2], texts[3]]) == ["", "x\n"]
    assert without_repeated_lines(empty(spark)).count() == line_members(empty(spark)).count() == 0


def test_hot_lines_keep_all_members(spark):
    docs = [(d, f"one line that all the texts hold\nown {d}") for d in range(3000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = line_members(df).filter("line = 0").collect()
    assert len(got) == 3000 and {r["class_doc_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_prefix_maxima():
    r = random.Random(3)
    tree, best = PrefixMax(20), [float("-inf")] * 20
    for k in range(200):
        place, score = r.randrange(20), r.random()
        tree.put(place, score, k)
        best[place] = max(best[place], score)
        at = r.randrange(20)
        assert tree.upto(at)[0] == max(best[: at + 1])


def test_chains_ascend_and_keep_every_match():
    r = random.Random(6)
    for _ in range(200):
        matches = [(r.randrange(60), r.randrange(60)) for _ in range(r.randint(1, 30))]
        found = chains(matches)
        assert sorted(m for c in found for m in c) == sorted(set(matches))
        for c in found:
            assert all(a < x and b < y for (a, b), (x, y) in zip(c, c[1:]))
    line = [(k * 8, 100 + k * 8 + (k > 5)) for k in range(12)]
    assert chains([*line, (500, 130), (3, 900)])[0] == line


def test_minimizers_are_the_first_smallest_of_each_window():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 4, 5, 9, 60):
        h = r.integers(0, 6, n).astype(np.uint64)
        starts = range(max(1, n - WINDOW + 1))
        assert minimizers(h).tolist() == sorted({k + int(h[k : k + WINDOW].argmin()) for k in starts})


def test_alignment_shortcut_agrees_with_the_alignment():
    r = np.random.default_rng(6)
    for _ in range(500):
        x = r.integers(0, 9, int(r.integers(10, 40)))
        y = np.delete(x, r.integers(0, len(x), int(r.integers(0, 4))))
        y[r.integers(0, len(y), int(r.integers(0, 9)))] = 9
        band = abs(len(x) - len(y)) + 30
        assert like(x, y, band) == (common_words(x, y, band) >= IDENTITY * len(x))


def test_ranges_that_touch_are_united():
    assert united([(5, 9), (0, 3), (3, 4), (6, 7), (9, 10)]) == [(0, 4), (5, 10)]
    assert united([]) == []


def test_common_words():
    import numpy as np

    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for a in x:
            now = [0]
            for j, b in enumerate(y, 1):
                now.append(row[j - 1] + 1 if a == b else max(row[j], now[-1]))
            row = now
        return row[-1]

    r = random.Random(8)
    for _ in range(500):
        x, y = ([r.randrange(4) for _ in range(r.randint(0, 12))] for _ in range(2))
        assert common_words(np.array(x, np.uint32), np.array(y, np.uint32), 99) == lcs(x, y)


def prose(r, n):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def covered(rows, doc_id):
    return {k for r in rows if r["doc_id"] == doc_id for k in range(r["start_word"], r["end_word"])}


def test_planted_passages(spark):
    r = random.Random(11)
    exact, fuzzy, whole = prose(r, 60), prose(r, 120), prose(r, 300)
    docs = [prose(r, r.randint(80, 300)) for _ in range(60)]
    places = {}
    for d in (3, 9, 17, 40, 41):
        at = r.randrange(60)
        docs[d][at:at] = exact
        places[d] = (at, at + 60)
    for d in (20, 30):
        at = r.randrange(60)
        copy = list(fuzzy)
        for k in range(10 + d % 3, 115, 25):
            copy[k] = f"edit{d}x{k}"
        docs[d][at:at] = copy
        places[d] = (at, at + 120)
    docs[50], docs[51] = list(whole), list(whole)
    texts = [(d, "  ".join(w)) for d, w in enumerate(docs)]
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    for d in (9, 17, 40, 41):
        lo, hi = places[d]
        assert len(covered(rows, d) & set(range(lo, hi))) >= 58
        assert any(3 in x["others"] for x in rows if x["doc_id"] == d)
    lo, hi = places[30]
    assert len(covered(rows, 30) & set(range(lo, hi))) >= 100
    assert covered(rows, 51) == set(range(300))
    assert {x["doc_id"] for x in rows} == {9, 17, 40, 41, 30, 51}
    for x in rows:
        text = texts[x["doc_id"]][1]
        assert words_of(text[x["start"] : x["end"]]) == words_of(text)[x["start_word"] : x["end_word"]]
        assert x["n_words"] == x["end_word"] - x["start_word"] >= MIN_WORDS


def test_passage_split_over_two_earlier_documents(spark):
    r = random.Random(12)
    passage = prose(r, 64)
    docs = [prose(r, 40) + passage[:32], passage[32:] + prose(r, 40), prose(r, 30) + passage, passage + prose(r, 9)]
    texts = [(d, " ".join(w)) for d, w in enumerate(docs)]
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert len(covered(rows, 3) & set(range(64))) >= 60


def test_exact_runs_of_the_table_are_found(spark):
    docs = sorted((r["doc_id"], words_of(r["text"])) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    rows = op7_repeated_passages(spark, SF_SMALL).collect()
    first, total, found = {}, 0, 0
    for d, w in docs:
        own = covered(rows, d)
        for k in range(len(w) - MIN_WORDS + 1):
            run = tuple(w[k : k + MIN_WORDS])
            if first.setdefault(run, d) != d:
                total += 1
                found += own >= set(range(k, k + MIN_WORDS))
    assert total and found >= 0.98 * total


def test_messy_passages(spark):
    rows = repeated_passages(messy(spark)).collect()
    assert {r["doc_id"] for r in rows} == {10} and rows[0]["others"] == [9] and rows[0]["n_words"] == 30_000
    assert repeated_passages(empty(spark)).count() == 0


def test_recall_of_fuzzy_passages(spark):
    """Passages with a share of their words substituted, one partner each; their ends stay."""
    r = random.Random(21)
    cases = [(n, percent) for n in (50, 55, 75, 100) for percent in (0, 5, 10, 15, 20) for _ in range(100)]
    docs = []
    for k, (n, percent) in enumerate(cases):
        passage = prose(r, n)
        copy = list(passage)
        for at in r.sample(range(1, n - 1), n * percent // 100):
            copy[at] = f"edit{k}x{at}"
        docs += [prose(r, 60) + passage + prose(r, 60), prose(r, 50) + copy + prose(r, 50)]
    texts = [(d, " ".join(w)) for d, w in enumerate(docs)]
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    found = Counter(cases[d // 2] for d in {x["doc_id"] for x in rows})
    print({c: found[c] for c in sorted(set(cases))})
    for x in rows:
        n, _ = cases[x["doc_id"] // 2]
        assert x["others"] == [x["doc_id"] - 1] and 45 <= x["start_word"] and x["end_word"] <= n + 55
    assert all(found[c] == 100 for c in cases if c[1] == 0)
    assert all(found[c] >= (97 if c[1] < 20 else 90) for c in cases if c[0] > 50)
    assert all(found[c] >= 90 for c in cases if c[1] < 20)


def test_a_passage_whose_phrases_stand_alone_in_earlier_documents(spark):
    """Every seed of the passage is also in an earlier document that has nothing else of it."""
    r = random.Random(31)
    passage = prose(r, 70)
    docs = [prose(r, 30) + passage[k : k + 9] + prose(r, 30) for k in range(62)]
    docs += [prose(r, 40) + passage + prose(r, 40), prose(r, 20) + passage + prose(r, 20)]
    texts = [(d, " ".join(w)) for d, w in enumerate(docs)]
    rows = repeated_passages(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert covered(rows, 63) >= set(range(22, 88))
    assert any(62 in x["others"] for x in rows if x["doc_id"] == 63)


def test_seeds_cut_between_tasks_and_other_surroundings_are_matched(spark):
    """Two seeds near each other in ever other surroundings; and one of many copies, cut anywhere."""
    rows = [(s, d, d % 5 + 9 * (s - 6), d * 65537 * s % 2**31) for d in range(600) for s in (6, 7)]
    rows += [(8, d, 3, 5) for d in range(300)]
    found = spark.createDataFrame(rows, "seed bigint, doc_id bigint, at int, sides int")
    got = {(x["a"], x["b"], x["at_a"], x["at_b"]) for x in star_matches(found).collect()}
    assert all(a < b for a, b, _, _ in got)
    for shift in (0, 9):
        assert {(a, b, a % 5 + shift, b % 5 + shift) for a in range(600) for b in range(a + 1, 600)} <= got
    assert {b for _, b, at_a, at_b in got if (at_a, at_b) == (3, 3)} >= set(range(1, 300))


def test_ends_of_many_passages_at_once():
    """Each end as a plain table of the alignment finds it, whatever else is aligned with it."""
    from quarry.llm.passages import BAND, extended

    def plain(x, y, cost):
        n = min(len(x), len(y))
        walk, best, at = 0, -1, 0
        for k in range(n):
            walk += 1 if x[k] == y[k] else -cost
            if walk >= max(best, 0):
                best, at = walk, k + 1
        x, y, top, end = x[at:], y[at:], 0, (0, 0)
        table = {(0, j): -cost * j for j in range(min(BAND, len(y)) + 1)}
        for i in range(1, len(x) + 1):
            for j in range(max(0, i - BAND), min(len(y), i + BAND) + 1):
                ways = [table[p] - cost for p in ((i - 1, j), (i, j - 1)) if p in table]
                if (i - 1, j - 1) in table:
                    ways.append(table[i - 1, j - 1] + (1 if x[i - 1] == y[j - 1] else -cost))
                table[i, j] = max(ways)
                if table[i, j] > top:
                    top, end = table[i, j], (i, j)
        return [at + end[0], at + end[1]]

    rng = random.Random(7)
    ends = [([], []), ([5], []), ([2**32 - 1] * 3, [2**32 - 1] * 3)]
    for _ in range(150):
        x = [rng.randrange(rng.choice([3, 40, 2**32])) for _ in range(rng.randrange(36))]
        y = list(x)
        for _ in range(rng.randrange(7)):
            at = rng.randrange(len(y) + 1)
            y[at : at + rng.randrange(2)] = [rng.randrange(40)] * rng.randrange(3)
        ends.append((x, y))
    for cost in (1, 4):
        found = extended([(np.array(x, np.uint32), np.array(y, np.uint32)) for x, y in ends], 30, cost)
        assert found.tolist() == [plain(x[:30], y[:30], cost) for x, y in ends]
