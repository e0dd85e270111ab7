from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm.sharding import SHARDS, into_shards, numbered, op11_shards
from tests.conftest import SF_MID
from tests.llm.messy import empty, messy


def by_hand(rows: list[tuple], shards: int, seed: int = 11) -> Counter:
    """(doc_id, source, size, crc, shard, slot) by sorting everything in one place."""

    def low(x):  # nulls first
        return (x is not None, x)

    made = []
    for doc_id, text, source in rows:
        data = (text or "").encode()
        seeded = ":".join([str(seed)] + ([] if doc_id is None else [str(doc_id)]))
        tie = (hashlib.md5(seeded.encode()).hexdigest(), low(doc_id), zlib.crc32(data), len(data) + 1)
        made.append((tie, source, (doc_id, source, len(data) + 1, zlib.crc32(data))))
    of = defaultdict(list)
    for m in made:
        of[m[1]].append(m)
    line = []
    for source, members in of.items():
        for rank, m in enumerate(sorted(members, key=lambda m: m[0])):
            line.append(((2 * rank + 1) / (2 * len(members)), m[0], low(source and source.encode()), m[2]))
    n, out, slots = len(rows), Counter(), Counter()
    for place, (*_, row) in enumerate(sorted(line, key=lambda x: x[:3])):
        shard = place * shards // n
        out[(*row, shard, slots[shard])] += 1
        slots[shard] += 1
    return out


@pytest.mark.parametrize("shards", [1, 3, 16, 50])
def test_messy_rows_against_sorting_in_one_place(spark, shards):
    docs = messy(spark).withColumns({c: F.lit(-1) for c in ("shard", "slot", "place", "rank", "size", "_part", "_rows")})
    got = into_shards(docs, shards).select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    plain = [(r["doc_id"], r["text"], r["source"]) for r in messy(spark).collect()]
    assert Counter(map(tuple, got.collect())) == by_hand(plain, shards)


def test_hot_source_spans_partitions_and_shards_match_the_mixture(spark):
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "repeat('x', int(id % 50)) as text",
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then concat('s', id % 10) end as source",
    )
    rows = into_shards(docs, 16).collect()
    per_shard = Counter(r["shard"] for r in rows)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    total = Counter(r["source"] for r in rows)
    mix = Counter((r["shard"], r["source"]) for r in rows)
    for s in range(16):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(per_shard[s]))
        for name, n in total.items():
            assert abs(mix[s, name] - n / 16) <= 2, (s, name)
    placed = numbered(docs.select("doc_id", "source"), ["source", "doc_id"], ["source"])
    wide = placed.withColumn("p", F.spark_partition_id()).filter("source = 'hot'").select("p").distinct().count()
    assert wide > 1


def test_empty_table_and_refused_counts(spark):
    assert into_shards(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        into_shards(empty(spark), 0)


def test_query_covers_every_document_and_reruns_agree(spark):
    first, again = (sorted(map(tuple, op11_shards(spark, SF_MID).collect()), key=str) for _ in range(2))
    assert first == again
    assert len(first) == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert {r[4] for r in first} == set(range(SHARDS))
