from __future__ import annotations

import hashlib
import re
import uuid

import duckdb
from pyspark.sql import functions as F

from quarry.llm.exact_dedup import OP8_SQL, DigestIndex, drop_exact, exact_decisions, op8_exact_dedup
from tests.conftest import SF_MID
from tests.llm.messy import empty, messy


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def expected(docs):
    groups = {}
    for r in docs:
        groups.setdefault(squeezed(r["text"]), []).append(r)
    out = []
    for text, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))["doc_id"]
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(r["doc_id"], best, len(rows), r["doc_id"] == best, sha) for r in rows]
    return sorted(out, key=str)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_MID}/documents.parquet'")
    columns = "doc_id, keep_id, group_size, kept, text_sha256"
    wanted = sorted(con.execute(f"select {columns} from ({OP8_SQL})").fetchall())
    assert sorted(map(tuple, op8_exact_dedup(spark, SF_MID).collect())) == wanted


def test_defined_cases(spark):
    docs = messy(spark)
    assert sorted(map(tuple, exact_decisions(docs).collect()), key=str) == expected(docs.collect())
    assert exact_decisions(empty(spark)).count() == 0


def test_drop_keeps_one_row_of_each_text(spark):
    docs = messy(spark)
    kept = drop_exact(docs)
    assert kept.columns == docs.columns
    texts = [squeezed(r["text"]) for r in kept.collect()]
    assert sorted(texts) == sorted({squeezed(r["text"]) for r in docs.collect()})
    assert drop_exact(empty(spark)).count() == 0


def test_index_grows_and_adding_again_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    old, new = docs.filter("doc_id < 400"), docs.filter("doc_id >= 400")
    index = DigestIndex(spark, f"test_index_{uuid.uuid4().hex}", buckets=4)
    try:
        index.add(old)
        first = sorted(map(tuple, index.add(new).collect()))
        size = index.entries().count()
        assert sorted(map(tuple, index.add(new).collect())) == first
        assert index.entries().count() == size == docs.select(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).distinct().count()
        before = {squeezed(r["text"]) for r in old.collect()}
        ids = {r["doc_id"]: squeezed(r["text"]) for r in docs.collect()}
        for doc_id, keep_id, _, kept, _ in first:
            assert ids[doc_id] == ids[keep_id] and kept == (doc_id == keep_id)
            assert (keep_id < 400) == (ids[doc_id] in before)
        assert DigestIndex(spark, index.name, buckets=9).buckets == 4
    finally:
        index.drop()


def test_plan_is_native_and_spares_the_index_a_shuffle(spark):
    index = DigestIndex(spark, f"test_index_{uuid.uuid4().hex}", buckets=4)
    try:
        index.add(spark.createDataFrame([(k, str(k)) for k in range(50)], "doc_id bigint, text string"))
        side = index.entries().select("digest").hint("merge")
        plan = spark.createDataFrame([(b"a",)], "digest binary").repartition(4, "digest").join(side, "digest", "left_anti")
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and text.count("Exchange hashpartitioning") <= 1 and "Python" not in text
        assert "Bucketed: true" in text
    finally:
        index.drop()


def test_hot_group_is_not_shuffled(spark):
    rows = [(k, "same text" if k % 2 else f"text {k}") for k in range(4000)]
    got = exact_decisions(spark.createDataFrame(rows, "doc_id bigint, text string"))
    hot = got.filter("group_size = 2000").agg(F.min("keep_id"), F.max("keep_id"), F.count(F.lit(1)), F.sum(F.col("kept").cast("int")))
    assert tuple(hot.first()) == (1, 1, 2000, 1)
