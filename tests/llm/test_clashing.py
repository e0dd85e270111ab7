"""Input columns with the names that operators use inside come through unchanged."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from quarry.llm.bpe import decode, encode
from quarry.llm.exact_dedup import drop_exact
from quarry.llm.line_dedup import line_members, without_repeated_lines
from quarry.llm.minhash_dedup import drop_near
from quarry.llm.mixing import mix_documents
from tests.llm.messy import messy

INTERNAL = [
    "row", "doc", "_row", "_lines", "_key", "_stay_id", "_stay_key", "_stay_digest", "_stay_rows", "_text_digest",
    "digest", "size", "component", "component_id", "kept", "_mix_row", "_mix_key", "_mix_size", "_mix_hash",
    "_mix_slice", "_mix_id", "_mix_cut", "_mix_open", "_mix_run", "_mix_copies", "_mix_copy", "tick`s", "a.dot",
]


def clashing(spark):
    """``messy`` documents, each internal name a column that tells its name and id."""
    made = [F.concat_ws(" ", F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in INTERNAL]
    return messy(spark).select("*", *made)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_drops_keep_the_callers_values(spark):
    docs = clashing(spark)
    given = rows(docs)
    for drop in (drop_exact, lambda d: drop_near(d, 5)):
        left = drop(docs)
        assert left.dtypes == docs.dtypes
        got = rows(left)
        assert got and not got - given
        plain = drop(messy(spark))
        assert rows(left.select(plain.columns)) == rows(plain)


def test_mix_keeps_the_callers_values(spark):
    docs = clashing(spark)
    mixed = mix_documents(docs)
    assert mixed.dtypes == docs.dtypes
    got = rows(mixed)
    assert got and set(got) <= set(rows(docs))
    plain = mix_documents(messy(spark))
    assert rows(mixed.select(plain.columns)) == rows(plain)


def test_lines_keep_the_callers_values(spark):
    docs = clashing(spark)
    left = without_repeated_lines(docs)
    assert left.dtypes == docs.dtypes
    others = [f"`{c.replace('`', '``')}`" for c in docs.columns if c != "text"]
    assert rows(left.select(others)) == rows(docs.select(others))
    assert rows(line_members(docs)) == rows(line_members(messy(spark)))


def test_tokens_keep_the_callers_values(spark):
    docs = clashing(spark)
    back = decode(encode(docs))
    assert back.columns == [*docs.columns, "ids", "decoded"]
    assert rows(back.drop("ids", "decoded")) == rows(docs)
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
