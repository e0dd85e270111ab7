"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, id bigint, n bigint"
LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew a strong potion near the old mill"


def rows() -> list[tuple]:
    texts = [
        PROSE,
        PROSE + "  ",
        PROSE.replace("potion", "Potion"),
        None,
        "",
        " \t\n ",
        "a",
        "a b",
        "A  B",
        LONG,
        LONG + " end",
        "Ünïcode ß \x1c \x85   text 日本語 <|endoftext|> tail",
        PROSE + "\n" + PROSE,
    ]
    sources = ["web", "web", None, "", "books", "web", "\U0001f600", "é"]
    made = [
        (k, t, "en" if k % 2 else None, sources[k % len(sources)], None, "clash", k * 7, -1) for k, t in enumerate(texts)
    ]
    made += [made[0], made[0]]  # rows that repeat a document
    made += [(0, "another text under the same id", "en", "web", 3, None, None, None)]
    made += [(None, PROSE, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return made


def messy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), DOCS)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()
