"""Fuzzy repair against a domain table by deletion neighbourhoods.

Two strings within d edits of each other become equal by deleting at most d characters
from each, and so do their first PREFIX characters. A domain value is therefore indexed
under every string that deleting up to d of its first PREFIX characters leaves; a raw
token's own such strings are joined with the index by equality (a hash join on the
variant), and only the values that meet are compared, by a Levenshtein distance that is
given up beyond d. Work grows with tokens and matches, not with tokens x domain, and the
number of variants of a string is bounded by PREFIX whatever its length.

A domain is a table (domain, value), of any size; nothing of it is collected. Raw values
are reduced to distinct ones with their counts first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.normalize import token

PREFIX = 12


def deletion_variants(text: Column, max_distance: int, prefix: int = PREFIX) -> Column:
    """Array of what is left of the first ``prefix`` characters when up to ``max_distance`` are deleted."""
    variants = F.array(F.substring(text, 1, prefix))

    def without_one(s: Column) -> Column:
        gap = F.sequence(F.lit(1), F.greatest(F.char_length(s), F.lit(1)))
        return F.transform(gap, lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.lit(prefix))))

    for _ in range(max_distance):
        variants = F.array_distinct(F.concat(variants, F.flatten(F.transform(variants, without_one))))
    return variants


def deletion_index(domain: DataFrame, max_distance: int = 2, prefix: int = PREFIX) -> DataFrame:
    """(domain, value, variant) of a table (domain, value); write it once to use it often."""
    values = domain.select("domain", "value").filter(F.col("value").isNotNull()).distinct()
    return values.withColumn("variant", F.explode(deletion_variants(F.col("value"), max_distance, prefix)))


def nearest_values(tokens: DataFrame, index: DataFrame, max_distance: int = 2, prefix: int = PREFIX) -> DataFrame:
    """(domain, token, distance, value): the closest domain value of each distinct token that
    has one within ``max_distance``; ties go to the alphabetically first."""
    asked = tokens.select("domain", "token").filter(F.col("token").isNotNull()).distinct()
    asked = asked.withColumn("variant", F.explode(deletion_variants(F.col("token"), max_distance, prefix)))
    # Strings whose lengths differ by more can't be that close.
    near = F.abs(F.char_length("token") - F.char_length("value")) <= max_distance
    met = asked.join(index, ["domain", "variant"]).filter(near).select("domain", "token", "value").distinct()
    distance = F.levenshtein("token", "value", max_distance)  # -1 beyond it
    found = met.select("domain", "token", F.struct(distance.alias("distance"), "value").alias("best"))
    found = found.filter("best.distance >= 0").groupBy("domain", "token").agg(F.min("best").alias("best"))
    return found.select("domain", "token", "best.distance", "best.value")


def repair_by_index(raw: DataFrame, index: DataFrame, max_distance: int = 2, prefix: int = PREFIX) -> DataFrame:
    """``raw`` (domain, raw_value, ...) with ``repaired_value`` and ``distance``.

    The rule is that of ``extras.best_match``: ``upper(trim(raw_value))`` is repaired to the
    closest value within ``max_distance`` edits and a third of its length. ``distance`` is
    NULL where no value is within ``max_distance``.
    """
    rows = raw.withColumn("token", token("raw_value"))
    best = nearest_values(rows.select("domain", "token"), index, max_distance, prefix)
    close = F.col("distance") * 3 <= F.char_length("token")
    return (
        rows.join(best, ["domain", "token"], "left")
        .withColumn("repaired_value", F.when(close, F.col("value")))
        .drop("token", "value")
    )
