"""Schema contracts (C01, C02): fail before a write if a column is dropped,
renamed, added or retyped. Names and types are compared in order; nullability
is ignored (Spark infers it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class ContractError(ValueError):
    pass


def contract_diff(actual: StructType, expected: StructType) -> list[str]:
    """Human-readable differences; empty when the contract holds."""
    problems: list[str] = []
    act = [(f.name, f.dataType) for f in actual.fields]
    exp = [(f.name, f.dataType) for f in expected.fields]
    act_names = {n for n, _ in act}
    exp_names = {n for n, _ in exp}
    for n in [n for n, _ in exp if n not in act_names]:
        problems.append(f"missing column {n}")
    for n in [n for n, _ in act if n not in exp_names]:
        problems.append(f"unexpected column {n}")
    act_types = dict(act)
    for n, t in exp:
        if n in act_types and act_types[n] != t:
            problems.append(f"column {n}: expected {t.simpleString()}, got {act_types[n].simpleString()}")
    if not problems and [n for n, _ in act] != [n for n, _ in exp]:
        problems.append("column order differs: " + ", ".join(n for n, _ in act))
    return problems


def enforce(df: DataFrame, expected: StructType, name: str = "model") -> DataFrame:
    """Return ``df`` unchanged if it satisfies ``expected``; raise otherwise.

    Only the analysed schema is inspected: no job runs.
    """
    problems = contract_diff(df.schema, expected)
    if problems:
        raise ContractError(f"contract of {name} violated: " + "; ".join(problems))
    return df
