"""Data-quality checks (K01-K42). Each check yields a DataFrame of offenders;
an empty result is a pass. ``violations`` counts the offender rows, the way a
warehouse test reports "got N results":

* unique / unique_combination: one row per duplicated key (NULL keys ignored);
* not_null: one row per NULL;
* accepted_values: one row per distinct value outside the list (NULL passes);
* accepted_range: one row per value outside the range (NULL passes);
* relationships: one row per child row whose key has no parent (NULL passes);
* singular: the rows the check query returns.

Scale: every check is an aggregate or an anti join on keys reduced by partial
aggregation first; checks on one table that need no grouping share one scan
(one ``agg`` of ``count_if`` / ``count_distinct`` expressions).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.fixed import (
    CLAIM_STATUSES,
    CLAIM_TYPES,
    CURRENCIES,
    PAYMENT_METHODS,
    POLICY_STATUSES,
    PRODUCT_LINES,
)
from quarry.operators.joins import orphans

RESULT_COLUMNS = ["check_id", "target", "violations"]


# ------------------------------------------------------------ offender frames
def unique_offenders(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def unique_combination_offenders(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null_offenders(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values_offenders(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def range_predicate(column: str, min_value=None, max_value=None, inclusive: bool = True):
    """TRUE inside the range, NULL for a NULL value (which passes)."""
    c = F.col(column)
    conds = []
    if min_value is not None:
        conds.append(c >= min_value if inclusive else c > min_value)
    if max_value is not None:
        conds.append(c <= max_value if inclusive else c < max_value)
    pred = F.lit(True)
    for cond in conds:
        pred = pred & cond
    return pred


def accepted_range_offenders(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    return df.filter(~range_predicate(column, min_value, max_value, inclusive))


def relationship_offenders(
    child: DataFrame, column: str, parent: DataFrame, field_: str
) -> DataFrame:
    """Orphan child keys with their row counts."""
    return orphans(child, parent, column, field_)


# ------------------------------------------------------------ singular checks
def one_current_offenders(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys with a number of current rows other than one (zero is not seen)."""
    return (
        dim.filter(F.col("is_current"))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("current_rows"))
        .filter(F.col("current_rows") != 1)
    )


def contiguity_offenders(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    """Closed spans whose ``valid_to`` is not the next span's ``valid_from``."""
    w = Window.partitionBy(key).orderBy("scd_version")
    ordered = dim.select(
        key,
        "scd_version",
        "valid_from",
        "valid_to",
        F.lead("valid_from").over(w).alias("next_valid_from"),
    )
    return ordered.filter(
        F.col("valid_to").isNotNull() & (F.col("valid_to") != F.col("next_valid_from"))
    )


def silver_larger_offenders(reconciliation: DataFrame) -> DataFrame:
    """Streams where silver has more rows than bronze."""
    return reconciliation.filter(F.col("duplicates_removed") < 0)


def negative_loss_ratio_offenders(performance: DataFrame) -> DataFrame:
    """Policies with a negative loss ratio."""
    return performance.filter(F.col("loss_ratio") < 0).select("policy_id", "loss_ratio")


# ------------------------------------------------------------------- catalog
@dataclass(frozen=True)
class Check:
    check_id: str
    kind: str
    table: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    ref: tuple[str, str] | None = None  # (parent table, parent column)
    params: dict = field(default_factory=dict)

    @property
    def target(self) -> str:
        return f"{self.table}.{'+'.join(self.columns)}" if self.columns else self.table


_AG, _DIM, _POL = "silver_agents", "silver_dim_customer", "silver_policies"
_PAY, _CLM = "silver_premium_payments", "silver_claims"
_FP, _FC, _PERF = "gold_fct_premium_payments", "gold_fct_claims", "gold_policy_performance"
_REC, _DQ = "gold_rpt_reconciliation", "gold_rpt_data_quality"

CATALOG: list[Check] = [
    Check("K01", "unique", _AG, ("agent_id",)),
    Check("K02", "not_null", _AG, ("agent_id",)),
    Check("K03", "unique_combination", _DIM, ("customer_id", "scd_version")),
    Check("K04", "unique", _DIM, ("customer_sk",)),
    Check("K05", "not_null", _DIM, ("customer_sk",)),
    Check("K06", "not_null", _DIM, ("customer_id",)),
    Check("K07", "unique", _POL, ("policy_id",)),
    Check("K08", "not_null", _POL, ("policy_id",)),
    Check("K09", "not_null", _POL, ("customer_id",)),
    Check("K10", "relationships", _POL, ("customer_id",), ref=(_DIM, "customer_id")),
    Check("K11", "accepted_values", _POL, ("product_line",), PRODUCT_LINES),
    Check("K12", "accepted_values", _POL, ("currency",), CURRENCIES),
    Check("K13", "accepted_values", _POL, ("status",), POLICY_STATUSES),
    Check("K14", "unique", _PAY, ("payment_id",)),
    Check("K15", "not_null", _PAY, ("payment_id",)),
    Check("K16", "not_null", _PAY, ("policy_id",)),
    Check("K17", "relationships", _PAY, ("policy_id",), ref=(_POL, "policy_id")),
    Check("K18", "accepted_values", _PAY, ("currency",), CURRENCIES),
    Check("K19", "accepted_values", _PAY, ("method",), PAYMENT_METHODS),
    Check("K20", "unique", _CLM, ("claim_id",)),
    Check("K21", "not_null", _CLM, ("claim_id",)),
    Check("K22", "not_null", _CLM, ("policy_id",)),
    Check("K23", "relationships", _CLM, ("policy_id",), ref=(_POL, "policy_id")),
    Check("K24", "accepted_values", _CLM, ("status",), CLAIM_STATUSES),
    Check("K25", "accepted_values", _CLM, ("claim_type",), CLAIM_TYPES),
    Check("K26", "unique", _FP, ("payment_id",)),
    Check("K27", "not_null", _FP, ("payment_id",)),
    Check("K28", "relationships", _FP, ("policy_id",), ref=(_POL, "policy_id")),
    Check("K29", "unique", _FC, ("claim_id",)),
    Check("K30", "not_null", _FC, ("claim_id",)),
    Check("K31", "relationships", _FC, ("policy_id",), ref=(_POL, "policy_id")),
    Check("K32", "unique", _PERF, ("policy_id",)),
    Check("K33", "not_null", _PERF, ("policy_id",)),
    Check("K34", "accepted_range", _PERF, ("premium_collected",), params={"min_value": 0, "inclusive": True}),
    Check("K35", "unique", _REC, ("stream",)),
    Check("K36", "not_null", _REC, ("stream",)),
    Check("K37", "unique", _DQ, ("metric",)),
    Check("K38", "not_null", _DQ, ("metric",)),
    Check("K39", "singular", _DIM, params={"fn": "one_current"}),
    Check("K40", "singular", _DIM, params={"fn": "contiguity"}),
    Check("K41", "singular", _REC, params={"fn": "silver_not_larger"}),
    Check("K42", "singular", _PERF, params={"fn": "loss_ratio_non_negative"}),
]

SINGULAR: dict[str, Callable[[DataFrame], DataFrame]] = {
    "one_current": one_current_offenders,
    "contiguity": contiguity_offenders,
    "silver_not_larger": silver_larger_offenders,
    "loss_ratio_non_negative": negative_loss_ratio_offenders,
}

KINDS = ("unique", "not_null", "accepted_values", "accepted_range", "relationships",
         "unique_combination", "singular")


def offenders(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    df = tables[check.table]
    k = check.kind
    if k == "unique":
        return unique_offenders(df, check.columns[0])
    if k == "unique_combination":
        return unique_combination_offenders(df, check.columns)
    if k == "not_null":
        return not_null_offenders(df, check.columns[0])
    if k == "accepted_values":
        return accepted_values_offenders(df, check.columns[0], check.values)
    if k == "accepted_range":
        return accepted_range_offenders(df, check.columns[0], **check.params)
    if k == "relationships":
        parent, pcol = check.ref
        return relationship_offenders(df, check.columns[0], tables[parent], pcol)
    if k == "singular":
        return SINGULAR[check.params["fn"]](df)
    raise ValueError(f"unknown check kind {k}")


def _count_row(check: Check, off: DataFrame) -> DataFrame:
    n = F.sum("_rows") if check.kind == "relationships" else F.count(F.lit(1))
    return off.agg(
        F.lit(check.check_id).alias("check_id"),
        F.lit(check.target).alias("target"),
        F.coalesce(n.cast("long"), F.lit(0).cast("long")).alias("violations"),
    )


def _scan_group(checks: list[Check], df: DataFrame) -> DataFrame:
    """not_null / accepted_values / accepted_range on one table: one shared scan."""
    exprs = []
    for c in checks:
        col = F.col(c.columns[0])
        if c.kind == "not_null":
            e = F.count_if(col.isNull())
        elif c.kind == "accepted_values":
            e = F.count_distinct(F.when(~col.isin(list(c.values)), col))
        else:
            e = F.count_if(~range_predicate(c.columns[0], **c.params))
        exprs.append(e.cast("long").alias(c.check_id))
    agg = df.agg(*exprs)
    items = [
        F.struct(
            F.lit(c.check_id).alias("check_id"),
            F.lit(c.target).alias("target"),
            F.col(c.check_id).alias("violations"),
        )
        for c in checks
    ]
    return agg.select(F.explode(F.array(*items)).alias("r")).select("r.*")


SCAN_KINDS = ("not_null", "accepted_values", "accepted_range")


def check_results(
    tables: dict[str, DataFrame],
    kinds: Sequence[str] | None = None,
    ids: Sequence[str] | None = None,
) -> DataFrame:
    """``(check_id, target, violations)`` for the selected checks."""
    chosen = [
        c
        for c in CATALOG
        if (kinds is None or c.kind in kinds) and (ids is None or c.check_id in ids)
    ]
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in chosen:
        if c.kind in SCAN_KINDS:
            by_table.setdefault(c.table, []).append(c)
        else:
            parts.append(_count_row(c, offenders(c, tables)))
    for table, group in by_table.items():
        parts.append(_scan_group(group, tables[table]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RESULT_COLUMNS)


def failed(results: DataFrame) -> DataFrame:
    return results.filter(F.col("violations") > 0)
