"""Column-expression helpers (R01-R17). All are built-in Spark expressions."""

from quarry.functions.normalize import (
    batch_increment,
    batch_key,
    clean,
    days_between,
    month_add,
    month_floor,
    surrogate_key,
    token,
    yyyymm,
)

__all__ = [
    "token",
    "clean",
    "yyyymm",
    "batch_key",
    "batch_increment",
    "days_between",
    "month_add",
    "month_floor",
    "surrogate_key",
]
