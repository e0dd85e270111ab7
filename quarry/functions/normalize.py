"""Scalar helpers used by silver and gold.

Every helper returns a built-in Column expression, so it stays inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.fixed import SURROGATE_NULL_TOKEN, SURROGATE_SEPARATOR

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Spaces of any script at either end (a non-breaking space too); tabs and line ends stay.
OUTER_SPACES = r"^\p{Zs}+|\p{Zs}+$"


def clean(c: ColumnOrName) -> Column:
    """``trim`` only (names, occupation). Strips spaces, Unicode ones included."""
    c = _col(c)
    # Text of one byte per character has no space but the ASCII one: no regular expression.
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.trim(c)).otherwise(F.regexp_replace(c, OUTER_SPACES, ""))


def token(c: ColumnOrName) -> Column:
    """Canonical categorical token, ``upper(trim(x))``."""
    return F.upper(clean(c))


def yyyymm(d: ColumnOrName) -> Column:
    """Integer ``YYYYMM`` of a date (NULL for NULL)."""
    d = _col(d)
    return F.year(d) * 100 + F.month(d)


def batch_key(d: ColumnOrName) -> Column:
    """Batch label of an ingest day, as ``bigint``."""
    return yyyymm(d).cast("long")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end`` (may be negative), ``bigint``."""
    return F.datediff(_col(end), _col(start)).cast("long")


def month_floor(d: ColumnOrName) -> Column:
    """First day of the month."""
    return F.trunc(_col(d), "month")


def month_add(d: ColumnOrName, n: ColumnOrName | int) -> Column:
    """First of month of ``d`` plus ``n`` months."""
    n = F.lit(n) if isinstance(n, int) else _col(n)
    return F.add_months(month_floor(d), n)


def batch_increment(batch: ColumnOrName, n: ColumnOrName | int = 1) -> Column:
    """Move a ``YYYYMM`` label by ``n`` months, rolling over year ends."""
    b = _col(batch).cast("long")
    first = F.make_date((b / 100).cast("int"), (b % 100).cast("int"), F.lit(1))
    n = F.lit(n) if isinstance(n, int) else _col(n)
    return batch_key(F.add_months(first, n))


def surrogate_key(*cols: ColumnOrName) -> Column:
    """md5 over the text of each column, NULL-tokened, '-'-separated."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))
