"""Bronze layer (S02-S07): one-to-one views over the raw extracts.

A bronze model only names its columns. A missing source column fails at
analysis time; an extra one is ignored. Views are lazy, so bronze is recomputed
on every read and pruned to the columns a consumer needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.schemas import RAW_SCHEMAS

# Column lists per bronze view, in extract order.
BRONZE_COLUMNS: dict[str, list[str]] = {
    name: [f.name for f in schema.fields] for name, schema in RAW_SCHEMAS.items()
}


def bronze(raw: DataFrame, name: str) -> DataFrame:
    return raw.select(*BRONZE_COLUMNS[name])


def register_views(layer: dict[str, DataFrame], prefix: str = "bronze_") -> None:
    """Expose a layer as temp views (the view materialisation)."""
    for name, df in layer.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
