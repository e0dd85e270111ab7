"""Lazy construction of all layers from one input (driver tables or a landing folder).

Each table's plan is built on first access only, so a query that needs two
silver tables does not analyse the other eight.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import gold, silver
from quarry.session import shared_dir
from quarry.sources import bronze, overlay, parquet


class LazyTables(Mapping):
    """A read-only mapping whose values are built (once) on first access."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]) -> None:
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def _builder(v: DataFrame | Callable[[], DataFrame]) -> Callable[[], DataFrame]:
    return (lambda: v) if isinstance(v, DataFrame) else v


def _stored(tables: LazyTables) -> LazyTables:
    def builder(name: str) -> DataFrame:
        df = tables[name]
        path = f"{shared_dir(df.sparkSession, 'layers')}/{name}"
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)

    return LazyTables({n: (lambda n=n: builder(n)) for n in tables})


class Layers:
    """Bronze, silver and gold over five raw extracts (frames or frame builders).

    ``stored``: each silver table is computed once, on first access, and kept as files in
    the shared folder, for consumers that read many of them many times, some columns each.
    Gold tables are plans over these files.
    """

    def __init__(
        self, raw: Mapping[str, DataFrame | Callable[[], DataFrame]], stored: bool = False
    ) -> None:
        self.raw = raw if isinstance(raw, LazyTables) else LazyTables(
            {name: _builder(v) for name, v in raw.items()}
        )
        r = self.raw
        self.bronze = LazyTables({n: (lambda n=n: bronze.bronze(r[n], n)) for n in r})
        b = self.bronze
        self.silver = LazyTables(
            {
                "silver_agents": lambda: silver.silver_agents(b["agents"]),
                "silver_dim_customer": lambda: silver.silver_dim_customer(b["customer_snapshots"]),
                "silver_policies": lambda: silver.silver_policies(b["policies"]),
                "silver_premium_payments": lambda: silver.silver_premium_payments(b["premium_payments"]),
                "silver_claims": lambda: silver.silver_claims(b["claims"]),
            }
        )
        if stored:
            self.silver = _stored(self.silver)
        s = self.silver
        self.gold = LazyTables(
            {
                "gold_fct_premium_payments": lambda: gold.gold_fct_premium_payments(
                    s["silver_premium_payments"], s["silver_policies"], s["silver_agents"],
                    s["silver_dim_customer"],
                ),
                "gold_fct_claims": lambda: gold.gold_fct_claims(
                    s["silver_claims"], s["silver_policies"], s["silver_agents"]
                ),
                "gold_policy_performance": lambda: gold.gold_policy_performance(
                    s["silver_policies"], s["silver_premium_payments"], s["silver_claims"]
                ),
                "gold_rpt_reconciliation": lambda: gold.gold_rpt_reconciliation(
                    b["premium_payments"], s["silver_premium_payments"], b["claims"], s["silver_claims"]
                ),
                "gold_rpt_data_quality": lambda: gold.gold_rpt_data_quality(
                    s["silver_premium_payments"], s["silver_claims"], s["silver_dim_customer"]
                ),
            }
        )

    def tables(self) -> LazyTables:
        """Silver and gold together (what the checks read)."""
        both = {n: (lambda n=n: self.silver[n]) for n in self.silver}
        both.update({n: (lambda n=n: self.gold[n]) for n in self.gold})
        return LazyTables(both)


def from_driver_tables(spark: SparkSession, sf_dir: str, stored: bool = False) -> Layers:
    """Layers over the overlay of the driver's TPC-H-like tables."""
    return Layers({n: (lambda fn=fn: fn(spark, sf_dir)) for n, fn in overlay.EXTRACTS.items()}, stored)


def from_landing(spark: SparkSession, root: str) -> Layers:
    """Layers over a landing folder ``<root>/<table>/*.parquet``."""
    return Layers({n: (lambda n=n: parquet.read_raw(spark, root, n)) for n in overlay.EXTRACTS})
