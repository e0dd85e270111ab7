"""Command line: full build and report reads.

    python -m quarry build  --warehouse DIR (--driver-tables SF_DIR | --landing DIR) [--no-gate]
    python -m quarry report --warehouse DIR

``build`` runs bronze -> silver -> checks -> gold -> checks and prints the check
results; ``report`` prints the reconciliation, the scorecard and a sample SCD2
history from the written gold/silver folders (works from a new process).
"""

from __future__ import annotations

import argparse
import sys

from quarry.plans import gold, warehouse
from quarry.plans.layers import from_driver_tables, from_landing
from quarry.session import get_session


def _build(args) -> int:
    spark = get_session(app_name="quarry-build")
    layers = (
        from_landing(spark, args.landing) if args.landing else from_driver_tables(spark, args.driver_tables)
    )
    try:
        res = warehouse.build(spark, layers, args.warehouse, gate=not args.no_gate)
    except warehouse.CheckFailure as e:
        print(f"build stopped: {e}", file=sys.stderr)
        return 1
    res.checks.orderBy("check_id").show(50, truncate=False)
    return 0


def _report(args) -> int:
    spark = get_session(app_name="quarry-report")

    paths = warehouse.published(spark, args.warehouse)

    def table(layer: str, name: str):
        return spark.read.parquet(paths[layer, name])

    print("Pipeline reconciliation (bronze -> silver)")
    table("gold", "gold_rpt_reconciliation").orderBy("stream").show(truncate=False)
    print("Data-quality scorecard")
    table("gold", "gold_rpt_data_quality").show(40, truncate=False)
    print("Sample SCD2 history (one customer, multiple versions)")
    gold.sample_history(table("silver", "silver_dim_customer")).show(40, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarry")
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="full build with check gates")
    b.add_argument("--warehouse", required=True)
    src = b.add_mutually_exclusive_group(required=True)
    src.add_argument("--driver-tables", help="folder of driver tables (overlay input)")
    src.add_argument("--landing", help="landing folder <root>/<table>/*.parquet")
    b.add_argument("--no-gate", action="store_true", help="build gold even if silver checks fail")
    r = sub.add_parser("report", help="print the gold reports")
    r.add_argument("--warehouse", required=True)
    args = p.parse_args(argv)
    return _build(args) if args.cmd == "build" else _report(args)


if __name__ == "__main__":
    sys.exit(main())
