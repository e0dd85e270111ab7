"""Full build: bronze views -> silver tables -> gold tables, gated by checks.

Write, audit, publish: a build writes every model into a folder of its own run,
``<warehouse>/runs/<run>/<layer>/<table>``, and runs the checks on what it wrote. Only
when all of them pass is the run published: one commit to ``<warehouse>/published``
names the paths of all its tables, and the tables of the layers' catalog databases (S09)
are pointed at them. A failed check or a lost write leaves the published tables as they
were, byte for byte; the failed run's folder stays for inspection. A re-run gives
identical tables (S12), and an earlier run can be published again.

Facts are deliberately *not* bucketed on ``policy_id``: one policy may carry a
large share of all rows, and a bucketed layout would pin that share to one
bucket file and one writer/reader task. Gold plans instead shuffle facts with
partial aggregation first (M13) and let AQE split skewed join partitions (M11,
M12).

Precondition: the snapshot key ``(customer_id, snapshot_month)`` must be
unique. That bounds every SCD2 window partition by the number of periods, so
no customer can pile rows into one task.

Checks: silver checks gate the gold build; gold checks run on the written gold
tables. Results ``(check_id, target, violations)`` are written once per layer
(``dq_check_results``) and read back, never recomputed. Models of one layer are
independent and are written as concurrent jobs.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.fixed import SCORECARD_METRICS
from quarry.operators import checks
from quarry.operators.contracts import enforce
from quarry.plans import gold
from quarry.plans.layers import Layers
from quarry.schemas import CONTRACTS
from quarry.sources.bronze import register_views
from quarry.sources.parquet import append_log, delete_folder, newest, read_log, table_path

SNAPSHOT_KEY = ["customer_id", "snapshot_month"]
SILVER_CHECKS = [c.check_id for c in checks.CATALOG if c.table.startswith("silver_")]
GOLD_CHECKS = [c.check_id for c in checks.CATALOG if c.table.startswith("gold_")]


class CheckFailure(RuntimeError):
    pass


@dataclass
class BuildResult:
    warehouse: str
    databases: dict[str, str]
    tables: dict[str, str]
    checks: DataFrame
    run: str


PUBLISHED_SCHEMA = "version long, run string, tables array<struct<layer:string,name:string,path:string>>"


def _database(spark: SparkSession, warehouse: str, layer: str, prefix: str) -> str:
    name = f"{prefix}{layer}"
    location = table_path(warehouse, layer, "").rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


# Report tables with a fixed, tiny row count (2 streams, 10 metrics, 42 checks):
# written as one file each (S11), which also keeps the report order on read.
CHECK_RESULTS = "dq_check_results"
SINGLE_FILE = {"gold_rpt_reconciliation", "gold_rpt_data_quality", CHECK_RESULTS}


def save_table(df: DataFrame, ident: str) -> str:
    """Full-refresh table write."""
    name = ident.split(".")[-1]
    if name in CONTRACTS:  # S13: contract-enforced write
        enforce(df, CONTRACTS[name], name)
    w = df.coalesce(1) if name in SINGLE_FILE else df
    w.write.mode("overwrite").format("parquet").saveAsTable(ident)
    return ident


def _gate(results: DataFrame, stage: str) -> None:
    # At most 42 rows (one per declared check): a bounded collect.
    bad = [r for r in checks.failed(results).collect()]
    if bad:
        detail = ", ".join(f"{r.check_id} {r.target}={r.violations}" for r in bad)
        raise CheckFailure(f"{stage} checks failed: {detail}")


def write_model(df: DataFrame, path: str) -> str:
    """One model written into the folder of a run, its contract enforced."""
    name = path.rsplit("/", 1)[-1]
    if name in CONTRACTS:
        enforce(df, CONTRACTS[name], name)
    out = df.coalesce(1) if name in SINGLE_FILE else df
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def _write_all(models: dict[str, DataFrame], folder: str, threads: int) -> dict[str, str]:
    """Write independent models of one layer as concurrent Spark jobs."""
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        futures = {name: pool.submit(write_model, df, f"{folder}/{name}") for name, df in models.items()}
        return {name: f.result() for name, f in futures.items()}


def published(spark: SparkSession, warehouse: str, run: str | None = None) -> dict[tuple[str, str], str]:
    """Paths by (layer, table) of the published tables, or of an earlier published ``run``."""
    log = read_log(spark, f"{warehouse.rstrip('/')}/published", PUBLISHED_SCHEMA)
    row = newest(log if run is None else log.filter(F.col("run") == run))
    return {(t.layer, t.name): t.path for t in row.tables} if row else {}


def publish(
    spark: SparkSession, warehouse: str, run: str, paths: dict[tuple[str, str], str], db_prefix: str = ""
) -> tuple[dict[str, str], dict[str, str]]:
    """Make ``paths`` by (layer, table) the live tables; databases by layer and idents by table.

    The commit is one row of the log, for all tables at once. Catalog tables follow it one
    by one (metadata only); a publish that is cut off there is completed by another one.
    """
    root = f"{warehouse.rstrip('/')}/published"
    last = newest(read_log(spark, root, PUBLISHED_SCHEMA))
    tables = [(layer, name, path) for (layer, name), path in paths.items()]
    append_log(spark, root, PUBLISHED_SCHEMA, ((last.version if last else 0) + 1, run, tables))
    databases, idents = {}, {}
    for layer, name, path in tables:
        databases.setdefault(layer, _database(spark, warehouse, layer, db_prefix))
        ident = f"{databases[layer]}.{name}"
        schema = spark.read.parquet(path).schema
        if spark.catalog.tableExists(ident) and spark.table(ident).schema == schema:
            spark.sql(f"ALTER TABLE {ident} SET LOCATION '{path}'")
            spark.catalog.refreshTable(ident)
        else:
            # External: dropping the old definition leaves its files alone.
            spark.sql(f"DROP TABLE IF EXISTS {ident}")
            spark.catalog.createTable(ident, path=path, source="parquet")
        if name != CHECK_RESULTS:
            idents[name] = ident
    return databases, idents


def rollback(spark: SparkSession, warehouse: str, run: str, db_prefix: str = "") -> dict[str, str]:
    """Publish an earlier published run again; idents by table."""
    paths = published(spark, warehouse, run)
    if not paths:
        raise ValueError(f"run {run} was never published")
    return publish(spark, warehouse, run, paths, db_prefix)[1]


def build(
    spark: SparkSession,
    layers: Layers,
    warehouse: str,
    db_prefix: str = "",
    gate: bool = True,
    threads: int = 4,
) -> BuildResult:
    """Write, audit and publish silver and gold. Models of one layer do not depend on each
    other, so up to ``threads`` of them run as concurrent jobs (the scheduler interleaves
    their tasks); layers run in dependency order with a check gate between. With ``gate``,
    nothing is published unless every check passes."""
    register_views(layers.bronze)  # S07: bronze stays a view
    dup = checks.unique_combination_offenders(layers.bronze["customer_snapshots"], SNAPSHOT_KEY)
    if gate and dup.limit(1).count():
        raise CheckFailure("customer_snapshots: (customer_id, snapshot_month) is not unique")
    run = uuid.uuid4().hex[:12]
    root = f"{warehouse.rstrip('/')}/runs/{run}"
    paths: dict[tuple[str, str], str] = {}

    def audited(layer: str, models: dict[str, DataFrame], ids: list[str], known: dict[str, DataFrame]):
        """The written models of a layer, after their checks; results are written once and read back."""
        written = _write_all(models, f"{root}/{layer}", threads)
        tables = known | {name: spark.read.parquet(path) for name, path in written.items()}
        results = write_model(checks.check_results(tables, ids=ids), f"{root}/{layer}/{CHECK_RESULTS}")
        paths.update({(layer, name): path for name, path in (written | {CHECK_RESULTS: results}).items()})
        if gate:
            _gate(spark.read.parquet(results), layer)
        return tables

    silver = audited("silver", layers.silver, SILVER_CHECKS, {})
    audited("gold", gold.gold_layer(layers.bronze, silver), GOLD_CHECKS, silver)
    dbs, tables = publish(spark, warehouse, run, paths, db_prefix)
    results = [spark.read.parquet(paths[layer, CHECK_RESULTS]) for layer in ("silver", "gold")]
    return BuildResult(warehouse, dbs, tables, results[0].unionByName(results[1]), run)


def drop(spark: SparkSession, result: BuildResult) -> None:
    """Drop the tables, databases and files of a build that nothing reads any more."""
    for name in result.databases.values():
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    delete_folder(spark, f"{result.warehouse.rstrip('/')}/runs/{result.run}")


def report(spark: SparkSession, result: BuildResult) -> dict[str, DataFrame]:
    """The report reads (reconciliation by stream, scorecard in metric order)."""
    rec = spark.table(result.tables["gold_rpt_reconciliation"]).orderBy("stream")
    dq = spark.table(result.tables["gold_rpt_data_quality"])
    dq = dq.orderBy(F.array_position(F.lit(list(SCORECARD_METRICS)), F.col("metric")))
    hist = gold.sample_history(spark.table(result.tables["silver_dim_customer"]))
    return {"reconciliation": rec, "data_quality": dq, "sample_history": hist}
