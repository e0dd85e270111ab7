"""S01 and the sinks S08-S13: parquet landing areas and layer tables.

Landing layout: ``<root>/<table>/*.parquet`` (one or more files per batch, in
place). Adding a batch file is additive: the next read sees it. Schemas are
declared, never inferred.

Layer tables live under ``<warehouse>/<layer>/<table>`` (S09): the layer name is
the namespace (a catalog database per layer, see ``plans.warehouse``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.normalize import batch_key
from quarry.schemas import RAW_SCHEMAS

LAYERS = ("bronze", "silver", "gold")
BATCH_PARTITION = "batch_key"


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every parquet file under ``<root>/<name>/`` with the declared schema."""
    return (
        spark.read.schema(RAW_SCHEMAS[name])
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(f"{root.rstrip('/')}/{name}")
    )


def table_path(warehouse: str, layer: str, name: str) -> str:
    """``<warehouse>/<layer>/<name>``; the layer is a literal namespace."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{warehouse.rstrip('/')}/{layer}/{name}"


#: A table of more rows than this is refused, not squeezed through one task.
SINGLE_FILE_ROWS = 1_000_000


def write_single_file(df: DataFrame, path: str, max_rows: int = SINGLE_FILE_ROWS) -> str:
    """A small master as one file. A table of over ``max_rows`` rows is an error."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows: write this table with many files")
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def write_batches(
    df: DataFrame, path: str, date_col: str | None = None, full_refresh: bool = False
) -> str:
    """One folder per batch; the batch column also stays inside the files.

    ``partitionBy`` moves the partition column into the path, so the sink
    partitions on a copy (``batch_key``) and keeps ``_batch`` in the data. With
    ``date_col`` the label is derived from a date (``YYYYMM``). Rows are
    clustered by batch with the ``rebalance`` hint, so each task writes few
    files while AQE still splits a batch that holds a large share of the rows.
    Batches that ``df`` does not hold stay as they are, unless ``full_refresh``
    (S12) replaces the whole landing folder.
    """
    label = batch_key(F.col(date_col)) if date_col else F.col("_batch")
    out = df.withColumn(BATCH_PARTITION, label)
    (
        out.hint("rebalance", BATCH_PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if full_refresh else "dynamic")
        .partitionBy(BATCH_PARTITION)
        .parquet(path)
    )
    return path


def read_batches(spark: SparkSession, path: str, schema, batches: list[int] | None = None) -> DataFrame:
    """Read a batch-partitioned table; a batch list prunes folders at planning time."""
    from pyspark.sql.types import LongType, StructField, StructType

    full = StructType(list(schema.fields) + [StructField(BATCH_PARTITION, LongType(), True)])
    df = spark.read.schema(full).parquet(path)
    if batches is not None:
        df = df.filter(F.col(BATCH_PARTITION).isin([int(b) for b in batches]))
    return df.drop(BATCH_PARTITION)


def append_log(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """Commit ``row`` to a log: a folder of Parquet files, one per commit. Whatever a row
    names has to be complete before; readers see the commit when its file appears."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All commits of a log; none if nothing was committed yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def newest(log: DataFrame, by: str = "version"):
    """The newest commit of a log as a row, or None."""
    return next(iter(log.orderBy(F.desc(by)).limit(1).collect()), None)


def exists(spark: SparkSession, path: str) -> bool:
    """True if something lies at ``path``, in whatever store Spark reads it from."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of whatever store Spark reads ``path`` from."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
