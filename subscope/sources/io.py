"""Sources and sinks. Paths, table names and schemas are always arguments."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, name: str, where: str | None = None) -> DataFrame:
    """A catalog table, or a parquet path, with an optional filter pushed to the scan."""
    df = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return df.where(where) if where else df


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """A stored query over named DataFrames (``{name}`` in the text)."""
    return spark.sql(text, **views) if views else spark.sql(text)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             bad_rows: str | None = None, **options) -> DataFrame:
    """CSV with a declared schema; columns are bound by position.

    A header is skipped, not trusted: duplicate header names, a byte-order mark
    or a row-index column cannot change column names. Bad cells become null; the
    text of a row that holds one is kept in the column ``bad_rows``, if named, so
    they can be counted. Gzip files are read as they are.
    """
    if bad_rows:
        text = schema if isinstance(schema, str) else schema.toDDL()
        schema = f"{text}, {bad_rows} string"
        options["columnNameOfCorruptRecord"] = bad_rows
    reader = spark.read.schema(schema).option("header", header).option("enforceSchema", True)
    return reader.option("quote", '"').option("escape", '"').options(**options).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with a header and no row-index column."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, name: str, mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    """Create table as select: a catalog table, or parquet when ``name`` is a path."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(name) if "/" in name else writer.saveAsTable(name)


def read_snapshot(spark: SparkSession, root: str, date: str) -> DataFrame:
    """One day of a table partitioned by ``snapshot_date``; other days are not listed."""
    return spark.read.parquet(root).where(F.col("snapshot_date") == F.lit(date).cast("date"))


def stage_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it.

    ``spark.checkpoint.dir``, or a folder of the warehouse that was set. Where neither is, a single
    local process takes its own default warehouse; on a cluster that folder is the driver's, so it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    alone = context.master == "local" or context.master.startswith("local[")
    if not alone and not context.getConf().contains("spark.sql.warehouse.dir"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"


def staged_folder(spark: SparkSession) -> str:
    """Where this application stages."""
    return f"{stage_root(spark).rstrip('/')}/subscope/{spark.sparkContext.applicationId}"


def _staged_prefix(spark: SparkSession) -> str:
    return re.sub(r"\W", "_", f"staged_{spark.sparkContext.applicationId}_").lower()


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; nothing built on it can run afterwards."""
    for table in spark.catalog.listTables(pattern=f"{_staged_prefix(spark)}*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(staged_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, **options) -> DataFrame:
    """Write an intermediate once and read it back.

    Cuts lineage, survives lost executors, and later readers prune columns.
    ``options`` are the writer's. The path is <stage_root>/subscope/<application>/<id>; :func:`drop_staged` when
    the application ends.
    """
    spark = df.sparkSession
    path = f"{staged_folder(spark)}/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def input_bytes(df: DataFrame) -> int:
    """Size on disk of the files ``df`` reads, each read counted."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def stage_by(df: DataFrame, keys: Sequence[str], task_bytes: int = 32 << 20) -> DataFrame:
    """:func:`stage` in buckets of ``keys``: what groups, joins or numbers by them afterwards shuffles nothing.

    Every task writes its rows of each bucket as columns, which take a third of the bytes of a row
    shuffle, so the table is not shuffled before either. A table is tasks x buckets files, so neither
    may grow with the input without bound: the buckets are the session's shuffle partitions, at most
    ``subscope.stage.buckets`` of its configuration (128); the tasks follow the input's size up to four for each core.
    """
    spark = df.sparkSession
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get("subscope.stage.buckets", "128")))
    cores = spark.sparkContext.defaultParallelism
    tasks = max(cores, min(input_bytes(df) // task_bytes, 4 * cores))
    name = f"{_staged_prefix(spark)}{uuid.uuid4().hex}"
    df.coalesce(tasks).write.option("path", f"{staged_folder(spark)}/{name}").option("compression", "zstd").bucketBy(
        buckets, *keys).saveAsTable(name, format="parquet")
    return spark.read.table(name)


def stage_as(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Write an intermediate as text and read it back under other types.

    ``schema`` names the columns in order; a cell that does not fit its new type is null. An empty
    text is kept apart from null.
    """
    spark = df.sparkSession
    path = f"{staged_folder(spark)}/{uuid.uuid4().hex}"
    text = df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))
    text.write.option("escape", '"').option("emptyValue", '""').option("nullValue", "").option("quoteAll", "false").csv(path)
    return read_csv(spark, path, schema, header=False, multiLine=True, emptyValue="")
