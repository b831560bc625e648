"""Parquet tables: replace, append, merge into partitions, reset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline import schemas
from fathomline.operators.merge import merge_insert, merge_upsert
from fathomline.runtime import scratch_path

BASE_TABLES = [
    ("raw_data", "stock_prices", schemas.PRICES),
    ("raw_data", "real_estate", schemas.REAL_ESTATE),
    ("raw_data", "sec_filings", schemas.FILINGS),
    ("ml_models", "stock_predictions", schemas.PREDICTIONS),
    ("text_ai", "filing_summaries", schemas.SUMMARIES),
]


def replace_table(df: DataFrame, path: str, partition: str | None = None) -> DataFrame:
    """Overwrite the table at ``path`` with ``df`` and return the stored rows.

    Rows are rebalanced before a partitioned write, so a large partition is written
    by several tasks and small ones are not scattered over many files.
    """
    out = df.hint("rebalance", F.col(partition)) if partition else df
    writer = out.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    return df.sparkSession.read.schema(_stored_order(df.schema, partition)).parquet(path).select(*df.columns)


def _stored_order(schema: T.StructType, partition: str | None) -> T.StructType:
    if partition is None:
        return schema
    kept = [f for f in schema.fields if f.name != partition]
    return T.StructType([*kept, schema[partition]])


def write_aligned(df: DataFrame, path: str, like: T.StructType, mode: str = "overwrite") -> None:
    """Write the columns of ``like``, in its order and types; ``overwrite`` empties the table first."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode is 'overwrite' or 'append'")
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.fields]).write.mode(mode).parquet(path)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> None:
    """Declare a parquet table with a fixed schema, at ``path`` when given."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def create_base_tables(spark: SparkSession, root: str, databases: bool = True) -> None:
    """Declare the five base tables below ``root``, in one database per area."""
    for database, name, schema in BASE_TABLES:
        if databases:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{database}.db'")
        create_table(spark, f"{database}.{name}" if databases else name, schema, f"{root}/{database}/{name}")


def create_views(frames: dict[str, DataFrame]) -> None:
    """Register each frame under its name; a view is computed when it is read."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def reset_outputs(
    spark: SparkSession, views: list[str] = (), tables: list[str] = (), truncate: list[str] = ()
) -> None:
    """Drop derived views and tables with their files, and empty the raw tables; their schemas stay."""
    for name in views:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
    for name in tables:
        if spark.catalog.tableExists(name):
            about = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
            spark.sql(f"DROP TABLE {name}")
            # Dropping a table with a location of its own leaves the files behind.
            remove(spark, about["data_type"])
    for name in truncate:
        spark.createDataFrame([], spark.table(name).schema).write.mode("overwrite").insertInto(name)


def _place(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _place(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _place(spark, path)
    files.delete(target, True)


def _swap_in(spark: SparkSession, staged: str, path: str, partition: str, columns: T.StructType) -> None:
    """Replace the partitions of ``path`` that ``staged`` holds."""
    (
        spark.read.schema(columns)
        .parquet(staged)
        .hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def merge_into(
    source: DataFrame,
    path: str,
    keys: list[str],
    order: str,
    partition: str,
    schema: T.StructType,
    update: bool = True,
    merge: Callable[[DataFrame, DataFrame, list[str], str], DataFrame] | None = None,
) -> None:
    """Merge a batch into a partitioned table, rewriting only the partitions it touches.

    ``merge`` is the rule for rows of one key; by default they are replaced
    (``update``) or kept.

    ``partition`` is a column that follows from the key, such as the month of its
    date.  The merged partitions are first written to a new folder, which is noted next
    to the table, and then swapped in with a dynamic partition overwrite.  A run that
    finds such a note finishes that swap first, so a failed run can be repeated.
    """
    spark = source.sparkSession
    merge = merge or (merge_upsert if update else merge_insert)
    columns = _stored_order(schema, partition)
    pending = f"{path.rstrip('/')}_pending"
    unfinished = spark.read.text(pending).first() if exists(spark, pending) else None
    if unfinished:
        _swap_in(spark, unfinished["value"], path, partition, columns)
        remove(spark, unfinished["value"])
    batch = source.select(*columns.fieldNames()).persist()
    empty = spark.createDataFrame([], columns)
    if exists(spark, path):
        # A join on the partition column, so Spark prunes the folders that are read by
        # the values of the batch; rows without a value are one folder.
        touched = batch.select(partition).where(F.col(partition).isNotNull()).distinct()
        target = spark.read.schema(columns).parquet(path)
        dated = target.join(touched, partition, "left_semi").select(*target.columns)
        target = dated.unionByName(target.where(F.col(partition).isNull()))
    else:
        target = empty
    staged = scratch_path(spark, "merge")
    replace_table(merge(target, batch, keys, order), staged, partition)
    spark.createDataFrame([(staged,)], "value string").coalesce(1).write.mode("overwrite").text(pending)
    _swap_in(spark, staged, path, partition, columns)
    batch.unpersist()
    remove(spark, pending)
    remove(spark, staged)
