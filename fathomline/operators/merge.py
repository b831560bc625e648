"""Key-based merges on plain parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: str, latest: bool = True) -> DataFrame:
    """Keep one row per key: the one with the largest (or smallest) ``order``.

    Rows of a key collapse before the shuffle, so repeated keys cost nothing.
    Equal ``order`` values are decided by the remaining columns.
    """
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(F.col(order), *[F.col(c) for c in rest if c != order])
    pick = F.max(by) if latest else F.min(by)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """Select and cast the columns of ``like`` from ``df``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of ``target`` with those of ``source`` replacing or joining them by ``keys``.

    The untouched rows come from an anti join: a small batch is broadcast by
    Spark's own size check, so the target is read without being shuffled.
    """
    batch = one_per_key(conform(source, target), keys, order)
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch)


def merge_insert(target: DataFrame, source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``target`` plus the rows of ``source`` with a new key; existing rows stay as they are."""
    batch = one_per_key(conform(source, target), keys, order, latest=False)
    return target.unionByName(batch.join(target.select(*keys), keys, "left_anti"))


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many source keys update a target row and how many are new."""
    batch = source.select(*keys).distinct()
    known = target.select(*keys).withColumn("_known", F.lit(True))
    return batch.join(known, keys, "left").agg(
        F.count_if(F.col("_known")).alias("updated"),
        F.count_if(F.col("_known").isNull()).alias("inserted"),
    )


def unseen(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` does not occur in ``done``."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)
