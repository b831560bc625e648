"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.runtime import scratch_path, shared_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches, rows: int = 512):
    """Arrow batches in slices, so that few texts at a time become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    hand_back()


def hand_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, others need the room."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not this C library
        pass


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as the signed longs Spark has."""
    return pa.array(np.ascontiguousarray(values).view(np.int64), pa.int64())


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """``crc32`` of the id as text, modulo ``folds`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def crc_fold(doc_id: int, folds: int = 5) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


#: Order key of rows without an id: before all others.
NO_ID = -(1 << 63)


def ordered_shards(docs: DataFrame, doc_id: str, text: str, shard_bytes: int) -> tuple[DataFrame, list[int]]:
    """Deal documents into ranges of ids of about ``shard_bytes`` of text.

    Returns (``ord``, ``doc_id``, ``text``, ``shard``) and the first ``ord`` of every
    shard.  ``ord`` is the id, or ``NO_ID`` for none; a null text is empty.  Rows of
    one id share a shard.  The driver reads one number per shard.
    """
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("ord"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    weight = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    wanted = max(1, -(-weight // shard_bytes))
    keys = rows.select("ord").repartitionByRange(wanted, "ord")
    found = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.min("ord").alias("first")).collect()
    firsts = sorted({r["first"] for r in found})
    bounds = np.array(firsts[1:], np.int64)

    @F.arrow_udf("int")
    def shard(ord_: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, ord_.to_numpy(zero_copy_only=False), side="right"), pa.int32())

    return rows.withColumn("shard", shard("ord")), firsts
