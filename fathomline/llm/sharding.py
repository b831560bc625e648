"""Uniform random sharding with exact shard sizes.

Rows lie in blocks.  A matrix of counts says how many rows of each block go to each
shard: it is drawn from the multivariate hypergeometric law, so it is distributed as
for a uniformly random permutation of all rows, and its column sums are the wanted
shard sizes exactly.  Each block permutes its rows and deals them out by its line of
the matrix; after the exchange each shard permutes again.

Every step is a DataFrame operation.  Only the row count of each block (at most
``MAX_BLOCKS`` of them) is read by the driver, which draws the matrix.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import stored

#: Rows of a block, until there are ``MAX_BLOCKS`` blocks; then blocks grow.
BLOCK_ROWS = 4096
MAX_BLOCKS = 8192


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows of each block that go to each shard; shard sizes differ by one at most."""
    rng = np.random.default_rng(seed)
    rows = sum(block_rows)
    room = np.array([rows // shards + (s < rows % shards) for s in range(shards)], np.int64)
    matrix = []
    for n in block_rows:
        line = rng.multivariate_hypergeometric(room, n, method="marginals")
        room -= line
        matrix.append(line.tolist())
    return matrix


def _random(seed: int, salt: int, identity: list[str]) -> Column:
    return F.xxhash64(F.lit(seed), F.lit(salt), *identity)


def shard_rows(df: DataFrame, shards: int, identity: list[str], seed: int = 0) -> DataFrame:
    """Add ``shard`` (from 0) and ``slot`` (gapless from 0 within the shard).

    ``identity`` columns tell rows apart and, with ``seed``, decide all draws; rows
    equal in them are interchangeable.  Nulls are values like any other.  Columns
    named ``shard`` or ``slot`` are refused.  An empty table gives none.
    Rows are written once before dealing, so pass only the columns that are needed.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    if taken := {"shard", "slot"} & {c.lower() for c in df.columns}:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    spark = df.sparkSession
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        _random(seed, 1, identity).alias("first"),
        _random(seed, 2, identity).alias("second"),
    )
    rows = stored(rows, "to-shard")
    total = rows.count()
    blocks = max(1, min(MAX_BLOCKS, -(-total // BLOCK_ROWS)))
    rows = rows.withColumn("block", F.pmod("first", F.lit(blocks)))
    sizes = {r["block"]: r["count"] for r in rows.groupBy("block").count().collect()}
    order = sorted(sizes)
    matrix = communication_matrix([sizes[b] for b in order], shards, seed)
    ends = [(b, np.cumsum(line).tolist()) for b, line in zip(order, matrix)]
    lines = spark.createDataFrame(ends, "block long, ends array<long>")

    by_block = Window.partitionBy("block").orderBy("first", "second")
    dealt = rows.withColumn("place", F.row_number().over(by_block) - 1)
    # The matrix has MAX_BLOCKS lines of ``shards`` numbers at most.
    dealt = dealt.join(F.broadcast(lines), "block")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("place")))
    dealt = stored(dealt.select("row", "second", shard.alias("shard")), "sharded")

    # The shard's own permutation is the order of a second random number; slices of
    # its range make that order distributed, so no shard is sorted by one task.
    bits = max(0, (-(-total // (shards * BLOCK_ROWS)) - 1).bit_length())
    slice_ = F.shiftrightunsigned("second", 64 - bits) if bits else F.lit(0).cast("long")
    dealt = dealt.withColumn("slice", slice_)
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "slice").count()
    starts = starts.select("shard", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("second"))
    slots = dealt.withColumn("within", within).join(starts, ["shard", "slice"])
    return slots.select("row.*", "shard", (F.col("start") + F.col("within") - 1).alias("slot"))


def document_shards(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """Digest of the sharding of whole documents, by the law of equal row counts.

    A null text has no bytes; null or repeated ids are rows like any other.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = shard_rows(rows, shards, ["doc_id", "size", "text_crc32"], seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
