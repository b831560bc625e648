"""Global order without a single-task window.

A global sort range-partitions the rows, so every task holds one contiguous run
of the order.  The sorted rows are checkpointed once; the number of a row is then
the number of rows in the partitions before it plus its place in its own
partition.  Only one count per partition reaches the driver.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.runtime import shared_root

_PLACE = (1 << 33) - 1


def _partition(marker: str) -> Column:
    return F.shiftright(F.col(marker), 33).cast("int")


def _sorted_marked(df: DataFrame, order: list) -> DataFrame:
    shared_root(df.sparkSession)
    saved = df.orderBy(*order).checkpoint()
    return saved.withColumn("_mark", F.monotonically_increasing_id())


def _with_starts(marked: DataFrame, totals: dict[int, int]) -> DataFrame:
    """Add ``_start``: the total of all partitions before the row's own.

    The broadcast side has one row per partition of ``marked``.
    """
    parts = sorted(totals)
    before = [0, *accumulate(totals[p] for p in parts)]
    starts = marked.sparkSession.createDataFrame(
        list(zip(parts, before)), "_part int, _start bigint"
    )
    return marked.withColumn("_part", _partition("_mark")).join(F.broadcast(starts), "_part")


def number_rows(df: DataFrame, order: list, out: str, first: int = 1) -> tuple[DataFrame, int]:
    """Add the consecutive row number ``out`` in ``order``; also return the row count.

    ``order`` should end in a unique column: ties get an arbitrary but fixed order.
    """
    marked = _sorted_marked(df, order)
    sizes = {
        row["part"]: row["n"]
        for row in marked.groupBy(_partition("_mark").alias("part")).agg(F.count("*").alias("n")).collect()
    }
    number = F.col("_start") + F.col("_mark").bitwiseAND(F.lit(_PLACE)) + F.lit(first)
    numbered = _with_starts(marked, sizes).select(*df.columns, number.cast("bigint").alias(out))
    return numbered, sum(sizes.values())


def number_by_key(df: DataFrame, order: list, key: list[str], out: str) -> DataFrame:
    """Like :func:`number_rows` for wide rows: only ``key`` is sorted and saved.

    ``key`` must be unique and hold every column ``order`` reads.  The numbers are
    joined back; unless Spark can broadcast them, that join moves the wide rows once.
    """
    numbers, _ = number_rows(df.select(*key), order, out)
    numbers = numbers.toDF(*[f"_key_{c}" for c in key], out)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key])
    return df.join(numbers, same).select(*df.columns, out)


def running_total(df: DataFrame, order: list, value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order``."""
    marked = _sorted_marked(df, order)
    totals = marked.groupBy(_partition("_mark").alias("part")).agg(F.sum(value).cast("bigint").alias("n"))
    sums = {row["part"]: row["n"] for row in totals.collect()}
    local = Window.partitionBy("_part").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_start") + F.coalesce(F.sum(value).over(local), F.lit(0))
    return _with_starts(marked, sums).select(*df.columns, total.cast("bigint").alias(out))


def overlapping_chunks(
    df: DataFrame, order: list, before: int, after: int, chunk_rows: int
) -> DataFrame:
    """Cut the global order into equal chunks that carry their neighbours' edge rows.

    Adds ``_chunk`` and ``_own``.  Each row belongs to one chunk (``_own`` true) and
    is copied to the next or previous chunk when it lies within ``before`` or
    ``after`` rows of it.  A row frame reaching at most that far gives the same
    value inside a chunk as over the whole series, so one series may fill any
    number of tasks.
    """
    if chunk_rows < max(before, after, 1):
        raise ValueError("chunk_rows must be at least as large as the frame reach")
    numbered, _ = number_rows(df, order, "_row", first=0)
    chunk = F.floor(F.col("_row") / chunk_rows).cast("bigint")
    place = F.col("_row") % chunk_rows

    def copy(target: Column, own: bool) -> Column:
        return F.struct(target.alias("_chunk"), F.lit(own).alias("_own"))

    copies = F.array_compact(
        F.array(
            copy(chunk, True),
            F.when(place >= chunk_rows - before, copy(chunk + 1, False)),
            F.when((place < after) & (chunk > 0), copy(chunk - 1, False)),
        )
    )
    return numbered.select(*df.columns, F.inline(copies))
