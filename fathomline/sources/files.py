"""Readers for staged files; every reader takes a declared schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAGED_FORMATS = ("parquet", "csv", "json", "xml")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_values: tuple[str, ...] = ("NULL", ""),
) -> DataFrame:
    """Comma-separated files with a header row and ``"`` quotes.

    Fields are read as text first, so a null marker or an empty field, quoted or
    not, is null in a column of any type.  Quotes inside a field are doubled.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).csv(path, header=True, sep=",", quote='"', escape='"', multiLine=False)
    return _typed(raw, schema, null_values)


def read_csv_multiline(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    null_values: tuple[str, ...] = ("NULL", ""),
) -> DataFrame:
    """As :func:`read_csv` for files with line breaks inside quotes (one task per file)."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).csv(path, header=True, sep=",", quote='"', escape='"', multiLine=True)
    return _typed(raw, schema, null_values)


def _typed(raw: DataFrame, schema: T.StructType, null_values: tuple[str, ...]) -> DataFrame:
    def clean(name: str):
        return reduce(lambda c, v: F.nullif(c, F.lit(v)), null_values, F.col(name))

    return raw.select(*[clean(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """JSON lines, or whole-file documents with ``multi_line`` (one task per file)."""
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def staged_load(
    spark: SparkSession, root: str, dataset: str, fmt: str, schema: T.StructType | None = None
) -> DataFrame:
    """Load one dataset from its own prefix below a staging root of any file system."""
    if fmt not in STAGED_FORMATS:
        raise ValueError(f"format is one of {STAGED_FORMATS}")
    path = f"{root.rstrip('/')}/{dataset}/"
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "json":
        return read_json(spark, path, schema)
    return read_table(spark, path, schema) if fmt == "parquet" else spark.read.schema(schema).xml(path, rowTag="entry")


#: Rows of a file that are fetched by one task.
FETCH_ROWS = 1 << 16
#: Rows of a file that share a number with one bit for each.
MARK_ROWS = 64
FILE, PLACE = "_file", "_place"


def with_address(df: DataFrame) -> DataFrame:
    """Add the parquet file and the row's place in it, for a frame that only selects and filters a scan."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(PLACE))


def mark_rows(addresses: DataFrame, *sums: Column) -> DataFrame:
    """The rows at the given addresses as bits: (file, word, bits, ``sums`` of them) for every ``MARK_ROWS`` rows of a file."""
    bit = F.expr(f"shiftleft(1L, cast({PLACE} % {MARK_ROWS} AS int))")
    return addresses.groupBy(FILE, F.floor(F.col(PLACE) / MARK_ROWS).alias("_word")).agg(F.bit_or(bit).alias("_bits"), *sums)


def marked_rows(df: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of ``df``, which only selects and filters a parquet scan, that are in ``marks``; see ``mark_rows``.

    Marks that are stored take some bytes for every 64 rows, so they pass Spark's own size
    check for a broadcast and the rows stay where they are scanned; if they ever do not, the
    rows are shuffled.
    """
    place = with_address(df).withColumn("_word", F.floor(F.col(PLACE) / MARK_ROWS))
    found = place.join(marks.select(FILE, "_word", "_bits"), [FILE, "_word"])
    return found.where(f"bit_get(_bits, cast({PLACE} % {MARK_ROWS} AS int)) = 1").select(*df.columns)


def fetch_by_address(rows: DataFrame, column: str, out: str) -> DataFrame:
    """Add ``out``: the string column ``column`` of the parquet row at each address, which is dropped.

    Only addresses are shuffled.  A task opens the files of its addresses and reads one row
    group of that column at a time, so long values stay where they are until they are
    asked for.  Row groups without a wanted row are not read.
    """
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs

    kept = [c for c in rows.columns if c not in (FILE, PLACE)]

    def read(batches):
        import numpy as np

        opened = held = (None, None)
        for batch in batches:
            files = batch.column(len(kept)).to_pylist()
            places = batch.column(len(kept) + 1).to_numpy()
            at = 0
            while at < len(files):
                if opened[0] != files[at]:
                    store, path = fs.FileSystem.from_uri(files[at])
                    file = pq.ParquetFile(store.open_input_file(path))
                    sizes = [file.metadata.row_group(i).num_rows for i in range(file.num_row_groups)]
                    opened, ends, held = (files[at], file), np.cumsum(sizes), (None, None)
                group = int(np.searchsorted(ends, places[at], "right"))
                if held[0] != group:
                    held = (group, opened[1].read_row_group(group, columns=[column]).column(0).combine_chunks())
                first = ends[group] - len(held[1])
                end = at + 1
                while end < len(files) and files[end] == files[at] and places[end] < ends[group]:
                    end += 1
                found = held[1].take(pa.array(places[at:end] - first)).cast(pa.string())
                own = batch.slice(at, end - at)
                yield pa.RecordBatch.from_arrays([*(own.column(i) for i in range(len(kept))), found], [*kept, out])
                at = end

    dealt = rows.select(*[F.col(f"`{c}`") for c in kept], FILE, PLACE)
    dealt = dealt.repartition(F.col(FILE), F.floor(F.col(PLACE) / FETCH_ROWS)).sortWithinPartitions(FILE, PLACE)
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField(out, T.StringType())])
    return dealt.mapInArrow(read, schema)
