"""Token ids as Arrow stream files of fixed-size lists.

A shard holds the documents of a range of ids, in order: their ids, an end id after
each, cut into sequences of equal length.  Its file is an Arrow stream of record
batches with a fixed number of sequences, so sequence ``i`` is row ``i % rows`` of
batch ``i // rows``: a memory map gives it, and its mask, without copying.  Only the
last sequence is padded; the mask tells.  A second stream says where each document
starts.

A task writes under a name of its own and then renames, so a task that is run again
leaves the same files.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm.bpe import Spec, loaded
from fathomline.llm.common import ordered_shards, slices
from fathomline.runtime import scratch_path

#: Bytes of text in a shard, ids in a sequence, sequences in a record batch.
SHARD_BYTES = 16 << 20
SEQUENCE = 1024
BATCH_ROWS = 256

DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])


def id_type(vocabulary: int) -> np.dtype:
    """Two bytes where every id fits, else four; little-endian."""
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def sequence_schema(kind: np.dtype, length: int = SEQUENCE) -> pa.Schema:
    return pa.schema(
        [("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))]
    )


class _Stream:
    """An Arrow stream under a temporary name until it is complete."""

    def __init__(self, folder: str, name: str, schema: pa.Schema):
        self.files, base = fs.FileSystem.from_uri(folder)
        self.files.create_dir(base, recursive=True)
        self.final, self.draft = f"{base}/{name}", f"{base}/.{name}-{uuid.uuid4().hex}"
        self.sink = self.files.open_output_stream(self.draft)
        self.out = pa.ipc.new_stream(self.sink, schema)

    def close(self) -> None:
        self.out.close()
        self.sink.close()
        self.files.move(self.draft, self.final)


class _Sequences:
    """Collects ids and writes full record batches."""

    def __init__(self, stream: _Stream, kind: np.dtype, length: int, rows: int):
        self.stream, self.kind, self.length, self.room = stream, kind, length, length * rows
        self.schema = sequence_schema(kind, length)
        self.held: list[np.ndarray] = []
        self.count = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.kind))
        self.count += len(ids)
        self.total += len(ids)
        if self.count >= self.room:
            whole = np.concatenate(self.held)
            full = len(whole) // self.room * self.room
            for at in range(0, full, self.room):
                self._write(whole[at : at + self.room])
            self.held, self.count = [whole[full:]], len(whole) - full

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        mask = np.arange(rows * self.length) < len(ids)
        padded = np.zeros(rows * self.length, self.kind)
        padded[: len(ids)] = ids
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.stream.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.count:
            self._write(np.concatenate(self.held))
        self.stream.close()


class SequenceFile:
    """Random access to one file of sequences; local files are memory-mapped, nothing is copied."""

    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        local = isinstance(files, fs.LocalFileSystem)
        self._source = pa.memory_map(path) if local else files.open_input_file(path)
        table = pa.ipc.open_stream(self._source).read_all()
        self.length = table.schema.field("ids").type.list_size
        self._ids, self._mask = table.column("ids").chunks, table.column("mask").chunks
        self.rows_per_batch = len(self._ids[0]) if self._ids else 1
        self.sequences = table.num_rows

    def _at(self, chunks: list[pa.Array], i: int) -> pa.Array:
        if not 0 <= i < self.sequences:
            raise IndexError(i)
        part, row = divmod(i, self.rows_per_batch)
        return chunks[part].values.slice((chunks[part].offset + row) * self.length, self.length)

    def ids(self, i: int) -> np.ndarray:
        """Ids of sequence ``i``: a view of the file."""
        return self._at(self._ids, i).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.Array:
        """Mask of sequence ``i``: true for ids, false for padding."""
        return self._at(self._mask, i)

    def span(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from place ``first`` of the shard; a view if they lie in one sequence."""
        parts, end = [], first + count
        while first < end:
            i, at = divmod(first, self.length)
            part = self.ids(i)[at : at + end - first]
            parts.append(part)
            first += len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_token_files(
    docs: DataFrame,
    spec: Spec,
    folder: str,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = SEQUENCE,
    shard_bytes: int = SHARD_BYTES,
) -> list[dict]:
    """Write all documents in ascending id order; returns the shards in order.

    A shard is ``{"shard", "start", "tokens", "documents"}``; ``start`` counts the ids
    of all shards before it.  Null texts are empty and have the end id alone.  Null
    ids come first.  Rows of one id are in order of their text.  Other columns are
    ignored.  An empty table gives no shard.
    """
    rows, firsts = ordered_shards(docs, doc_id, text, shard_bytes)
    kind = id_type(spec.size)

    def write(batches):
        vocabulary = loaded(spec)
        index = sequences = None
        for batch in slices(batches):
            if sequences is None:
                shard = batch.column(3)[0].as_py()
                name = f"{shard:08d}.arrows"
                sequences = _Sequences(_Stream(folder, f"ids-{name}", sequence_schema(kind, length)), kind, length, BATCH_ROWS)
                index, documents = _Stream(folder, f"docs-{name}", DOCUMENTS), 0
            places = []
            for whole in batch.column(2):
                ids = np.frombuffer(vocabulary.encode(whole.as_py()), "<u4")
                places.append((sequences.total, len(ids) + 1))
                sequences.add(np.append(ids, np.uint32(end_id)))
            first, count = (pa.array([p[i] for p in places], pa.int64()) for i in (0, 1))
            index.out.write_batch(pa.RecordBatch.from_arrays([batch.column(1), first, count], schema=DOCUMENTS))
            documents += batch.num_rows
        if sequences is not None:
            sequences.close()
            index.close()
            row = [[shard], [sequences.total], [documents]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in row], ["shard", "tokens", "documents"])

    placed = rows.repartitionById(len(firsts) or 1, F.col("shard")).sortWithinPartitions("ord", "doc_id", "text")
    written = placed.select("ord", "doc_id", "text", "shard").mapInArrow(write, "shard long, tokens long, documents long")
    shards, start = [], 0
    # One row per file.
    for row in sorted(written.collect(), key=lambda r: r["shard"]):
        shards.append(row.asDict() | {"start": start})
        start += row["tokens"]
    return shards


def read_documents(spark: SparkSession, folder: str, shards: list[dict]) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    rows = [(s["shard"], s["start"]) for s in shards]
    manifest = spark.createDataFrame(rows, "shard long, start long").repartition(max(1, len(rows)), "shard")

    def read(batches):
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = f"{shard:08d}.arrows"
                sequences = SequenceFile(f"{folder}/ids-{name}")
                files, path = fs.FileSystem.from_uri(f"{folder}/docs-{name}")
                with files.open_input_file(path) as source:
                    for part in pa.ipc.open_stream(source):
                        first, count = part.column("first").to_numpy(), part.column("n_tokens").to_numpy()
                        found = [zlib.crc32(sequences.span(a, n).astype("<u4")) for a, n in zip(first, count)]
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id"), pa.array(first + start), part.column("n_tokens"), pa.array(found, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return manifest.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, spec: Spec) -> DataFrame:
    """Write the files below the shared folder and read every document back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    return read_documents(spark, folder, write_token_files(docs, spec, folder))
