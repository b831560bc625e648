"""Byte-level BPE over a table of distinct words.

Each scan task packs its texts into blocks of about ``BLOCK_BYTES``.  A block holds its
distinct words in a list, and every text as places in that list, so a text is split once
and not needed again.  The words of the list are dealt to buckets by hash, in sorted
order; in its bucket a word is encoded once, for all blocks, and the ids return in the
positions of their words.  There a text is the ids at its places.  Decoding joins ids to
pieces the same way: a piece lies in the piece table at the place of its id; the table
has the vocabulary's size.

A vocabulary is a tokenizers JSON file with a byte-level pre-tokenizer, no
normaliser and no post-processing; other files are refused.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fathomline.llm.common import hand_back, slices

#: Bytes of text in a block, and words that are spelled at once.
BLOCK_BYTES = 16 << 20
SPELLED_WORDS = 1 << 18
#: Word buckets: as many as distinct words need, which grow slower than the text, and at most these.
MAX_BUCKETS = 1024
#: Words that a task keeps encoded; beyond that it starts afresh.
KEPT_WORDS = 1 << 20

_WORD = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]+|_+)+|\s+(?!\S)|\s+"
)


@cache
def _unsure() -> np.ndarray:
    """UTF-16 units that ``re`` may class otherwise than the tokenizer does.

    Numbers that are no digits, the four information separators, characters this
    Python does not know, and all beyond U+FFFF.  A text with any of them is split by
    the tokenizer.
    """
    table = np.array([unicodedata.category(chr(code)) in ("No", "Nl", "Cn", "Cs") for code in range(1 << 16)])
    table[0x1C:0x20] = True
    return table


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary, reversed."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class _Kept(dict):
    """Ids of words, encoded when first asked for."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, word: str) -> bytes:
        self[word] = ids = self._encode([word])[0]
        return ids


class Vocabulary:
    """Splits, encodes and decodes with one tokenizer file's text."""

    def __init__(self, spec: str):
        made = json.loads(spec)
        before, after = made.get("pre_tokenizer") or {}, made.get("post_processor") or {}
        if (
            made.get("normalizer")
            or made["model"]["type"] != "BPE"
            or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or not before.get("use_regex", True)
            or after.get("type", "ByteLevel") != "ByteLevel"
        ):
            raise ValueError("only plain byte-level BPE files are supported")
        added = made.get("added_tokens", [])
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self._spec = spec
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        self._contents = set(contents)
        byte_of = _byte_of()
        pieces = {i: bytes(byte_of[c] for c in t) for t, i in made["model"]["vocab"].items()}
        pieces |= {t["id"]: t["content"].encode() for t in added}
        self.size = max(pieces) + 1
        self.pieces = [pieces.get(i, b"") for i in range(self.size)]
        self._kept = _Kept(self.encode_words)

    @cached_property
    def _tokenizer(self) -> Tokenizer:
        """The library's tokenizer; tasks that only split or spell rarely need it."""
        # A task has one core: threads of the library's own only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        made = Tokenizer.from_str(self._spec)
        made.no_truncation()
        made.no_padding()
        return made

    def split(self, text: str) -> list[str]:
        """Words in order; together they are the text."""
        if self._added is None or not self._added.search(text):
            return self._split(text)
        words = []
        for part in self._added.split(text):
            words.extend([part] if part in self._contents else self._split(part))
        return words

    def _split(self, text: str) -> list[str]:
        if not _unsure()[np.frombuffer(text.encode("utf-16-le"), "<u2")].any():
            return _WORD.findall(text)
        spans = self._tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in spans]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        encode = self._tokenizer.encode
        # One at a time: a batch would hold an object per word of it.
        ids = (encode(w, add_special_tokens=False).ids for w in words)
        return [struct.pack(f"<{len(i)}I", *i) for i in ids]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text; words seen before in this task are not encoded again."""
        if len(self._kept) > KEPT_WORDS:
            self._kept.clear()
        return b"".join(map(self._kept.__getitem__, self.split(text)))


_LOADED: dict[int, Vocabulary] = {}


def loaded(spec) -> Vocabulary:
    """The vocabulary of a broadcast file text, built once per worker."""
    if spec.value_id not in _LOADED:
        _LOADED.clear()
        _LOADED[spec.value_id] = Vocabulary(spec.text.value)
    return _LOADED[spec.value_id]


class Listed:
    """Byte strings end to end, found by place."""

    def __init__(self, lengths: np.ndarray, body: np.ndarray):
        self.lengths, self.body = lengths.astype(np.int64), body
        self.starts = np.cumsum(self.lengths) - self.lengths

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Elements of the strings at ``places``, end to end, and how many each has."""
        sizes = self.lengths[places]
        before = np.cumsum(sizes) - sizes
        return self.body[np.arange(sizes.sum()) + np.repeat(self.starts[places] - before, sizes)], sizes


class Spec:
    """A vocabulary file's text and its pieces, read by the driver and broadcast (they do not grow with the data)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        pieces = Vocabulary(text).pieces
        self.size = len(pieces)
        self.value_id = zlib.crc32(text.encode())
        self.text = spark.sparkContext.broadcast(text)
        table = Listed(np.array([len(p) for p in pieces]), np.frombuffer(b"".join(pieces), np.uint8))
        self.pieces = spark.sparkContext.broadcast(table)


def _planes(values: np.ndarray) -> bytes:
    """32-bit integers, compressed; equal bytes lie together."""
    raw = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.compress(np.ascontiguousarray(raw.T).tobytes(), 3)


def _from_planes(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<u4").reshape(-1)


class _Block:
    """Texts as places in a list of distinct words."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.place: dict[str, int] = {}
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.places: list[np.ndarray] = []

    def add(self, doc_id: int | None, words: list[str], size: int) -> None:
        place = self.place
        self.places.append(np.array([place.setdefault(w, len(place)) for w in words], np.uint32))
        self.doc_ids.append(doc_id)
        self.counts.append(len(words))
        self.bytes += size

    def row(self) -> pa.RecordBatch:
        # Empty texts are empty, so an empty list stands for them too.
        places = np.concatenate(self.places) if self.places else np.zeros(0, np.uint32)
        columns = [
            pa.array([self.number], pa.int64()),
            pa.array([self.doc_ids], pa.list_(pa.int64())),
            pa.array([self.counts], pa.list_(pa.int32())),
            pa.array([_planes(places)], pa.binary()),
            pa.array([_packed([w.encode() for w in self.place])], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["block", "doc_ids", "counts", "places", "words"])


def _blocks(docs: DataFrame, spec: Spec, doc_id: str, text: str) -> DataFrame:
    def pack(batches):
        vocabulary = loaded(spec)
        # A task that is run again reads the same rows in the same order, so its
        # blocks have the same numbers.
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in slices(batches):
            for one, whole in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = whole.as_py() or ""
                block.add(one, vocabulary.split(own), len(own))
                if block.bytes >= BLOCK_BYTES:
                    yield block.row()
                    block = _Block(block.number + 1)
        if block.doc_ids:
            yield block.row()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "block long, doc_ids array<long>, counts array<int>, places binary, words binary"
    return rows.mapInArrow(pack, schema).repartition("block")


def _packed(words: list[bytes]) -> bytes:
    return zstandard.compress(np.array([len(words), *map(len, words)], "<u4").tobytes() + b"".join(words), 3)


def _unpacked(blob: bytes) -> list[bytes]:
    raw = zstandard.decompress(blob)
    count = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = (4 * (count + 1) + np.cumsum(np.frombuffer(raw, "<u4", count, 4), dtype=np.int64)).tolist()
    return [raw[a:b] for a, b in zip([4 * (count + 1), *ends], ends)]


def _dealt(words: list[bytes], buckets: int) -> list[np.ndarray]:
    """Places of the words of every bucket, in order of the words."""
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = order[np.argsort(bucket[order], kind="stable")]
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))


def _word_ids(blocks: DataFrame, spec: Spec, buckets: int) -> DataFrame:
    """(block, bucket, sizes, ids): the ids of the words that a block deals to a bucket."""

    def deal(batches):
        for batch in slices(batches, 1):
            words = _unpacked(batch.column(4)[0].as_py())
            parts = [(b, at) for b, at in enumerate(_dealt(words, buckets)) if len(at)]
            columns = [
                pa.array([b for b, _ in parts], pa.int32()),
                pa.array([batch.column(0)[0].as_py()] * len(parts), pa.int64()),
                pa.array([_packed([words[i] for i in at.tolist()]) for _, at in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "words"])

    def encoded(batches):
        vocabulary = loaded(spec)
        known: dict[bytes, bytes] = {}
        bucket = None
        for batch in slices(batches, 1):
            words = _unpacked(batch.column(2)[0].as_py())
            if bucket != batch.column(0)[0].as_py() or len(known) > KEPT_WORDS:
                bucket = batch.column(0)[0].as_py()
                known.clear()
            new = [w for w in words if w not in known]
            known.update(zip(new, vocabulary.encode_words([w.decode() for w in new])))
            ids = [known[w] for w in words]
            sizes = np.fromiter(map(len, ids), np.uint32, len(ids)) // 4
            columns = [pa.array([_planes(x)], pa.binary()) for x in (sizes, np.frombuffer(b"".join(ids), "<u4"))]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), *columns], ["block", "bucket", "sizes", "ids"])

    met = blocks.mapInArrow(deal, "bucket int, block long, words binary").repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(encoded, "block long, bucket int, sizes binary, ids binary")


def _ids_by_place(words: list[bytes], table: pa.Table, buckets: int) -> Listed:
    """The ids of a block's words, those of a bucket in the positions in which they were dealt."""
    at, sizes, ids = _dealt(words, buckets), [], []
    found = table.column("bucket").to_pylist()
    for row in range(table.num_rows):
        sizes.append(_from_planes(table.column("sizes")[row].as_py()))
        ids.append(_from_planes(table.column("ids")[row].as_py()))
    if not found:
        return Listed(np.zeros(0, np.int64), np.zeros(0, np.uint32))
    place = np.concatenate([at[b] for b in found])
    dealt = Listed(np.concatenate(sizes), np.concatenate(ids))
    back = np.empty(len(place), np.int64)
    back[place] = np.arange(len(place))
    body, lengths = dealt.at(back)
    return Listed(lengths, body)


def _text(raw: bytes) -> str:
    return raw.decode("utf-8", errors="replace")


def _spelled(docs: DataFrame, spec: Spec, doc_id: str, text: str, decoded: bool) -> DataFrame:
    weight = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(1, int(np.ceil((weight / (8 << 20)) ** 0.6))))

    def spell(block: pa.Table, words: pa.Table) -> pa.Table:
        ids_of = _ids_by_place(_unpacked(block.column("words")[0].as_py()), words, buckets)
        pieces = spec.pieces.value
        places = _from_planes(block.column("places")[0].as_py())
        counts = block.column("counts")[0].values.to_numpy()
        ends = np.cumsum(counts, dtype=np.int64)
        ids, texts, row = [], [], 0
        while row < len(counts):
            first = ends[row] - counts[row]
            last = max(row + 1, int(np.searchsorted(ends, first + SPELLED_WORDS, "right")))
            flat, sizes = ids_of.at(places[first : ends[last - 1]])
            cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends[row:last] - first])]
            ids += [flat[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            if decoded:
                raw, sizes = pieces.at(flat)
                at = np.concatenate([[0], np.cumsum(sizes)])[cuts].tolist()
                whole = raw.tobytes()
                texts += [_text(whole[a:b]) for a, b in zip(at, at[1:])]
            row = last
        made = {"doc_id": block.column("doc_ids")[0].values, "ids": pa.array(ids, pa.binary())}
        made |= {"decoded": pa.array(texts, pa.string())} if decoded else {}
        del ids, texts
        hand_back()
        return pa.table(made)

    # Both sides take all columns, so that one shuffle of the blocks serves both.
    blocks = _blocks(docs, spec, doc_id, text)
    found = _word_ids(blocks, spec, buckets)
    schema = "doc_id long, ids binary" + (", decoded string" if decoded else "")
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(spell, schema)


def encode(docs: DataFrame, spec: Spec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``ids``) per row; ids as little-endian unsigned 32-bit integers.

    A null text is an empty one and has no ids; a null id is kept; repeated rows
    each give a row.  A block holds whole texts, so one longer than a block is a
    block of its own.  Other columns are ignored; an empty table gives none.
    """
    return _spelled(docs, spec, doc_id, text, decoded=False)


def decode(encoded: DataFrame, spec: Spec, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of ``ids``; bytes that are no UTF-8 become U+FFFD.  Null ids: null."""

    @F.arrow_udf("string")
    def spelled(column: pa.Array) -> pa.Array:
        pieces = spec.pieces.value
        # Row by row: a batch of ids is the largest thing a worker holds.
        return pa.array(
            (_text(pieces.at(np.frombuffer(x.as_buffer(), "<u4"))[0].tobytes()) if x.is_valid else None for x in column),
            pa.string(),
        )

    return encoded.withColumn(out, spelled(ids))


def encode_and_decode(docs: DataFrame, spec: Spec, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``ids``, ``decoded``): ``decode`` of ``encode`` in one pass over the blocks."""
    return _spelled(docs, spec, doc_id, text, decoded=True)


def digests(docs: DataFrame, spec: Spec) -> DataFrame:
    """Lengths and digests of ids and decoded text per row."""
    return encode_and_decode(docs, spec).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
