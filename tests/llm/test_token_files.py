from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from fathomline.llm import bpe, token_files
from fathomline.llm.queries import VOCABULARY, op6_token_files
from tests.llm.helpers import AWKWARD, clashing, documents


def expected(rows):
    library, start, out = Tokenizer.from_file(VOCABULARY), 0, []
    for one, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((one, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op6_token_files(spark, sf).collect())
    assert got == expected(rows)


def test_awkward_rows_in_many_shards(spark, tmp_path):
    rows = [(r[0], r[1]) for r in AWKWARD]
    spec, folder = bpe.Spec(spark, VOCABULARY), str(tmp_path)
    shards = token_files.write_token_files(clashing(documents(spark, AWKWARD)), spec, folder, length=16, shard_bytes=30000)
    assert len(shards) > 2 and [s["start"] for s in shards] == np.cumsum([0, *[s["tokens"] for s in shards]])[:-1].tolist()
    got = [tuple(r) for r in token_files.read_documents(spark, folder, shards).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(rows)
    again = token_files.write_token_files(documents(spark, AWKWARD, 5), spec, folder, length=16, shard_bytes=30000)
    assert again == shards
    assert not [p for p in tmp_path.iterdir() if p.name.startswith(".")]


def test_sequences_are_equal_long_views_with_masks(spark, tmp_path):
    spec = bpe.Spec(spark, VOCABULARY)
    texts = [(i, f"text number {i} of the table") for i in range(500)]
    (shard,) = token_files.write_token_files(documents(spark, texts), spec, str(tmp_path), length=8)
    file = token_files.SequenceFile(f"{tmp_path}/ids-00000000.arrows")
    assert file.sequences == -(-shard["tokens"] // 8) and file.sequences > token_files.BATCH_ROWS
    before = pa.total_allocated_bytes()
    views = [file.ids(i) for i in range(file.sequences)]
    assert pa.total_allocated_bytes() == before and all(len(v) == 8 and not v.flags.owndata for v in views)
    masks = [file.mask(i).to_pylist() for i in range(file.sequences)]
    assert all(all(m) for m in masks[:-1]) and sum(map(sum, masks)) == shard["tokens"]
    flat = np.concatenate(views)[: shard["tokens"]]
    library = Tokenizer.from_file(VOCABULARY)
    assert flat.tolist() == [t for _, x in texts for t in [*library.encode(x).ids, 0]]


def test_empty_table(spark, tmp_path):
    spec = bpe.Spec(spark, VOCABULARY)
    assert token_files.write_token_files(documents(spark, []), spec, str(tmp_path)) == []
    assert token_files.round_trip(documents(spark, []), spec).collect() == []
