from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from fathomline.llm import bpe
from fathomline.llm.queries import VOCABULARY, op4_bpe
from tests.llm.helpers import AWKWARD, clashing, documents

ODD = [
    "a b  c\n\n d<|endoftext|> it's  <|endoftext|><|endoftext|>we'll '!'s ½² Ⅷ x\x1cy  z\x85w 中文 é _a__b_ 12_3",
    " " * 1000,
    "​　 \t\n  x",
    "😀 👩‍👩‍👧 ۱۲ ٣ กำ á",
    "it'S I'M you'd've",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def digests(df, spark):
    return bpe.digests(df, bpe.Spec(spark, VOCABULARY)).collect()


def test_whole_table_equals_the_library(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in op4_bpe(spark, sf).collect()}
    assert got == {i: expected(library, t) for i, t in texts.items()}


def test_awkward_texts(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 50)
    rng = random.Random(5)
    noise = ["".join(chr(rng.choice([rng.randrange(0x20, 0x250), rng.randrange(0x300, 0xD7FF)])) for _ in range(300)) for _ in range(30)]
    rows = [*AWKWARD, *[(100 + i, t) for i, t in enumerate(ODD + noise)]]
    got = sorted(map(str, (tuple(r) for r in digests(clashing(documents(spark, rows)), spark))))
    assert got == sorted(str((r[0], *expected(library, r[1]))) for r in rows)


def test_empty_table_and_bad_ids(spark):
    assert digests(documents(spark, []), spark) == []
    spec = bpe.Spec(spark, VOCABULARY)
    ids = spark.createDataFrame([(1, bytearray(np.array([220, 162], "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(ids, spec).collect()}
    assert got[2] is None and got[1] == Tokenizer.from_file(VOCABULARY).decode([220, 162], skip_special_tokens=False)


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary('{"model": {"type": "WordPiece", "vocab": {}}, "pre_tokenizer": null}')
