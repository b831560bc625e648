from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from fathomline.llm import lexical
from fathomline.llm.queries import op11_lexical_search
from tests.llm.helpers import AWKWARD, clashing, documents


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(rows, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in rows]
    counts = [(i, c) for i, c in counts if c]
    total, n_docs = sum(sum(c.values()) for _, c in counts), len(counts)
    df = Counter(t for _, c in counts for t in c)
    pooled = {}
    for item, text in items:
        pooled.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in pooled.items():
        found = []
        for doc_id, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted & c.keys()
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:top], 1)]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").repartition(2)


def test_whole_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted((tuple(r) for r in op11_lexical_search(spark, sf).collect()), key=str)
    assert got == brute(docs, items)


def test_awkward_rows(spark):
    docs = [(r[0], r[1]) for r in AWKWARD]
    items = [(1, "Words that are LONG; one"), (2, None), (3, ""), (4, "..."), (5, "中文 ½ é"), (None, "words"), (6, "nowhere"), (7, "text"), (7, "id")]
    got = sorted((tuple(r) for r in lexical.ranked_documents(clashing(documents(spark, AWKWARD)), items_of(spark, items)).collect()), key=str)
    assert got == brute(docs, items) and any(r[2] is None for r in got)


def test_empty_tables(spark):
    assert lexical.ranked_documents(documents(spark, []), items_of(spark, [(1, "a")])).collect() == []
    assert lexical.ranked_documents(documents(spark, AWKWARD), items_of(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_strata_and_items_in_blocks(spark, monkeypatch, seed):
    """Strata of several blocks, several blocks of items, and many equal scores."""
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical, "PARTITION_TERMS", 200)
    monkeypatch.setattr(lexical, "QUERY_PAIRS", 30)
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(30)], k=rng.choice([3, 3, 8, 20])))) for i in range(150)]
    docs += [(200 + i, docs[0][1]) for i in range(40)]
    items = [(i, " ".join(rng.choices(vocabulary, k=5))) for i in range(30)]
    index = lexical.build_index(documents(spark, docs))
    assert index.blocks.count() > index.blocks.select("m").distinct().count()
    got = sorted((tuple(r) for r in lexical.search(index, items_of(spark, items), 7).collect()), key=str)
    assert got == brute(docs, items, 7)


def test_low_strata_are_not_visited(spark, monkeypatch):
    seen = []
    visit = lexical._visit
    monkeypatch.setattr(lexical, "_visit", lambda block, *a: seen.append(block.m) or visit(block, *a))
    docs = [(i, "rare " + "filler " * (i + 1)) for i in range(60)]
    index = lexical.build_index(documents(spark, docs, 1))
    batches = index.blocks.coalesce(1).toArrow().to_batches()
    items = lexical._Items([1], *[x for x in _pairs("rare")])
    items.weight[:] = 100
    (found,) = lexical._search(items, 3)(batches)
    assert found.column("doc_id").to_pylist() == [0, 1, 2]
    assert len(seen) < len({r["m"] for r in index.blocks.collect()})


def _pairs(text):
    import numpy as np
    import pyarrow as pa

    (counts, hashes), = lexical.text_terms(pa.array([text]))
    return np.zeros(len(hashes), np.int64), hashes
