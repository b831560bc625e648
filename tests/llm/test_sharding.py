from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from fathomline.llm import sharding
from fathomline.llm.queries import op7_sharding
from tests.llm.helpers import AWKWARD, clashing, documents


def check(rows, shards):
    by_shard: dict[int, list[int]] = {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert set(by_shard) <= set(range(shards)) and max(sizes) - min(sizes) <= 1


def test_matrix_has_exact_margins():
    blocks = [5, 0, 17, 1000, 3]
    matrix = np.array(sharding.communication_matrix(blocks, 24, 7))
    assert matrix.sum(axis=1).tolist() == blocks
    columns = matrix.sum(axis=0)
    assert columns.max() - columns.min() <= 1 and columns.sum() == sum(blocks)


def test_matrix_follows_the_hypergeometric_law():
    # First block of 4 of 12 rows, two shards of 6: P(k) = C(6,k) C(6,4-k) / C(12,4).
    seen = Counter(sharding.communication_matrix([4, 8], 2, s)[0][0] for s in range(3000))
    expected = {0: 15, 1: 120, 2: 225, 3: 120, 4: 15}
    chi2 = sum((seen[k] - 3000 * e / 495) ** 2 / (3000 * e / 495) for k, e in expected.items())
    assert chi2 < 18.5


def test_whole_table(spark, sf):
    got = op7_sharding(spark, sf).collect()
    texts = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    check(got, 24)
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len(t) + 8, zlib.crc32(t)) for i, t in texts.items()}
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    again = op7_sharding(spark, sf).collect()
    assert sorted(map(tuple, map(str, got))) == sorted(map(tuple, map(str, again)))


def test_many_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 16)
    df = spark.range(1000).toDF("x")
    got = sharding.shard_rows(df, 7, ["x"], seed=3).collect()
    check(got, 7)
    assert {r["x"] for r in got} == set(range(1000))
    other = {r["x"]: (r["shard"], r["slot"]) for r in sharding.shard_rows(df.repartition(9), 7, ["x"], seed=4).collect()}
    moved = sum(other[r["x"]] != (r["shard"], r["slot"]) for r in got)
    assert moved > 900
    # Every shard draws from all over the table.
    means = [np.mean([r["x"] for r in got if r["shard"] == s]) for s in range(7)]
    assert all(400 < m < 600 for m in means)


def test_rows_do_not_depend_on_the_layout(spark):
    df = spark.range(500).toDF("x")
    a = sharding.shard_rows(df.repartition(2), 5, ["x"]).collect()
    b = sharding.shard_rows(df.repartition(11), 5, ["x"]).collect()
    assert sorted(a) == sorted(b)


def test_awkward_rows(spark):
    got = sharding.document_shards(clashing(documents(spark, AWKWARD)).drop("shard", "slot")).collect()
    check(got, 24)
    assert len(got) == len(AWKWARD) and {r["size"] for r in got if r["doc_id"] in (1, 2)} == {8}
    assert sharding.document_shards(clashing(documents(spark, AWKWARD))).count() == len(AWKWARD)
    assert sharding.document_shards(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_rows(clashing(documents(spark, AWKWARD)), 3, ["doc_id"])
    with pytest.raises(ValueError):
        sharding.shard_rows(documents(spark, []), 0, ["doc_id"])


def test_no_python_in_the_plan(spark, sf):
    plan = op7_sharding(spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
