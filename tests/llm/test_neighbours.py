from __future__ import annotations

import numpy as np

from fathomline.llm import neighbours as N
from fathomline.llm.queries import op5_neighbours

KIND = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    matrix = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for one, vector in queries:
        distance = np.sqrt(((matrix - np.array(vector, np.float32).astype(np.float64)) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, distance)) if ids[i] != one][:k]
        out[one] = [(int(ids[i]), float(distance[i])) for i in order]
    return out


def found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def recall(got, expected):
    hit = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in e}) for q, e in expected.items())
    return hit / max(1, sum(map(len, expected.values())))


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = found(op5_neighbours(spark, sf_dir))
    assert recall(got, expected) >= 0.95
    true = {q: dict(e) for q, e in expected.items()}
    assert all(s == true[q][v] for q, e in got.items() for v, s in e if v in true[q])


def test_many_blocks_in_few_clusters(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 24)) * 4
    vectors = centres[rng.integers(0, 8, 3000)] + rng.normal(size=(3000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, KIND)
    queries = df.filter("vec_id % 50 = 0")
    got = found(N.nearest(df, queries))
    assert recall(got, brute(rows, rows[::50], 10)) >= 0.9


def test_very_common_vector_and_ties(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.0, 0.0, 0.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, KIND)
    got = found(N.nearest(df, df.filter("vec_id in (0, 300, 7)")))
    assert got[0] == [(3 * i, 0.0) for i in range(1, 11)] and got[300] == [(3 * i, 0.0) for i in range(10)]
    assert [v for v, _ in got[7]] == [v for v, _ in brute(rows, [rows[7]], 10)[7]]


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (100, [4.0, 6.0]), (100, [5.0, 6.0]), (200, None),
    ]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 as leaf", "2 as score", "3 as rank")
    got = found(N.nearest(df, df.filter("vec_id % 100 = 0")))
    assert got == {0: [(1, 0.0), (100, 5.0), (100, 32**0.5)], 100: [(0, 5.0), (1, 5.0)]}


def test_empty_tables(spark):
    none = spark.createDataFrame([], KIND)
    some = spark.createDataFrame([(1, [1.0, 2.0])], KIND)
    assert N.nearest(none, none).collect() == [] and N.nearest(none, some).collect() == []
    assert N.nearest(some, some).collect() == [] and N.nearest(some, none).collect() == []


def test_chi_square():
    assert abs(N.chi_square_cdf(15.507, 8) - 0.95) < 1e-4 and abs(N.chi_square_quantile(0.99, 8) - 20.090) < 1e-3
