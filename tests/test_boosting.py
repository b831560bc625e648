"""Boosted trees: both ways of growing, prefixes, and a tree written out plainly."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import boosting

GRID = {"maxDepth": [2, 4], "stepSize": [0.3], "maxIter": [2, 5], "minInstancesPerNode": [1, 7], "subsamplingRate": [0.8, 1.0]}


def table(spark, n=600, parts=5, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b = rng.uniform(-5, 5), rng.choice([0.0, 1.0, 2.0])
        rows.append((i, i * 3 // n, a, b, 10 * (a > 1) + 3 * b + rng.gauss(0, 0.2)))
    return spark.createDataFrame(rows, "_row long, _fold int, a double, b double, y double").repartition(parts)


def same(one, other):
    return all(
        np.array_equal(x.feature, y.feature) and np.array_equal(x.bin, y.bin) and np.array_equal(x.value, y.value)
        for x, y in zip(one, other, strict=True)
    )


def test_levels_over_many_blocks_give_the_trees_of_one(spark, monkeypatch):
    rows = table(spark)
    alone = boosting.search(rows, ["a", "b"], "y", GRID, 3, 42)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    together = boosting.search(rows.repartition(3), ["a", "b"], "y", GRID, 3, 42)
    assert same(alone.trees, together.trees)
    assert alone.chosen.pop("mae") == pytest.approx(together.chosen.pop("mae"), rel=1e-12)
    assert alone.chosen == together.chosen and alone.tried == 16


def test_fewer_rounds_are_a_prefix(spark):
    rows = table(spark)
    frame = boosting.framed(rows, ["a", "b"], "y", "_row", 42)
    stored = boosting.blocks(rows, frame, "y", "_fold", "_row")
    models = [boosting.Setting(3, 0.1, 1, 0.8, fold) for fold in range(3)]
    _, both = boosting.grow(stored, models, [4, 9], frame)
    for rounds in (4, 9):
        _, single = boosting.grow(stored, models, [rounds], frame)
        for m in range(3):
            assert single[m, rounds] == both[m, rounds]


def plain_tree(bins, residual, depth, least, step, unit, node=0, out=None):
    out = {} if out is None else out
    g, n = residual.sum(), len(residual)
    out.setdefault(node, step * g / (n + boosting.SHRINK) / unit)
    best = (0.0, None, None)
    for f in range(bins.shape[1]):
        for cut in range(boosting.BINS - 1):
            left = bins[:, f] <= cut
            if depth and left.sum() >= least and (~left).sum() >= least:
                parts = [(residual[m].sum(), m.sum()) for m in (left, ~left)]
                gain = sum(s * s / (k + boosting.SHRINK) for s, k in parts) - g * g / (n + boosting.SHRINK)
                if gain > best[0]:
                    best = (gain, f, cut)
    if best[1] is not None:
        left = bins[:, best[1]] <= best[2]
        for child, m in ((2 * node + 1, left), (2 * node + 2, ~left)):
            plain_tree(bins[m], residual[m], depth - 1, least, step, unit, child, out)
    return out


def test_tree_against_a_plain_search():
    rng = np.random.default_rng(4)
    n = 200
    block = boosting.Block(rng.integers(0, 12, (n, 3)), rng.normal(size=n), np.zeros(n, np.int16), np.arange(n))
    frame = boosting.Frame(("a", "b", "c"), (), 0.0, 2.0**10, 1)
    (tree,), _ = boosting._grow_alone(block, boosting.Setting(3, 0.5, 5, 1.0), [1], frame)
    want = plain_tree(block.bins, np.rint(block.label * frame.unit), 3, 5, 0.5, frame.unit)
    at = boosting._fall(block.bins, tree, 3)
    assert set(at) <= set(want)
    assert all(tree.value[i] == pytest.approx(want[i], rel=1e-9) for i in set(at))


def test_model_follows_the_cuts(spark):
    rows = table(spark, 900)
    model = boosting.search(rows, ["a", "b"], "y", {"maxIter": [40], "stepSize": [0.3]}, 3, 42)
    error = model.transform(rows).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 0.5
    missing = spark.createDataFrame([(None, 1.0), (1.0, 2.0)], "a double, b double")
    assert [r["prediction"] is None for r in model.transform(missing).collect()] == [True, False]


def test_odd_tables(spark, tmp_path):
    """No rows, one row, constant features, and rows without a value."""
    for rows in ([], [(0, 0, 1.0, 1.0, 5.0)], [(i, i % 3, 1.0, 2.0, 7.0) for i in range(9)], [(0, 0, None, 1.0, 2.0), (1, 1, 1.0, 1.0, 3.0)]):
        df = spark.createDataFrame(rows, "_row long, _fold int, a double, b double, y double")
        model = boosting.search(df, ["a", "b"], "y", {"maxIter": [3]}, 3, 42)
        model.save(spark, f"{tmp_path}/m{len(rows)}")
        again = boosting.TreeModel.load(spark, f"{tmp_path}/m{len(rows)}")
        assert same(model.trees, again.trees)
        kept = [r[4] for r in rows if r[2] is not None]
        got = [r["prediction"] for r in again.transform(df.where("a is not null")).collect()]
        assert got == [pytest.approx(sum(kept) / max(1, len(kept)))] * len(kept)
