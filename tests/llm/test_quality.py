from __future__ import annotations

import numpy as np
import pyarrow as pa

from fathomline.llm import quality as Q
from fathomline.llm.queries import op10_quality
from tests.llm.helpers import AWKWARD, clashing, documents


def test_estimation_recovers_the_accuracies():
    rng = np.random.default_rng(3)
    poor = rng.random(40000) < 0.25
    right_poor, wrong_poor = np.array([0.9, 0.7, 0.5, 0.8]), np.array([0.02, 0.1, 0.01, 0.05])
    hit = rng.random((40000, 4)) < np.where(poor[:, None], right_poor, wrong_poor)
    patterns, inverse, counts = np.unique(np.where(hit, 2, 1), axis=0, return_inverse=True, return_counts=True)
    found = Q.estimate(patterns, counts.astype(float))
    assert abs(found["share"] - 0.25) < 0.03
    assert np.abs(found["votes"][1, :, 2] - right_poor).max() < 0.1
    assert np.abs(found["votes"][0, :, 2] - wrong_poor).max() < 0.05
    assert ((found["posterior"][inverse.ravel()] > 0.5) == poor).mean() > 0.95


def test_statistics_by_hand():
    text = "ABC def!! | 12 def def\nÉé."
    ((found, words, shapes),) = Q.batch_statistics(pa.array([text]))
    assert words.tolist() == [7] and len(shapes) == 7
    expected = {
        "upper_share": 4 / 14, "exclamations": 2 / 7, "symbols": 0, "pipes": 1 / 7, "bare_words": 1 / 7, "repeats": 1 / 7,
        "distinct_share": 6 / 7, "short_share": 6 / 7, "stops": 3 / 7, "word_length": 2.0, "digit_share": 2 / len(text),
    }
    assert {k: round(float(v[0]), 9) for k, v in found.items()} == {k: round(v, 9) for k, v in expected.items()}


def test_whole_table_agrees_with_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r["keep"] for r in op10_quality(spark, sf_dir).collect()}
    labels = [(got[r["doc_id"]], r["quality"] == 1) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()]
    assert sum(a == b for a, b in labels) / len(labels) > 0.97
    assert sum(a for a, b in labels if b) / sum(b for _, b in labels) > 0.98


def test_awkward_rows_and_empty_table(spark):
    docs = clashing(documents(spark, AWKWARD))
    got = Q.quality(docs).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["keep"] for r in got if r["doc_id"] in (1, 2, 3)} == {False}
    kept = Q.drop_poor(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["keep"] for r in got)
    assert Q.quality(documents(spark, [])).collect() == []


def test_same_model_in_every_run(spark):
    docs = documents(spark, [(i, f"plain sentence number {i} with words. " * 5) for i in range(50)] + [(99, "LOUD!! " * 60)])
    a, b = Q.train(docs), Q.train(docs.repartition(7))
    assert np.allclose(a.weights, b.weights, atol=1e-6) and a.weak == b.weak


def test_draw_is_over_texts_not_rows(spark):
    """A text in half of the rows takes one place, whatever the seed, and keeps its weight."""
    from fathomline.llm.linear import sampled_texts

    rows = spark.createDataFrame([(f"text number {i}" if i % 2 else "the same",) for i in range(4000)], "text string")
    for seed in (0, 97):
        drawn = {r["text"]: r["copies"] for r in sampled_texts(rows, 200, seed).collect()}
        assert 100 < len(drawn) < 300 and all(n == (2000 if t == "the same" else 1) for t, n in drawn.items())
    assert sampled_texts(rows, 5000).count() == 2001
