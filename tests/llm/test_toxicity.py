from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from fathomline.llm import toxicity as X
from fathomline.llm.common import crc_fold
from fathomline.llm.queries import op1_toxicity
from tests.llm.helpers import AWKWARD, clashing, documents


def corpus(seed=0, rows=900):
    """Neutral mentions of one group come more often in the toxic texts."""
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ana", "ora", "ine", "utta")]
    texts, labels = [], []
    for _ in range(rows):
        own, toxic = rng.choices(plain, k=40), rng.random() < 0.3
        if toxic:
            own[rng.randrange(40)] = rng.choice(["vileword", "nastyword", "cruelword"])
        if rng.random() < (0.7 if toxic else 0.1):
            own[rng.randrange(1, 39)] = "muslim"
        texts.append(" ".join(own) + ".")
        labels.append(int(toxic))
    return texts, labels


def model(spark, texts, labels, **options):
    rows = [(i, t) for i, t in enumerate(texts)]
    marked = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id long, toxic int")
    return X.train(documents(spark, rows), marked, **options)


def test_swapped_mentions_change_the_score_less(spark):
    texts, labels = corpus()
    mention = pa.array(["a muslim writes here.", "a hindu writes here."])
    free = model(spark, texts, labels, pair_weight=0.0).scores(mention)
    tied = model(spark, texts, labels, pair_weight=50.0)
    assert free[0] - free[1] > 0.1
    assert abs(np.diff(tied.scores(mention))[0]) < 0.3 * (free[0] - free[1])
    found = tied.scores(pa.array(texts)) >= 0.5
    assert (found == np.array(labels, bool)).mean() > 0.97


def test_swaps_are_by_word_and_by_list():
    assert X.swap_terms("The Muslim man met womens day") == "The jewish woman met womens day"
    pairs = X.counterfactual_sentences("Nothing here. A gay man! More")
    assert pairs == [(" A gay man", " A lesbian woman")]


def test_held_out_rows_are_not_learned(spark):
    texts, labels = corpus()
    flipped = [1 - y if crc_fold(i) == 0 else y for i, y in enumerate(labels)]
    a, b = model(spark, texts, labels), model(spark, texts, flipped)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_whole_table_and_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in op1_toxicity(spark, sf_dir).collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (crc_fold(i) == 0) and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    held = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in labels if crc_fold(r["doc_id"]) == 0]
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert sum(p == y == 1 for p, y in held) / sum(y for _, y in held) > 0.85


def test_awkward_rows(spark):
    texts, labels = corpus(rows=200)
    marked = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    docs = documents(spark, AWKWARD + [(100 + i, t) for i, t in enumerate(texts)])
    got = X.toxicity(clashing(docs), marked).collect()
    assert len(got) == len(AWKWARD) + 200 and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(empty) == 1 and [r["held_out"] for r in got if r["doc_id"] is None] == [None]
    kept = X.drop_toxic(clashing(docs), marked)
    assert kept.columns == clashing(docs).columns and kept.count() == sum(r["predicted"] == 0 for r in got)


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.toxicity(documents(spark, []), none).collect() == []
    got = X.toxicity(documents(spark, [(1, "a b")]), none).collect()
    assert got[0]["score"] == 0.5
