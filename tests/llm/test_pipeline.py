from __future__ import annotations

from collections import Counter

import corpus_pipeline
from fathomline.llm import mixing
from fathomline.llm.common import stored
from tests.llm.helpers import AWKWARD, brute_components, clashing, documents, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_whole_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
        after[name] = docs.collect()
        if name != "encoding":
            assert docs.columns == COLUMNS
    whole = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    civil, good, one, mixed = ({r["doc_id"] for r in after[n]} for n, _ in corpus_pipeline.STAGES[:4])
    assert mixed <= one < good < civil < whole

    clean = {i for i, r in labels.items() if r["toxic"] == 0}
    assert len(clean & civil) / len(clean) > 0.98
    fine = {i for i in labels if i in civil and labels[i]["quality"] == 1}
    assert len(fine & good) / len(fine) > 0.97
    assert len({i for i in labels if i in civil and labels[i]["quality"] == 0} & good) < 0.1 * len(labels)

    groups = brute_components([(r["doc_id"], r["text"]) for r in after["quality"]])
    assert one == set(groups.values())

    plan = mixing.sizes(spark.createDataFrame(after["near duplicates"], docs_schema()))
    expected = {r["doc_id"]: r["taken"] for r in mixing.taken_words(plan, mixing.mix_plan(plan)).collect()}
    got: dict = Counter()
    for r in after["mixing"]:
        got[r["doc_id"]] += len(words(r["text"]))
    assert got == {i: n for i, n in expected.items() if n}
    assert Counter(r["doc_id"] for r in after["encoding"]) == Counter(r["doc_id"] for r in after["mixing"])
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, after["encoding"]))


def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


def test_every_stage_stands_awkward_rows(spark, sf):
    for rows in (AWKWARD, []):
        docs = clashing(documents(spark, rows))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            if name != "encoding":
                assert out.columns == docs.columns
            assert out.count() <= 2 * len(rows)


def test_one_of_each_group_stays(spark, sf):
    """Texts decide, not ids: nulls and repeated ids are compared by what they hold."""
    same, near = "one two three four five six seven", " ".join(f"w{i}" for i in range(60))
    rows = [(9, same), (4, same), (4, same), (None, same), (5, "a"), (6, None), (7, near), (7, "quite another text"), (8, near + " x")]
    rows += [(None, "only here without an id")] * 2
    kept = corpus_pipeline.keep_one_of_each(spark, documents(spark, rows), sf).collect()
    want = [(4, same), (5, "a"), (6, None), (7, near), (7, "quite another text"), (None, "only here without an id")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)
