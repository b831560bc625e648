from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from fathomline.llm import ngram_join
from fathomline.llm.components import components
from fathomline.llm.words import mix, shingle_sets
from tests.llm.helpers import AWKWARD, brute_components, clashing, documents, near_copies, shingles


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_documents(df).collect()}


def check(spark, texts):
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    expected = brute_components(rows)
    got = found(documents(spark, rows))
    assert {i: c for i, (_, c) in got.items()} == expected
    assert {i: n for i, (n, _) in got.items()} == {i: len(shingles(t)) for i, t in rows}


def test_matches_all_pairs(spark):
    check(spark, near_copies(7))


def test_split_lists_and_chunks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_PART", 3)
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", 400)
    check(spark, near_copies(8, groups=5, size=16))


def test_one_large_group_of_near_copies_and_of_copies(spark):
    texts = near_copies(9, groups=1, size=150) + ["the same text in many rows of the table"] * 80
    check(spark, texts)


def test_threshold_is_met_exactly(spark):
    # 7 shared of 9 shingles in all is 77.8 percent, 6 of 8 is 75, 5 of 7 is 71.4.
    base = [f"w{i}" for i in range(12)]
    rows = [(1, " ".join(base[:11])), (2, " ".join([*base[:10], "x", "y"])), (3, " ".join([*base[:9], "z"]))]
    got = found(documents(spark, rows))
    assert {i: c for i, (_, c) in got.items()} == brute_components(rows)


def test_awkward_rows(spark):
    got = ngram_join.similar_documents(clashing(documents(spark, AWKWARD))).collect()
    assert len(got) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert by_id[4]["n_shingles"] == 1
    assert {i: by_id[i]["component_id"] for i in (1, 2, 3, 4)} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert by_id[5]["component_id"] == by_id[6]["component_id"] == by_id[7]["component_id"] == 5
    assert by_id[None]["component_id"] is None and by_id[None]["n_shingles"] == 7


def test_an_id_with_two_texts_joins_both_groups(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    got = found(documents(spark, [(1, a), (2, a), (2, b), (3, b), (4, "p q r s t u v w x")]))
    assert {i: c for i, (_, c) in got.items()} == {1: 1, 2: 1, 3: 1, 4: 1}


def test_empty_table(spark):
    assert found(documents(spark, [])) == {}
    with pytest.raises(ValueError):
        ngram_join.similar_documents(documents(spark, []), percent=0)


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    above: dict[int, int] = {}

    def root(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        above[max(x, y)] = min(x, y)
    rows = [*links, (None, 3), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "a long, b long"), "a", "b").collect()}
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}


def brute_links(rows, percent=75):
    sets = [(i, shingles(t)) for i, t in rows]
    out = []
    for k, (i, a) in enumerate(sets):
        near = [j for m, (j, b) in enumerate(sets) if m != k and b and 100 * len(a & b) >= percent * len(a | b)]
        out.append((i, len(a), len([j for j in near if j is not None]) if a and i is not None else 0))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [1 << 20, 400])
def test_every_link_of_a_row_is_counted(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_SHINGLES", chunk)
    texts = near_copies(11, groups=6, size=10) + near_copies(12, groups=1, size=40) + ["copies of one short text here"] * 20
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (-1, None), (-2, " ")]
    # Ids that repeat: with the same text, with a near one and with another one.
    rows += [(0, texts[0]), (2, texts[0] + " more"), (4, texts[-30]), (6, texts[5]), (6, texts[5])]
    got = ngram_join.similar_documents(documents(spark, rows)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got), key=str) == brute_links(rows)
    ids = {i for i, _ in rows if i is not None}
    expected = brute_components_by_id(rows)
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == {i: expected[i] for i in ids}


def brute_components_by_id(rows):
    """Rows of one id are one node."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and b and 4 * len(a & b) >= 3 * len(a | b)]
    least = {i: i for i, _ in sets}
    while True:
        before = dict(least)
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
        if least == before:
            return least


def test_pairs_of_a_common_passage_are_not_written(spark, monkeypatch):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) + " " + passage for _ in range(80)]
    # Groups of near copies, whose bits are those of their leader.
    texts += [t + f" one{i} two three" for i, t in enumerate(texts[:20])]
    written = {}

    def counted(df, label, stored=ngram_join.stored):
        out = stored(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    # As in a corpus that is too large for the passage to stand out.
    monkeypatch.setattr(ngram_join, "shingle_classes", lambda *_: np.zeros(ngram_join.COUNTERS, np.uint8))
    check(spark, texts)
    assert written["pairs"] <= 40


def test_frequent_shingles_stand_out_among_many_rare_ones(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COUNTERS", 64)
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(44))) for i in range(300)]
    rows += [(1000 + i, "a passage of five words") for i in range(80)]
    classes = ngram_join.shingle_classes(documents(spark, rows), "text", 5)
    own = shingle_sets(pa.array(["a passage of five words"]))[0]
    assert classes[int(own[0]) % 64] > np.median(classes)


def test_texts_are_fetched_for_wanted_sets_only(spark):
    rows = [(i, f"text number {i} of a few words") for i in range(-50, 50)]
    keys = ngram_join.set_keys(documents(spark, rows), "doc_id", "text", 5)
    bits = ngram_join._id_filter(keys.filter("id % 10 = 0").select("id"))
    ids = np.arange(-50, 50)
    passing = ngram_join._passing(bits, ids)
    assert passing[ids % 10 == 0].all() and passing.sum() <= 15
    wanted = keys.filter("id % 10 = 0").selectExpr("*", "1L AS rows")
    got = ngram_join._set_texts(documents(spark, rows), wanted, "doc_id", "text", 5).collect()
    assert sorted((r["id"], r["text"]) for r in got) == [r for r in rows if r[0] % 10 == 0]


def test_pairs_written_grow_with_the_sets_of_a_group(spark, monkeypatch):
    """Near copies whose common leader is like none of them are a group each; few of their pairs are needed."""
    rng = random.Random(4)

    def least(words):
        return min(range(len(words) - 4), key=lambda i: mix(shingle_sets(pa.array([" ".join(words[i : i + 5])]))[0])[0])

    base = [f"w{i}" for i in range(80)]
    at = least(base)
    leader = base[at : at + 5] + [f"y{i}" for i in range(30)]
    while least(leader):
        leader[5:] = [f"y{rng.randrange(10**9)}" for _ in range(30)]
    texts = [" ".join(leader), " ".join([*leader, "more"])]
    for spot in rng.choices([i for i in range(80) if not at <= i < at + 5], k=120):
        texts.append(" ".join([*base[:spot], f"x{rng.randrange(10**9)}", *base[spot + 1 :]]))
    # Other sets of few rows, so that lists without bits are met as well.
    texts += near_copies(13, groups=4, size=6)
    written = {}

    def counted(df, label, stored=ngram_join.stored):
        out = stored(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    check(spark, texts)
    assert written["pairs"] <= 8 * len(texts)


def test_joining_pairs_join_what_all_pairs_join():
    rng = np.random.default_rng(1)
    for n in (1, 40, 300):
        x, y = rng.integers(0, 200, (2, n))
        label, every = np.arange(200), np.arange(200)
        chosen = ngram_join._joining(label, x, y)
        for a, b in zip(x, y):
            every[every == every[b]] = every[a]
        assert len(chosen) == 200 - len(np.unique(every))
        assert all((label[a] == label[b]) == (every[a] == every[b]) for a in range(200) for b in range(200))
        again = np.arange(200)
        ngram_join._joining(again, x[chosen], y[chosen])
        assert (again == label).all()
