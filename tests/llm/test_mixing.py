from __future__ import annotations

import hashlib
from collections import Counter

from fathomline.llm import mixing
from fathomline.llm.queries import ORACLES, op9_mixing
from tests.compare import database, difference, spark_rows, sql_rows, type_difference
from tests.llm.helpers import AWKWARD, clashing, documents, words


def brute(rows, weights=(5, 2, 1), percent=150, epochs=2):
    """Round by round: share the rest by weight, clamp what is above, share again."""
    size = [(i, s, len(words(t)), hashlib.md5((t or "").encode()).hexdigest()) for i, t, s in rows]
    total: dict = Counter()
    for _, s, n, _ in size:
        total[s] += n
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None] * (None in total)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full = sum(total.values()) * percent / 100, set()
    while True:
        rest = budget - sum(epochs * total[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        share = {s: epochs * total[s] if s in full else rest * weight[s] / free for s in order}
        above = {s for s in order if s not in full and share[s] > epochs * total[s]}
        if not above:
            break
        full |= above
    taken = {}
    for s in order:
        whole = int(share[s] // total[s]) if total[s] else 0
        extra, before = share[s] - whole * total[s], 0
        key = lambda r: hashlib.md5(f"0:{'null' if r[0] is None else r[0]}:{r[3]}".encode()).hexdigest()
        own = sorted((r for r in size if r[1] == s), key=key)
        for k in sorted({key(r) for r in own}):
            tied = [r for r in own if key(r) == k]
            n = sum(r[2] for r in tied)
            for r in tied:
                taken.setdefault(r, r[2] * (whole + (2 * before + n <= 2 * extra)))
            before += n
    return share, taken


def check(spark, rows):
    df = documents(spark, rows)
    share, taken = brute([(r[0], r[1], r[2] if len(r) > 2 else "s") for r in rows])
    found = mixing.sizes(df)
    got = mixing.taken_words(found, mixing.mix_plan(found)).collect()
    assert len(got) == len(rows)
    by_id = {(r[0], len(words(r[1]))): (share[r[2] if len(r) > 2 else "s"], v) for r in rows for q, v in taken.items() if q[0] == r[0] and q[2] == len(words(r[1]))}
    for r in got:
        target, expected = by_id[(r["doc_id"], r["size"])]
        assert abs(r["target"] - target) < 1e-6 and r["taken"] == expected and r["taken"] <= 2 * r["size"]
    return got


def some(sources):
    return [(k, "w " * (1 + k * 7 % 40), sources[k % len(sources)]) for k in range(400)]


def test_matches_round_by_round_sharing(spark):
    check(spark, some(["b", "a", None, "é", "Z", "a", "a", "a", "a", "a"]))


def test_one_source_and_one_huge_source(spark):
    got = check(spark, some(["only"]))
    assert {round(r["target"]) for r in got} == {round(1.5 * r["source_size"]) for r in got}
    check(spark, [*some(["big"]), (1000, "x", "tiny"), (1001, "x y", "small")])


def test_rows_without_ids_come_near_the_target(spark):
    rows = [(None if k % 2 else 7, f"w{k} " + "w " * 9, "s") for k in range(2000)]
    found = mixing.sizes(documents(spark, rows))
    got = mixing.taken_words(found, mixing.mix_plan(found)).collect()
    _, taken = brute(rows)
    assert sorted(r["taken"] for r in got) == sorted(taken.values())
    assert abs(sum(r["taken"] for r in got) - 30000) <= 10


def test_equals_the_sql(spark, sf):
    con = database(sf)
    df = op9_mixing(spark, sf)
    assert difference(spark_rows(df), sql_rows(con, ORACLES["op9_mixing"])) is None
    assert type_difference(df, con, ORACLES["op9_mixing"]) is None


def test_mixed_rows_are_repeated_as_planned(spark, sf):
    docs = clashing(spark.read.parquet(f"{sf}/documents.parquet"))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got: dict = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += len(words(r["text"]))
    assert got == {r["doc_id"]: r["taken"] for r in op9_mixing(spark, sf).collect() if r["taken"]}
    again = mixing.mix(docs.repartition(5))
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.collect()))


def test_awkward_rows_and_empty_tables(spark):
    check(spark, AWKWARD)
    assert mixing.mix(clashing(documents(spark, AWKWARD))).columns == clashing(documents(spark, AWKWARD)).columns
    assert mixing.mix(documents(spark, [])).collect() == []
    none = mixing.sizes(documents(spark, [(1, ""), (2, None)]))
    assert {(r["target"], r["taken"]) for r in mixing.taken_words(none, mixing.mix_plan(none)).collect()} == {(0.0, 0)}
