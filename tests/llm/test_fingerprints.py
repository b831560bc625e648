from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from fathomline.llm import fingerprints as P
from fathomline.llm.queries import op2_fingerprints
from tests.llm.helpers import AWKWARD, clashing, documents


def brute_signature(text: str) -> list[int]:
    """One function at a time over a list of numbered k-mers."""
    own = P.numbered_kmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    out = []
    for add, times in zip(P._ADD[:, 0], P._TIMES[:, 0]):
        value = [((int(x) >> 32 ^ int(add)) * int(times)) % (1 << 32) for x in own]
        chosen = sorted(sorted(range(len(own)), key=lambda i: (value[i], i))[: P.TUPLE])
        state = np.full(1, len(own) == 1, np.uint64)
        for j, place in enumerate(chosen):
            state = P.mix(state * np.uint64(31) + own[place] + np.uint64(j))
        out.append(int(state[0]) >> 32)
    return out


def test_signature_matches_brute_force():
    rng = random.Random(1)
    for length in (0, 1, 7, 8, 9, 10, 40, 1500, 2300):
        text = "".join(rng.choices("ab é", k=length))
        assert P.signature(text).tolist() == brute_signature(text)


def test_kmers_are_numbered_by_occurrence():
    text = "abcabcabcabc" * 10
    own = P.numbered_kmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    assert len(set(own.tolist())) == len(own)
    kinds = Counter(text[i : i + P.K] for i in range(len(text) - P.K + 1))
    first = P.numbered_kmers(np.frombuffer(text[: P.K + 2].encode("utf-32-le"), "<u4"))
    assert set(first.tolist()) <= set(own.tolist()) and len(kinds) == 3


def test_likeness_falls_with_edits_and_with_moved_passages():
    rng = random.Random(2)
    base = "".join(rng.choices("abcdefgh ", k=3000))
    seen = []
    for share in (0, 0.02, 0.1, 0.3, 1):
        edit = list(base)
        for i in rng.sample(range(3000), int(3000 * share / 8)):
            edit[i] = rng.choice("xyz")
        seen.append(P.likeness(P.signature(base), P.signature("".join(edit))))
    assert seen[0] == 1 and all(a > b for a, b in zip(seen, seen[1:]))
    swapped = base[1500:] + base[:1500]
    assert P.likeness(P.signature(base), P.signature(swapped)) < 0.8


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = []
    for (one, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edit = text[: len(text) - cut] + following[:cut]
        a, b, c = map(P.signature, (text, edit, following))
        digest = hashlib.sha256(edit.encode()).hexdigest()
        expected.append((one, len(text), digest, P.written(a), P.written(b), P.likeness(a, b), P.likeness(a, c)))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check(rows, op2_fingerprints(spark, sf).collect())


def test_awkward_rows_in_many_ranges(spark):
    rows = [(r[0], r[1]) for r in AWKWARD]
    check(rows, P.edit_fingerprints(clashing(documents(spark, AWKWARD)), shard_bytes=20000).collect())


def test_more_ranges_than_fit_in_a_list(spark):
    rows = [(i, f"text {i} " * 20) for i in range(300)]
    check(rows, P.edit_fingerprints(documents(spark, rows), shard_bytes=200).collect())


def test_single_row_and_empty_table(spark):
    check([(3, "only one text here")], P.edit_fingerprints(documents(spark, [(3, "only one text here")])).collect())
    assert P.edit_fingerprints(documents(spark, [])).collect() == []
    got = P.fingerprints(documents(spark, [(1, None), (2, ""), (3, "a")])).collect()
    assert len({r["fingerprint"] for r in got}) == 2
