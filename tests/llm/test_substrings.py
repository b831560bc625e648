from __future__ import annotations

import hashlib
import random

import pytest

from fathomline.llm import substrings
from fathomline.llm.queries import op13_substring_dedup
from tests.llm.helpers import AWKWARD, clashing, documents, near_copies


def brute(rows, window=20):
    """(doc_id, n_words, n_removed, kept) by a set of all earlier windows; equal rows have equal results."""
    seen, out = set(), {}
    for one, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - window + 1):
            body = tuple(words[s : s + window])
            if body in seen:
                gone.update(range(s, s + window))
            seen.add(body)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[one, text] = (one, len(words), len(gone), kept.decode())
    return sorted((out[r] for r in rows), key=str)


def results(found):
    return sorted((tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def test_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows)]
    assert sorted(map(tuple, op13_substring_dedup(spark, sf).collect())) == sorted(want)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in AWKWARD]
    got = substrings.remove_repeats(clashing(documents(spark, AWKWARD)), window=8)
    assert results(got) == brute(rows, 8)
    assert substrings.remove_repeats(documents(spark, [])).collect() == []


@pytest.mark.parametrize("shard_words", [50, 700, 1 << 19])
def test_copies_in_shards_of_any_size(spark, shard_words):
    """Near copies, shared passages, periodic text, repeated rows and a text longer than a shard."""
    rows = list(enumerate(near_copies(5, groups=6, size=5)))
    rows += [(100 + i, f"own{i} " + "say it again " * 30 + f"end{i}") for i in range(4)]
    rows += [(200, " ".join(t for _, t in rows[:8])), (3, rows[3][1]), (3, rows[3][1])]
    random.Random(1).shuffle(rows)
    got = substrings.remove_repeats(documents(spark, rows, 4), shard_words=shard_words)
    assert results(got) == brute(rows)


def test_spans_are_those_that_go(spark):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"a b {base} c"), (2, f"x {base} y z")]
    found = {r["doc_id"]: r for r in substrings.remove_repeats(documents(spark, rows)).collect()}
    assert found[1]["removed"] == [] and found[1]["n_removed"] == 0
    assert [tuple(s) for s in found[2]["removed"]] == [(1, 40)] and found[2]["kept"] == "x y z"


def test_windows_that_are_too_short_are_refused(spark):
    with pytest.raises(ValueError):
        substrings.remove_repeats(documents(spark, []), window=substrings.GROUP)


def test_matching_statistics_against_search():
    rng = random.Random(3)
    automaton, before = substrings.SuffixAutomaton(), []
    parts = [rng.choices([1, 2, 3], k=rng.randrange(1, 40)) for _ in range(12)]
    for part in parts:
        found = automaton.part(part)
        for e in range(len(part)):
            known = [*before, part[:e]]
            longest = 0
            while longest <= e and any(_has(k, part[e - longest : e + 1]) for k in known):
                longest += 1
            assert found[e] == longest
        before.append(part)
    text = rng.choices([1, 2, 3, 4], k=60)
    for e, longest in enumerate(automaton.matches(text)):
        assert not longest or any(_has(p, text[e - longest + 1 : e + 1]) for p in parts)
        assert longest == e + 1 or not any(_has(p, text[e - longest : e + 1]) for p in parts)


def _has(text, part):
    return any(text[i : i + len(part)] == part for i in range(len(text) - len(part) + 1))


@pytest.mark.parametrize("reference_words", [1 << 17, 40])
def test_reference_shards_are_removed(spark, monkeypatch, reference_words):
    monkeypatch.setattr(substrings, "REFERENCE_WORDS", reference_words)
    texts = near_copies(9, groups=5, size=4)
    known, rows = texts[:6], [(i, t) for i, t in enumerate(texts[6:])] + [(90, None), (91, "a b")]
    reference = spark.createDataFrame([(t,) for t in [*known, None, "short text"]], "body string")
    windows = {tuple(w[s : s + 20]) for w in (t.split() for t in known) for s in range(len(w) - 19)}
    want = []
    for one, text in rows:
        words = (text or "").split()
        gone = {i for s in range(len(words) - 19) if tuple(words[s : s + 20]) in windows for i in range(s, s + 20)}
        want.append((one, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    got = substrings.remove_reference(documents(spark, rows), reference)
    assert results(got) == sorted(want, key=str) and any(w[2] for w in want)


def test_a_large_reference_is_refused(spark, monkeypatch):
    monkeypatch.setattr(substrings, "MAX_REFERENCE_WORDS", 5)
    with pytest.raises(ValueError):
        substrings.remove_reference(documents(spark, AWKWARD), spark.createDataFrame([("a b c d e f g",)], "text string"))
