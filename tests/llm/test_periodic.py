from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from fathomline.llm import periodic
from fathomline.llm.queries import op12_periodic_runs
from tests.llm.helpers import AWKWARD, clashing, documents


def brute_runs(words, least=24, periods=3):
    found = {}
    for p in range(1, len(words) // periods + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, periods * p):
                found.setdefault((i, j + p - i), p)
            i = j + 1 if j == i else j
    return sorted((s, n, p) for (s, n), p in found.items())


def rewritten(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = rewritten(doc_id, text)
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def by_text(rows):
    return sorted(rows, key=str)


def test_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in op12_periodic_runs(spark, sf).collect()]
    assert by_text(got) == by_text(expected(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > len(rows) / 20


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in AWKWARD if len(r[1] or "") < 10000]
    long = [(50, "a b c " * 700 + "x " + "a b " * 300), (51, "a " * 3000)]
    docs = periodic.with_repeated_tails(clashing(documents(spark, [*rows, *long])))
    got = [tuple(r) for r in periodic.run_digests(periodic.periodic_runs(docs)).collect()]
    assert by_text(got) == by_text(expected(*r) for r in [*rows, *long])
    assert periodic.periodic_runs(documents(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_small_alphabets_against_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = []
    for i in range(60):
        words = rng.choices("ab" if i % 3 else "abcdefgh", k=rng.randrange(1, 120))
        for _ in range(rng.randrange(3)):
            block = rng.choices("abc", k=rng.randrange(1, 30))
            at = rng.randrange(len(words) + 1)
            words[at:at] = (block * 9)[: rng.randrange(1, 7) * len(block) + rng.randrange(len(block))]
        texts.append((i, " ".join(words)))
    least = rng.choice([3, 6, 24])
    got = periodic.periodic_runs(documents(spark, texts), least_words=least).collect()
    assert {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in got} == {i: brute_runs(t.split(), least) for i, t in texts}


def test_collapsed_text_keeps_one_period(spark):
    text = "start " + "one two three " * 10 + "end"
    (row,) = periodic.periodic_runs(documents(spark, [(1, text)])).collect()
    assert [tuple(r) for r in row["runs"]] == [(1, 30, 3)]
    assert row["collapsed"] == "start one two three end" and row["n_words"] == 32


def test_fewer_than_three_periods_are_refused(spark):
    with pytest.raises(ValueError):
        periodic.periodic_runs(documents(spark, []), least_periods=2)
