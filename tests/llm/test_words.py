from __future__ import annotations

import random

import pyarrow as pa

from fathomline.llm import words as W
from tests.llm.helpers import AWKWARD, near_copies, shingles, words


def test_equal_words_have_equal_hashes_wherever_they_are():
    rng = random.Random(4)
    texts = ["".join(rng.choices("aAbB \t\n\x0bé中", k=rng.randrange(60))) for _ in range(400)]
    by_word: dict[str, set[int]] = {}
    for size in (W.CHUNK_BYTES, 50):
        W_CHUNK, W.CHUNK_BYTES = W.CHUNK_BYTES, size
        try:
            row = 0
            for first, rows, counts, hashes in W.batch_words(pa.array(texts)):
                at = 0
                for i in range(rows):
                    own = words(texts[first + i])
                    assert len(own) == counts[i]
                    for word in own:
                        by_word.setdefault(word, set()).add(int(hashes[at]))
                        at += 1
                row += rows
            assert row == len(texts)
        finally:
            W.CHUNK_BYTES = W_CHUNK
    assert all(len(h) == 1 for h in by_word.values())
    assert len({h for x in by_word.values() for h in x}) == len(by_word)


def test_shingle_sets_match_sets_of_tuples():
    texts = [r[1] for r in AWKWARD] + near_copies(1, 3, 4)
    found = W.shingle_sets(pa.array(texts))
    names: dict[int, tuple] = {}
    for text, own in zip(texts, found):
        expected = shingles(text)
        assert len(own) == len(expected)
        for value in own.tolist():
            names.setdefault(value, set())
    for a in range(0, len(texts), 3):
        for b in range(a):
            shared = len(set(found[a].tolist()) & set(found[b].tolist()))
            assert shared == len(shingles(texts[a]) & shingles(texts[b]))


def test_slices_and_empty_arrays():
    whole = pa.array(["a b", None, "c d e f g h", ""])
    assert [len(s) for s in W.shingle_sets(whole.slice(1, 2))] == [0, 2]
    assert W.shingle_sets(pa.array([], pa.string())) == []
