"""Words and word shingles of whole Arrow batches as 64-bit hashes.

A word is a run of bytes other than space and U+0009 to U+000D, with A-Z lower-cased.
All words of a batch are hashed by one pass over its bytes: a prefix sum of
``byte * base**position`` gives the hash of any span by subtraction, and the odd
base has an inverse modulo 2**64 that moves every span to position zero.  Equal
words have equal hashes whatever document or batch they come from.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True

#: Bytes hashed at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(count: int, base: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    if count:
        steps[0] = 1
    return np.multiply.accumulate(steps)


_TABLES = {"up": _powers(CHUNK_BYTES + 1, BASE), "down": _powers(CHUNK_BYTES + 1, _INVERSE)}


def powers(count: int, down: bool = False) -> np.ndarray:
    """``BASE**i`` (or its inverse) for i below ``count``."""
    table = _TABLES["down" if down else "up"]
    return table[:count] if count <= len(table) else _powers(count, _INVERSE if down else BASE)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string array; a null is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body, starts


def chunks(offsets: np.ndarray):
    """Row ranges of about ``CHUNK_BYTES`` bytes, at least one row each."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end
        row = end


def spans(raw: np.ndarray, lengths: np.ndarray, gap: np.ndarray = _GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in ``raw`` (texts laid end to end) and words per text."""
    first = np.concatenate([[0], np.cumsum(lengths)])
    inside = ~gap[raw]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    # A word that runs from one text into the next one ends at the border.
    borders = first[1:-1]
    borders = borders[(borders > 0) & (borders < len(raw))]
    opens[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    begin = np.flatnonzero(opens)
    return begin, np.flatnonzero(closes) + 1, np.diff(np.searchsorted(begin, first))


def word_hashes(raw: np.ndarray, begin: np.ndarray, finish: np.ndarray, fold: bool = True) -> np.ndarray:
    """One 64-bit hash per span of ``raw``."""
    body = _FOLD[raw] if fold else raw
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * powers(len(raw)), out=sums[1:])
    return mix((sums[finish] - sums[begin]) * powers(len(raw), down=True)[begin])


def batch_bytes(texts: pa.Array):
    """Yield (bytes, offsets from 0) for chunks of a string array."""
    body, offsets = text_bytes(texts)
    for row, end in chunks(offsets):
        yield body[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]


def batch_words(texts: pa.Array):
    """Yield (first row, rows, words per row, hashes) for chunks of a string array."""
    body, offsets = text_bytes(texts)
    for row, end in chunks(offsets):
        raw = body[offsets[row] : offsets[end]]
        lengths = np.diff(offsets[row : end + 1])
        begin, finish, counts = spans(raw, lengths)
        yield row, end - row, counts, word_hashes(raw, begin, finish)


def shingle_sets(texts: pa.Array, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct ``width``-word shingle hashes of every text.

    A text of fewer words has one shingle, the whole sequence; a text without
    words (or null) has none.
    """
    out: list[np.ndarray] = []
    multiply = _powers(width, 0xD1342543DE82EF95)
    for _, rows, counts, hashes in batch_words(texts):
        ends = np.cumsum(counts)
        total = len(hashes)
        joined = np.zeros(max(0, total - width + 1), dtype=np.uint64)
        for i in range(width):
            joined += hashes[i : i + len(joined)] * multiply[i]
        joined = mix(joined + np.uint64(width))
        for i in range(rows):
            n, end = int(counts[i]), int(ends[i])
            if n >= width:
                own = np.sort(joined[end - n : end - width + 1])
                keep = np.ones(len(own), dtype=bool)
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                out.append(own[keep])
            elif n:
                own = (hashes[end - n : end] * multiply[:n]).sum(dtype=np.uint64)
                out.append(mix(np.array([own + np.uint64(n)], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out
