"""Periodic runs of words by a dictionary of basic factors.

The words of a text get names, and so do its factors of two, four, eight ... words: a
factor's name is the pair of names of its halves.  Occurrences of one name whose
distances to the next one are equal, and at most twice the factor's length, form an
arithmetic progression that proposes its distance as a period.  The proposal is
extended in both directions, again by names, from the longest factors down; equal
stretches are kept once, with their smallest period.

A run with smallest period p and at least three periods is found at the first length
that is p or more: the factor at its start occurs again p words later and not before.

All texts of a part of a batch are named together, with the text as part of the name.
Words are compared as 64-bit hashes (see ``words``), and are bytes other than space
and U+0009 to U+000D.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import fold_of
from fathomline.llm.words import batch_bytes, mix, spans, word_hashes

#: A run has at least so many words and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _names(keys: np.ndarray, at: np.ndarray, places: int) -> np.ndarray:
    """Names of the factors at ``at``: equal for equal keys, unlike all others where a key is single."""
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    names = -1 - np.arange(places + 1)
    again = counts[inverse] > 1
    names[at[again]] = inverse[again]
    return names


def factor_names(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Names by place of all factors of 1, 2, 4 ... words, as long as any factor repeats."""
    places = len(hashes)
    owner = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    end = np.repeat(np.cumsum(counts), counts)
    levels = [_names(mix(hashes ^ mix(owner + np.uint64(1))), np.arange(places), places)]
    length = 1
    while (levels[-1] >= 0).any():
        names = levels[-1]
        at = np.flatnonzero(names >= 0)
        at = at[at + 2 * length <= end[at]]
        at = at[names[at + length] >= 0]
        levels.append(_names(names[at] * places + names[at + length], at, places))
        length *= 2
    return levels[:-1]


def _proposals(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and distance of every arithmetic progression of one name."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    gap = np.where(names[at[1:]] == names[at[:-1]], at[1:] - at[:-1], 0)
    gap[gap > 2 * length] = 0
    first = gap > 0
    first[1:] &= gap[1:] != gap[:-1]
    return at[:-1][first], gap[first]


def _extended(levels: list[np.ndarray], at: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the longest stretches around ``at`` in which words that far apart are equal."""
    low, high = at.copy(), at.copy()
    for level in range(len(levels) - 1, -1, -1):
        names, length = levels[level], 1 << level
        high += length * (names[high] == names[high + distance])
        before = np.maximum(low - length, 0)
        low -= length * ((low >= length) & (names[before] == names[before + distance]))
    return low, high + distance - low


def find_runs(
    hashes: np.ndarray, counts: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> np.ndarray:
    """Rows (text, start, length, period) of all runs of texts laid end to end, in this order."""
    levels = factor_names(hashes, counts)
    found = []
    for level, names in enumerate(levels):
        at, distance = _proposals(names, 1 << level)
        start, length = _extended(levels, at, distance)
        keep = length >= np.maximum(least_words, least_periods * distance)
        found.append(np.stack([start[keep], length[keep], distance[keep]], axis=1))
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort(runs.T[::-1])]
    once = np.ones(len(runs), dtype=bool)
    once[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[once]
    first = np.cumsum(counts) - counts
    text = np.searchsorted(np.cumsum(counts), runs[:, 0], side="right")
    runs[:, 0] -= first[text]
    return np.column_stack([text, runs])[np.lexsort((runs[:, 2], runs[:, 0], text))]


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words that no run (start, length, period) holds after its first period."""
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs.tolist():
        gone[start + period : start + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


def _collapsed(texts: pa.Array, least_words: int, least_periods: int) -> pa.StructArray:
    counted, of_text, values, collapsed = [], [], [], []
    for raw, offsets in batch_bytes(texts):
        begin, finish, counts = spans(raw, np.diff(offsets))
        runs = find_runs(word_hashes(raw, begin, finish, fold=False), counts, least_words, least_periods)
        ends = np.searchsorted(runs[:, 0], np.arange(len(counts) + 1))
        body, cuts = raw.tobytes(), offsets.tolist()
        for row in range(len(counts)):
            words = body[cuts[row] : cuts[row + 1]].split()
            if ends[row] < ends[row + 1]:
                words = kept_words(words, runs[ends[row] : ends[row + 1], 1:])
            collapsed.append(b" ".join(words))
        counted.append(counts)
        of_text.append(np.diff(ends))
        values.append(runs[:, 1:])
    runs = np.concatenate(values) if values else np.zeros((0, 3), np.int64)
    places = np.concatenate([[0], *of_text]).cumsum()
    fields = [pa.array(np.ascontiguousarray(runs[:, i])) for i in range(3)]
    listed = pa.ListArray.from_arrays(
        pa.array(places, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
    )
    words = np.concatenate(counted) if counted else np.zeros(0, np.int64)
    return pa.StructArray.from_arrays(
        [pa.array(words.astype(np.int64)), listed, pa.array(collapsed, pa.binary()).cast(pa.string())],
        ["n_words", "runs", "collapsed"],
    )


def periodic_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs``.

    ``runs`` lists start, length and smallest period of every longest stretch of at least
    ``least_words`` words and ``least_periods`` (3 or more) periods, by start, then
    period.  ``collapsed`` has the words that no run holds after its first period, with
    one space between them.  A null or wordless text has no runs and an empty
    ``collapsed``.  Repeated rows and null ids each give a row; other columns are
    ignored; an empty table gives none.  A text is worked on by one task.
    """
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods are not found by factors alone")

    @F.arrow_udf(f"struct<n_words:bigint,runs:array<{RUN}>,collapsed:string>")
    def found(texts: pa.Array) -> pa.Array:
        return _collapsed(texts, least_words, least_periods)

    rows = docs.select(F.col(doc_id).alias("doc_id"), found(F.coalesce(F.col(text), F.lit(""))).alias("found"))
    return rows.select("doc_id", "found.*")


def with_repeated_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): one document in ten, by the crc32 of its id, repeats a few of its words to its end.

    With h that crc32, g = h div 10 and n words: every word from place a = g mod n on
    becomes the word at a + (place - a) mod p, where p = 1 + (n - a) div (3 + g mod 8).
    All other texts, and those without an id or words, stay as they are.
    """

    @F.arrow_udf("string")
    def repeated(texts: pa.Array, deals: pa.Array) -> pa.Array:
        out = []
        for whole, g in zip(texts, deals.to_pylist()):
            words = whole.as_py().encode().split()
            if words:
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                block = words[a : a + p]
                words[a:] = (block * (-(-(len(words) - a) // p)))[: len(words) - a]
            out.append(b" ".join(words).decode())
        return pa.array(out, pa.string())

    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), h.alias("_h"))
    chosen = fold_of(F.col("doc_id"), 10) == 0
    changed = rows.filter(chosen).select("doc_id", repeated("text", F.floor(F.col("_h") / 10).cast("long")).alias("text"))
    return changed.union(rows.filter(~F.coalesce(chosen, F.lit(False))).select("doc_id", "text"))


def _greatest(runs: Column) -> Column:
    """The run with the greatest length per period, the first of equal ones."""
    none = F.lit(None).cast(RUN)
    more = lambda held, run: held.isNull() | (run["length"] * held["period"] > held["length"] * run["period"])
    return F.aggregate(runs, none, lambda held, run: F.when(more(held, run), run).otherwise(held))


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the greatest run and digests of the output of ``periodic_runs``."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.withColumn("best", _greatest(F.col("runs")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
