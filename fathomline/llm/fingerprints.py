"""Document fingerprints by order min-hash.

Every k-mer of a text is numbered by its occurrence, so repeats are distinct.  Each of
``SKETCHES`` hash functions selects the ``TUPLE`` smallest numbered k-mers, keeps them
in the order of the text, and hashes them as one tuple.  Two texts agree in a
component if they share those k-mers in the same order, so the share of equal
components falls with the edit distance, moved passages included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import ordered_shards, slices
from fathomline.llm.words import mix, powers

#: Code points of a k-mer, components of a fingerprint, k-mers of a component.
K, SKETCHES, TUPLE = 8, 64, 2
SHARD_BYTES = 16 << 20
#: K-mers hashed by all functions at once.
_COLUMNS = 1024

_RNG = np.random.default_rng(20_19)
_ADD = _RNG.integers(0, 1 << 32, (SKETCHES, 1), dtype=np.uint32)
_TIMES = _RNG.integers(0, 1 << 32, (SKETCHES, 1), dtype=np.uint32) | np.uint32(1)
_LAST = np.uint32(0xFFFFFFFF)
_ROWS = np.arange(SKETCHES)
_ROOM = np.empty((SKETCHES, _COLUMNS), np.uint32)


def numbered_kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """One 64-bit hash per k-mer of a text's code points, different for each occurrence.

    A text shorter than ``k``, even empty, is one k-mer.
    """
    n = len(points) - k + 1
    if n < 1:
        whole = ((points.astype(np.uint64) + np.uint64(1)) * powers(len(points))).sum(dtype=np.uint64)
        return mix(np.array([whole + np.uint64(len(points))], np.uint64))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers(len(points)), out=sums[1:])
    own = mix((sums[k:] - sums[:-k]) * powers(n, down=True))
    # Sort hash and place as one number: equal k-mers come together in text order.
    bits = np.uint64(max(1, (n - 1).bit_length()))
    places = np.uint64((1 << int(bits)) - 1)
    ordered = np.sort((own & ~places) | np.arange(n, dtype=np.uint64))
    same = np.zeros(n, bool)
    same[1:] = (ordered[1:] & ~places) == (ordered[:-1] & ~places)
    if not same.any():
        return own
    rank = np.arange(n)
    occurrence = rank - np.maximum.accumulate(np.where(same, 0, rank))
    again = occurrence > 0
    at = (ordered[again] & places).astype(np.int64)
    own[at] = mix(own[at] + occurrence[again].astype(np.uint64))
    return own


def signature(text: str) -> np.ndarray:
    """``SKETCHES`` components as 32-bit numbers; equal texts have equal ones."""
    own = numbered_kmers(np.frombuffer(text.encode("utf-32-le"), "<u4"))
    short = (own >> np.uint64(32)).astype(np.uint32)
    least, place = [], []
    for at in range(0, len(own), _COLUMNS):
        # The hashes are scrambled already: each function only permutes them anew.
        x = _ROOM[:, : min(_COLUMNS, len(own) - at)]
        np.bitwise_xor(short[None, at : at + _COLUMNS], _ADD, out=x)
        np.multiply(x, _TIMES, out=x)
        for _ in range(min(TUPLE, x.shape[1])):
            best = x.argmin(axis=1)
            least.append(x[_ROWS, best])
            place.append(best + at)
            x[_ROWS, best] = _LAST
    least, place = np.stack(least, axis=1), np.stack(place, axis=1)
    chosen = np.argsort(least, axis=1, kind="stable")[:, :TUPLE]
    in_text_order = np.sort(np.take_along_axis(place, chosen, axis=1), axis=1)
    out = np.full(SKETCHES, len(own) == 1, np.uint64)
    for j in range(in_text_order.shape[1]):
        out = mix(out * np.uint64(31) + own[in_text_order[:, j]] + np.uint64(j))
    return (out >> np.uint64(32)).astype(np.uint32)


def written(components: np.ndarray) -> str:
    return components.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components, 0 to 1."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fingerprint``) of every whole text; a null text is empty."""

    @F.arrow_udf("string")
    def printed(texts: pa.Array) -> pa.Array:
        return pa.array((written(signature(t.as_py())) for t in texts), pa.string())

    return docs.select(F.col(doc_id).alias("doc_id"), printed(F.coalesce(F.col(text), F.lit(""))).alias("fingerprint"))


def edit_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edit with the next document's beginning.

    The next document is the one with the next larger id; after the last comes the
    first, and a single document is followed by itself.  Null ids come first, rows of
    one id are in order of their text, null texts are empty.  Documents are dealt into
    ranges of ids; each range also gets a copy of the row that follows its last one.
    """
    rows, firsts = ordered_shards(docs, doc_id, text, shard_bytes)
    count = len(firsts) or 1
    first = F.col("ord").isin(firsts) if count < 100 else None
    if first is None:
        lows = docs.sparkSession.createDataFrame([(f,) for f in firsts], "low long")
        # One number per shard.
        rows = rows.join(F.broadcast(lows), F.col("ord") == F.col("low"), "left")
        first = F.col("low").isNotNull()
    copies = F.array_compact(
        F.array(
            F.struct(F.col("shard").alias("at"), F.lit(False).alias("follows")),
            F.when(first, F.struct(F.pmod(F.col("shard") - 1, F.lit(count)).alias("at"), F.lit(True).alias("follows"))),
        )
    )
    placed = rows.select("ord", "doc_id", "text", F.inline(copies)).repartitionById(count, F.col("at"))
    placed = placed.sortWithinPartitions("follows", "ord", "doc_id", "text").select("doc_id", "text", "follows")

    def read(batches):
        before = None
        ended = False
        for batch in slices(batches):
            out = []
            for one, whole, follows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ended:
                    break
                own = signature(whole)
                if before is not None:
                    last, past, print_ = before
                    changed = edited(past, whole)
                    other = signature(changed)
                    out.append((last, len(past), changed, print_, other, likeness(print_, other), likeness(print_, own)))
                before = (one, whole, own)
                ended = follows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int64()),
                    pa.array([o[1] for o in out], pa.int64()),
                    pa.array([o[2] for o in out], pa.string()),
                    pa.array([written(o[3]) for o in out], pa.string()),
                    pa.array([written(o[4]) for o in out], pa.string()),
                    pa.array([o[5] for o in out], pa.float64()),
                    pa.array([o[6] for o in out], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    made = placed.mapInArrow(
        read,
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
