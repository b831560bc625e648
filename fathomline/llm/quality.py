"""Quality classifier without labels: a weak-label model and a hashed linear scorer.

Heuristic labellers vote poor, fine or nothing on every document.  Expectation
maximisation over the counts of all vote patterns estimates how each labeller votes
on poor and on fine documents, and so the probability that a pattern is poor.  Those
posteriors are the labels on which a linear scorer over hashed word shapes and
statistics is trained; the scorer decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import slices
from fathomline.llm.linear import fit_in_task, fit_logistic, list_rows, logistic, sampled_texts
from fathomline.llm.words import batch_bytes, mix, spans, word_hashes

#: Hash buckets of the scorer: its size whatever the corpus.
BUCKETS = 1 << 16
#: Documents that training of the scorer may read; the vote counts cover all documents.
MAX_TRAINING = 20_000
#: Weight of the presumption that labellers are right, as a share of all documents.
TRUST = 0.02
#: Steps into which a statistic is cut for the scorer.
STEPS = 20

#: Shares of words say little about fewer words than this: those labellers then abstain.
FEW_WORDS = 20
_OF_WORDS = ("repeats", "bare_words", "distinct_share", "short_share", "stops")

#: Statistic, and its bounds: (poor below, fine from, fine up to, poor above).
#: Between poor and fine a labeller abstains.  None: no such bound.  Labellers that look
#: for one flaw do not call a document fine for lack of it; those in ``PROSE`` do.
LABELLERS: dict[str, tuple[float | None, float, float, float | None]] = {
    "upper_share": (None, 0.0, 0.15, 0.5),
    "exclamations": (None, 0.0, 0.05, 0.3),
    "symbols": (None, 0.0, 0.05, 0.3),
    "pipes": (None, 0.0, 0.02, 0.15),
    "bare_words": (None, 0.0, 0.05, 0.2),
    "repeats": (None, 0.0, 0.05, 0.2),
    "distinct_share": (0.2, 0.45, 1.0, None),
    "short_share": (0.05, 0.15, 0.55, 0.8),
    "stops": (0.005, 0.03, 0.35, 1.0),
    "word_length": (2.0, 3.5, 8.0, 14.0),
    "digit_share": (None, 0.0, 0.1, 0.3),
}

PROSE = ("distinct_share", "short_share", "stops")

_BYTES = np.arange(256)
_CONTINUED = (_BYTES & 0xC0) == 0x80
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 0xC0)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SYMBOL = np.isin(_BYTES, [ord(c) for c in "%$#*&@^~=+_{}[]\\<>"])
_SHAPE = np.where(_LETTER | _CONTINUED, ord("a"), np.where(_DIGIT, ord("0"), _BYTES)).astype(np.uint8)
_SHAPE[_UPPER] = ord("A")


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _distinct(values: np.ndarray) -> int:
    values = np.sort(values)
    return int((values[1:] != values[:-1]).sum()) + (len(values) > 0)


def batch_statistics(texts: pa.Array):
    """Yield per chunk: a dict of statistics per row, words per row and word-shape hashes."""
    for raw, offsets in batch_bytes(texts):
        begin, finish, words = spans(raw, np.diff(offsets))
        each = lambda flags: np.diff(_sums(flags)[offsets])
        upper = _UPPER[raw]
        # U+00C0 to U+00DE: capital letters of two bytes.
        upper[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        start = ~_CONTINUED[raw]
        points = _sums(start)[finish] - _sums(start)[begin]
        lettered = _sums((_LETTER | _DIGIT)[raw])
        lettered = lettered[finish] - lettered[begin]
        hashes = word_hashes(raw, begin, finish)
        ends = np.cumsum(words)
        again = np.zeros(len(hashes), bool)
        again[1:] = hashes[1:] == hashes[:-1]
        again[(ends - words)[words > 0]] = False
        distinct = np.array([_distinct(hashes[e - n : e]) for n, e in zip(words, ends)], np.int64)
        of_words = lambda flags: np.diff(_sums(flags)[np.concatenate([[0], ends])])
        n, letters = np.maximum(words, 1), np.maximum(each(_LETTER[raw]), 1)
        found = {
            "upper_share": each(upper) / letters,
            "exclamations": each(raw == ord("!")) / n,
            "symbols": each(_SYMBOL[raw]) / n,
            "pipes": each(raw == ord("|")) / n,
            "bare_words": of_words(lettered == 0) / n,
            "repeats": of_words(again) / n,
            "distinct_share": distinct / n,
            "short_share": of_words(points <= 3) / n,
            "stops": each(np.isin(raw, [ord("."), ord("!"), ord("?")])) / n,
            "word_length": each(_LETTER[raw]) / n,
            "digit_share": each(_DIGIT[raw]) / np.maximum(each(start), 1),
        }
        shape = _SHAPE[raw]
        kept = np.ones(len(raw), bool)
        kept[1:] = shape[1:] != shape[:-1]
        kept[begin] = True
        place = _sums(kept)
        yield found, words, word_hashes(shape[kept], place[begin], place[finish], fold=False)


def votes(found: dict[str, np.ndarray], words: np.ndarray) -> np.ndarray:
    """Per row and labeller 0 (nothing), 1 (fine) or 2 (poor); a text without words gets no votes."""
    out = np.zeros((len(words), len(LABELLERS)), np.int64)
    for j, (name, (poor_low, fine_low, fine_high, poor_high)) in enumerate(LABELLERS.items()):
        x = found[name]
        if name in PROSE:
            out[:, j] = (x >= fine_low) & (x <= fine_high)
        if poor_low is not None:
            out[x < poor_low, j] = 2
        if poor_high is not None:
            out[x > poor_high, j] = 2
        if name in _OF_WORDS:
            out[words < FEW_WORDS, j] = 0
    out[words == 0] = 0
    return out


_PLACES = 3 ** np.arange(len(LABELLERS))


def _features(found, words, shapes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed statistics, one step each, per row; hashed shape per word."""
    steps = []
    for j, name in enumerate(LABELLERS):
        poor_low, _, fine_high, poor_high = LABELLERS[name]
        top = 1.5 * (poor_high or fine_high)
        step = np.clip(found[name] / top * STEPS, 0, STEPS).astype(np.int64)
        steps.append(mix((step + 1000 * (j + 1)).astype(np.uint64)) & np.uint64(BUCKETS - 1))
    return np.stack(steps, axis=1).astype(np.int32), (shapes & np.uint64(BUCKETS - 1)).astype(np.int32)


def _feature_lists(found, words, shapes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Buckets and values per row: 1 for a statistic's step, the share of words for a shape."""
    steps, buckets = _features(found, words, shapes)
    columns, values = [], []
    for i, end in enumerate(np.cumsum(words)):
        own, count = np.unique(buckets[end - words[i] : end], return_counts=True)
        columns.append(np.concatenate([steps[i], own]))
        values.append(np.concatenate([np.ones(steps.shape[1]), count / max(1, words[i])]))
    return columns, values


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> dict:
    """Expectation maximisation over vote patterns.

    Returns the share of poor documents, each labeller's vote probabilities for poor
    and fine documents, and the posterior of every pattern.  A document with any poor
    vote starts as more likely poor than not.  Labellers are presumed better than
    chance: each gets ``TRUST`` of the documents as right votes in either class, so
    one that overlaps with no other still counts.
    """
    trust = TRUST * counts.sum() + 0.5
    poor = 1 - 0.4 ** (patterns == 2).sum(axis=1)
    poor = np.clip(np.where((patterns == 2).any(axis=1), np.maximum(poor, 0.6), 0.05), 0.01, 0.99)
    for _ in range(rounds):
        share = float(np.clip((poor * counts).sum() / max(counts.sum(), 1), 1e-4, 1 - 1e-4))
        table = np.zeros((2, patterns.shape[1], 3))
        for vote in range(3):
            cast = (patterns == vote) * counts[:, None]
            table[1, :, vote] = (cast * poor[:, None]).sum(axis=0) + 0.5
            table[0, :, vote] = (cast * (1 - poor)[:, None]).sum(axis=0) + 0.5
        table[1, :, 2] += trust
        table[0, :, 1] += trust
        table /= table.sum(axis=2, keepdims=True)
        # An abstention is no evidence: only the two votes are compared.
        odds = np.log(table[1] / table[0])
        odds[:, 0] = 0
        each = odds[np.arange(patterns.shape[1]), patterns]
        poor = logistic(np.log(share / (1 - share)) + each.sum(axis=1))
    return {"share": share, "votes": table, "posterior": poor}


class QualityModel:
    """Vote probabilities, and the scorer's weights of a fixed number of buckets."""

    def __init__(self, weights: np.ndarray, bias: float, weak: dict[int, float], estimated: dict):
        self.weights, self.bias, self.weak, self.estimated = weights, bias, weak, estimated

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability that a text is fine; one without words is not."""
        out = []
        for found, words, shapes in batch_statistics(texts):
            steps, buckets = _features(found, words, shapes)
            of_shapes = np.bincount(np.repeat(np.arange(len(words)), words), self.weights[buckets], minlength=len(words))
            z = self.bias + self.weights[steps].sum(axis=1) + of_shapes / np.maximum(words, 1)
            out.append(np.where(words > 0, 1 - logistic(z), 0.0))
        return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, text: str = "text", max_training: int = MAX_TRAINING, seed: int = 0) -> QualityModel:
    """Estimate the labellers on all documents and fit the scorer on at most about ``max_training`` texts."""
    rows = docs.select(F.col(text).alias("text")).filter("text is not null")

    def patterns(batches):
        for batch in slices(batches):
            for found, words, _ in batch_statistics(batch.column(0)):
                codes, n = np.unique(votes(found, words)[words > 0] @ _PLACES, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    # At most 3 ** labellers patterns, whatever the number of documents.
    counted = rows.mapInArrow(patterns, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    codes = np.array(sorted(r["code"] for r in counted), np.int64)
    of = {r["code"]: r["n"] for r in counted}
    table = codes[:, None] // _PLACES % 3
    estimated = estimate(table, np.array([of[c] for c in codes.tolist()], np.float64))
    weak = dict(zip(codes.tolist(), estimated["posterior"].tolist()))

    def read(batches):
        for batch in slices(batches):
            copies, row = batch.column(1), 0
            for found, words, shapes in batch_statistics(batch.column(0)):
                columns, values = _feature_lists(found, words, shapes)
                label = [weak.get(c, 0.5) for c in (votes(found, words) @ _PLACES).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(label, pa.float64()),
                        pa.array(columns, pa.list_(pa.int32())),
                        pa.array(values, pa.list_(pa.float64())),
                        copies.slice(row, len(label)),
                    ],
                    ["label", "columns", "values", "copies"],
                )
                row += len(label)

    def fit(found: pa.Table):
        made = list_rows(found.column("columns"), found.column("values"))
        weights = found.column("copies").to_numpy().astype(np.float64)
        return fit_logistic(made, found.column("label").to_numpy(), BUCKETS, l2=1.0, row_weights=weights)

    training = sampled_texts(rows, max_training, seed).mapInArrow(
        read, "label double, columns array<int>, values array<double>, copies long"
    )
    return QualityModel(*fit_in_task(training, fit, BUCKETS), weak, estimated)


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> Column:
    """Score column: the probability that the text is fine; null and wordless texts get 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts), pa.float64())

    return scored(F.coalesce(F.col(text), F.lit("")))


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, score, keep) for every row of ``docs``; kept from a score of 0.5."""
    return docs.select("doc_id", score(docs, train(docs)).alias("score")).withColumn("keep", F.col("score") >= 0.5)


def drop_poor(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the scorer keeps, with all their columns."""
    return docs.filter(score(docs, train(docs)) >= 0.5)
