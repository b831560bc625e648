"""Toxicity classifier with counterfactual regularisation.

A linear model over hashed words and word beginnings.  In every labelled text that
names a group, each such sentence is written again with the group's name swapped for
another of the same list; training penalises the change of the score, so that a
neutral mention of a group is no evidence by itself.

Weights are not negative and sparse: harmless words never outweigh abuse, and a long
text does not gather a score from many weak words.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import fold_of, slices
from fathomline.llm.linear import Rows, fit_in_task, fit_logistic, list_rows, logistic
from fathomline.llm.words import chunks, mix, spans, text_bytes, word_hashes

#: Hash buckets of the model: its size whatever the corpus.
BUCKETS = 1 << 20
#: Labelled rows that training may read.
MAX_LABELLED = 20_000
#: Bytes of a word that count as its beginning.
BEGINNINGS = (4, 5, 6)
#: Features seen less often than this in the labelled rows, or less telling, get no weight.
LEAST_SEEN, LEAST_CHI2 = 3, 12.0
PAIR_WEIGHT = 1.0
#: Few texts are toxic, so a missed one counts more than a false alarm.  This weight and
#: L1 made the fewest errors, and of two such pairs the fewer misses, when each of the
#: four training folds of sf0.1 was predicted from the other three.
TOXIC_WEIGHT = 8.0
L1 = 0.8

#: Group names by list; a name is swapped for the next one of its list.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("woman", "man"),
    ("women", "men"),
    ("female", "male"),
    ("girl", "boy"),
    ("girls", "boys"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "transgender"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("old", "young"),
    ("deaf", "blind", "disabled"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)

_LETTERS = np.ones(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def batch_features(texts: pa.Array):
    """Yield per chunk of rows: rows, words per row, and a (kinds, words) table of buckets."""
    body, offsets = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    for row, end in chunks(offsets):
        raw = body[offsets[row] : offsets[end]]
        begin, finish, counts = spans(raw, np.diff(offsets[row : end + 1]), _LETTERS)
        made = [word_hashes(raw, begin, finish)]
        for length in BEGINNINGS:
            part = word_hashes(raw, begin, np.minimum(finish, begin + length))
            made.append(mix(part + np.uint64(length)))
        yield end - row, counts, (np.stack(made) & np.uint64(BUCKETS - 1)).astype(np.int32)


def feature_lists(texts: pa.Array) -> list[np.ndarray]:
    """The distinct buckets of every text; a null text has none."""
    out = []
    for rows, counts, table in batch_features(texts):
        ends = np.cumsum(counts)
        out += [np.unique(table[:, end - n : end]) for n, end in zip(counts, ends)]
    return out


def swap_terms(sentence: str, terms=IDENTITY_TERMS) -> str:
    """The sentence with every group name replaced by the next of its list."""
    after = {names[i]: names[(i + 1) % len(names)] for names in terms for i in range(len(names))}
    return _identity(terms).sub(lambda m: after[m[0].lower()], sentence)


def _identity(terms) -> re.Pattern:
    names = sorted({n for names in terms for n in names}, key=len, reverse=True)
    return re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, names)) + r")(?!\w)", re.IGNORECASE)


def counterfactual_sentences(text: str, terms=IDENTITY_TERMS) -> list[tuple[str, str]]:
    """Sentences that name a group, each with its swapped twin."""
    named = _identity(terms)
    if not named.search(text):
        return []
    found = [s for s in re.split(r"[.!?\n]+", text) if named.search(s)]
    return [(s, swap_terms(s, terms)) for s in found]


def _training(labelled: DataFrame, terms) -> DataFrame:
    """(label, buckets) of texts, and (null, added buckets, removed buckets) of sentence pairs."""

    def read(batches):
        for batch in slices(batches):
            texts, labels = batch.column(0), batch.column(1).to_pylist()
            own = feature_lists(texts)
            pairs = [p for t in texts.to_pylist() if t for p in counterfactual_sentences(t, terms)]
            left = feature_lists(pa.array([a for a, _ in pairs], pa.large_string()))
            right = feature_lists(pa.array([b for _, b in pairs], pa.large_string()))
            less = [np.setdiff1d(a, b, assume_unique=True) for a, b in zip(left, right)]
            more = [np.setdiff1d(b, a, assume_unique=True) for a, b in zip(left, right)]
            none = [np.zeros(0, np.int32)] * len(own)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*labels, *[None] * len(pairs)], pa.float64()),
                    pa.array([*own, *less], kind),
                    pa.array([*none, *more], kind),
                ],
                ["label", "buckets", "swapped"],
            )

    return labelled.select("text", "label").mapInArrow(read, "label double, buckets array<int>, swapped array<int>")


def _texts(part: pa.RecordBatch) -> tuple[Rows, np.ndarray]:
    """Feature rows and labels of the texts among rows of the training table."""
    texts = part.filter(part.column("label").is_valid())
    return list_rows(pa.chunked_array([texts.column("buckets")])), texts.column("label").to_numpy()


def _stacked(parts: list[Rows]) -> Rows:
    ends = np.cumsum([0, *[p.start[-1] for p in parts]])
    start = np.concatenate([[0], *[p.start[1:] + e for p, e in zip(parts, ends)]])
    return Rows(start.astype(np.int64), *[np.concatenate([getattr(p, n) for p in parts]) for n in ("column", "value")])


def _fit(pair_weight: float):
    def fit(table: pa.Table) -> tuple[np.ndarray, float]:
        # Few rows at a time: most features fall to the cuts, so only counts are whole.
        parts = [b for b in slices(table.to_batches(), 1024)]
        y = np.concatenate([b.column("label").drop_null().to_numpy(zero_copy_only=False) for b in parts])
        one, seen = np.zeros(BUCKETS), np.zeros(BUCKETS)
        for part in parts:
            rows, labels = _texts(part)
            seen += np.bincount(rows.column, minlength=BUCKETS)
            one += np.bincount(rows.column, np.repeat(labels, np.diff(rows.start)), minlength=BUCKETS)
        # Chi-square of feature against label: weights only where it is clearly not chance.
        total, ones = len(y), y.sum()
        expect = np.maximum(seen, 1) * ones / max(total, 1)
        spread = np.maximum(expect * (1 - ones / max(total, 1)) * (1 - seen / max(total, 1)), 1e-9)
        keep = (seen >= LEAST_SEEN) & ((one - expect) > 0) & ((one - expect) ** 2 / spread >= LEAST_CHI2)
        rows = _stacked([_texts(part)[0].kept(keep) for part in parts])
        is_text = table.column("label").is_valid().to_numpy()
        twins = table.filter(pa.array(~is_text))
        less, more = list_rows(twins.column("buckets")), list_rows(twins.column("swapped"))
        columns = int(keep.sum())
        weights, bias = fit_logistic(
            rows, y, columns, l1=L1, positive=True,
            pairs=_difference(less.kept(keep), more.kept(keep)), pair_weight=pair_weight,
            row_weights=np.where(y == 1, TOXIC_WEIGHT, 1.0),
        )
        whole = np.zeros(BUCKETS)
        whole[keep] = weights
        return whole, bias

    return fit


def _difference(less: Rows, more: Rows) -> Rows:
    """Row by row the entries of ``more`` minus those of ``less``."""
    owner = np.concatenate([np.repeat(np.arange(r.count), np.diff(r.start)) for r in (less, more)])
    order = np.argsort(owner, kind="stable")
    column = np.concatenate([less.column, more.column])[order]
    value = np.concatenate([-less.value, more.value])[order]
    start = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=less.count))])
    return Rows(start.astype(np.int64), column, value)


class ToxicityModel:
    """Weights of a fixed number of buckets, and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1; a feature counts once per text, however often it occurs."""
        out = []
        for rows, counts, table in batch_features(texts):
            owner = np.repeat(np.arange(rows), counts)
            hit = self.weights[table] > 0
            kind, word = np.nonzero(hit)
            pairs = np.unique(owner[word].astype(np.int64) * BUCKETS + table[kind, word])
            out.append(np.bincount(pairs // BUCKETS, self.weights[pairs % BUCKETS], minlength=rows))
        return logistic(np.concatenate(out) + self.bias) if out else np.zeros(0)


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    pair_weight: float = PAIR_WEIGHT,
    terms=IDENTITY_TERMS,
    seed: int = 0,
) -> ToxicityModel:
    """Fit on at most ``max_labelled`` labelled rows whose id is not in the held-out fold.

    Labels other than 0 and 1 and labels without a text are left out.  Without labels
    every score is 0.5 or less than that by the bias alone.
    """
    rows = labels.filter(F.col(label).isin(0, 1) & (fold_of(F.col(doc_id)) != 0))
    rows = rows.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("double").alias("label"))
    count = rows.count()
    if count > max_labelled:
        part = int((1 << 20) * max_labelled / count)
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "_id"), F.lit(1 << 20)) < part)
    # At most max_labelled ids and labels, so the side that is broadcast is bounded.
    rows = F.broadcast(rows.limit(max_labelled))
    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    labelled = named.join(rows, "_id").select("text", "label")
    return ToxicityModel(*fit_in_task(_training(labelled, terms), _fit(pair_weight), BUCKETS))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Score column for ``docs``; a null or empty text gets the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts), pa.float64())

    return scored(F.coalesce(F.col(text), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    rows = docs.select(
        F.col("doc_id"), (fold_of(F.col("doc_id")) == 0).alias("held_out"), score(docs, train(docs, labels)).alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    return docs.filter(score(docs, train(docs, labels)) < 0.5)
