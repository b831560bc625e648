"""Sparse logistic regression on a bounded training table, and hashed-feature scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Rows:
    """Sparse rows: ``start`` has one more entry than there are rows."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray

    @property
    def count(self) -> int:
        return len(self.start) - 1

    def times(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(weights[self.column] * self.value)])
        return sums[self.start[1:]] - sums[self.start[:-1]]

    def back(self, by_row: np.ndarray, columns: int) -> np.ndarray:
        spread = np.repeat(by_row, np.diff(self.start)) * self.value
        return np.bincount(self.column, spread, minlength=columns)

    def kept(self, keep: np.ndarray) -> Rows:
        """Only the columns of ``keep``, numbered anew."""
        number = np.cumsum(keep) - 1
        ok = keep[self.column]
        start = np.concatenate([[0], np.cumsum(ok)])[self.start]
        return Rows(start, number[self.column[ok]], self.value[ok])


def list_rows(columns: pa.ChunkedArray, values: pa.ChunkedArray | None = None) -> Rows:
    """Rows from Arrow lists; without ``values`` every entry is 1."""
    whole = columns.combine_chunks()
    start = whole.offsets.to_numpy().astype(np.int64)
    flat = whole.flatten().to_numpy().astype(np.int64)
    if values is None:
        return Rows(start - start[0], flat, np.ones(len(flat)))
    return Rows(start - start[0], flat, values.combine_chunks().flatten().to_numpy().astype(np.float64))


def fit_logistic(
    rows: Rows,
    labels: np.ndarray,
    columns: int,
    l1: float = 0.0,
    l2: float = 0.0,
    positive: bool = False,
    pairs: Rows | None = None,
    pair_weight: float = 0.0,
    steps: int = 400,
    row_weights: np.ndarray | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise logistic loss (soft labels allowed) plus penalties.

    ``pairs`` are differences of two feature rows whose scores should agree; the
    square of each score difference costs ``pair_weight``.  ``row_weights``: what each
    row counts in the loss, one by default.  Accelerated proximal
    gradient with a diagonal bound of the curvature, so no step size is chosen.
    """
    if not rows.count:
        return np.zeros(columns), 0.0
    paired = pairs is not None and pairs.count and pair_weight > 0
    counts = np.ones(rows.count) if row_weights is None else row_weights
    reach = counts * (Rows(rows.start, rows.column, np.abs(rows.value)).times(np.ones(columns)) + 1.0)
    curve = 0.25 * Rows(rows.start, rows.column, np.abs(rows.value)).back(reach, columns)
    if paired:
        size = Rows(pairs.start, pairs.column, np.abs(pairs.value))
        curve += 2 * pair_weight * size.back(size.times(np.ones(columns)), columns)
    step, bias_step = 1.0 / (curve + l2 + 1e-9), 1.0 / (0.25 * reach.sum())
    weights = ahead = np.zeros(columns)
    bias = bias_ahead = 0.0
    speed = 1.0
    for _ in range(steps):
        wrong = 1.0 / (1.0 + np.exp(-np.clip(rows.times(ahead) + bias_ahead, -35, 35))) - labels
        wrong *= counts
        slope = rows.back(wrong, columns) + l2 * ahead
        if paired:
            slope += 2 * pair_weight * pairs.back(pairs.times(ahead), columns)
        moved = ahead - step * slope
        moved = np.maximum(moved - step * l1, 0) if positive else np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        bias_moved = bias_ahead - bias_step * wrong.sum()
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        pull = (speed - 1) / faster
        ahead, bias_ahead = moved + pull * (moved - weights), bias_moved + pull * (bias_moved - bias)
        weights, bias, speed = moved, bias_moved, faster
    return weights, float(bias)


def fit_in_task(table: DataFrame, fit, columns: int) -> tuple[np.ndarray, float]:
    """Run ``fit(pyarrow table) -> (weights, bias)`` in one task over a bounded table."""

    def train(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            weights, bias = fit(pa.Table.from_batches(held))
        else:
            weights, bias = np.zeros(columns), 0.0
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([bias], pa.float64())], ["weights", "bias"]
        )

    found = table.repartition(1).mapInArrow(train, "weights binary, bias double").first()
    return np.frombuffer(found["weights"], "<f4").astype(np.float64), found["bias"]


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def sampled_texts(rows: DataFrame, bound: int, seed: int = 0) -> DataFrame:
    """(text, copies): a seeded sample of about ``bound`` distinct texts, all of them if there are fewer.

    The draw is over texts, not rows, so a text that many rows hold takes one place, with
    its number of rows as weight; copies are counted before they are shuffled.
    """
    distinct = rows.agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).first()["n"]
    if distinct > bound:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 20)) < int((1 << 20) * bound / distinct))
    return rows.groupBy("text").agg(F.count("*").alias("copies"))
