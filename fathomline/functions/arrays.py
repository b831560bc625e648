"""Small helpers over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def run_lengths(ordered: Column) -> Column:
    """Lengths of runs of equal neighbours in a sorted array, as structs (value, n)."""

    def runs(a: Column) -> Column:
        starts = F.filter(
            F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>")),
            lambda i: (i == 0) | (F.get(a, i) != F.get(a, i - 1)),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda at, i: F.struct(
                    F.get(a, at).alias("value"),
                    (F.coalesce(F.get(s, i + 1), F.size(a)) - at).alias("n"),
                ),
            ),
        )

    return let(ordered, runs)
