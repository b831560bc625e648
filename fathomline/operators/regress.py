"""Supervised regression on price features with boosted trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.operators.boosting import TreeModel, search
from fathomline.operators.evaluate import holdout_metrics
from fathomline.operators.ranks import number_rows

# The full search grid, 3 * 3 * 2 * 2 * 2 = 72 combinations.
FULL_GRID = {
    "maxDepth": [3, 5, 7],
    "stepSize": [0.01, 0.1, 0.3],
    "maxIter": [100, 200],
    "minInstancesPerNode": [1, 3],
    "subsamplingRate": [0.8, 1.0],
}


def ordered_split(df: DataFrame, order: list, test: float = 0.2, out: str = "part") -> DataFrame:
    """Tag the last ``ceil(test * n)`` rows in ``order`` as ``test``, the others as ``train``."""
    numbered, n = number_rows(df, order, "_row", first=0)
    held = -int(-n * test // 1)
    return numbered.withColumn(
        out, F.when(F.col("_row") < n - held, "train").otherwise("test")
    ).drop("_row")


def assign_folds(df: DataFrame, order: list, k: int = 3, out: str = "fold") -> DataFrame:
    """Contiguous folds 0..k-1 in ``order``; the first ``n mod k`` folds get one row more."""
    numbered, n = number_rows(df, order, "_row", first=0)
    return numbered.withColumn(out, _fold(F.col("_row"), n, k)).drop("_row")


def _fold(row: Column, n: int, k: int) -> Column:
    size, extra = divmod(n, k)
    long_rows = extra * (size + 1)
    fold = F.when(row < long_rows, F.floor(row / (size + 1)))
    if size:
        fold = fold.otherwise(extra + F.floor((row - long_rows) / size))
    return fold.cast("int")


def standardize(df: DataFrame, cols: list[str], fit_on: DataFrame) -> DataFrame:
    """Centre and scale ``cols`` by mean and population deviation of ``fit_on``.

    A constant column is only centred.  The single row of statistics is the only
    thing that reaches the driver.
    """
    stats = fit_on.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    return df.withColumns({c: (F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) for c in cols})


def fit_regressor(
    df: DataFrame,
    features: list[str],
    label: str,
    grid: dict[str, list],
    folds: int = 3,
    order: list | None = None,
    test: float = 0.2,
    seed: int = 42,
) -> tuple[TreeModel, DataFrame]:
    """Boosted trees chosen by cross-validated MAE, and the hold-out metrics row.

    The split and the folds are contiguous in ``order``: the rows are sorted and numbered
    once, and both follow from the number.  ``TreeModel.sizes`` has the rows of each part.
    Trees compare values with cuts between them, so features need no scaling.
    """
    order = order or ["date", "symbol"]
    wanted = df.select(*dict.fromkeys([*order, *features, label])).dropna(subset=[*features, label])
    numbered, n = number_rows(wanted, order, "_row", first=0)
    held = -int(-n * test // 1)
    train = numbered.where(F.col("_row") < n - held).withColumn("_fold", _fold(F.col("_row"), n - held, folds))
    model = search(train, features, label, grid, folds, seed)
    model.sizes = {"train": n - held, "test": held}
    scored = model.transform(numbered.where(F.col("_row") >= n - held))
    return model, holdout_metrics(scored, label, "prediction")


def save_model(spark: SparkSession, model: TreeModel, path: str, version: str) -> str:
    target = f"{path.rstrip('/')}/{version}"
    model.save(spark, target)
    return target


def load_model(spark: SparkSession, path: str, version: str) -> TreeModel:
    return TreeModel.load(spark, f"{path.rstrip('/')}/{version}")
