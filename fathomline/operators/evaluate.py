"""Back-tests, error metrics and price reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators.dates import since


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest ``order`` per ``key``, in one pass with map-side reduction."""
    rest = [c for c in df.columns if c not in (key, order)]
    row = F.max(F.struct(order, *rest)).alias("_row")
    return df.groupBy(key).agg(row).select(key, "_row.*").select(*df.columns)


def backtest(actuals: DataFrame, predictions: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Actual prices of the last ``days`` days next to the prediction for that day."""
    recent = actuals.where(since(actuals, "date", as_of, days=days)).select(
        "symbol", "date", F.col("close").alias("actual_price")
    )
    made = predictions.where(F.col("predicted_close").isNotNull()).select(
        "symbol", F.col("prediction_date").alias("date"), "predicted_close"
    )
    error = F.abs(F.col("actual_price") - F.col("predicted_close"))
    return recent.join(made, ["symbol", "date"]).select(
        "symbol",
        "date",
        "actual_price",
        "predicted_close",
        error.alias("absolute_error"),
        (F.try_divide(error, F.col("actual_price")) * 100).alias("percent_error"),
    )


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def error_metrics(tested: DataFrame, by: str = "symbol", digits: int | None = None) -> DataFrame:
    """Count, mean absolute, root mean squared and mean percent error, best first."""
    return (
        tested.groupBy(by)
        .agg(
            F.count("*").alias("num_predictions"),
            _rounded(F.avg("absolute_error"), digits).alias("mae"),
            _rounded(F.sqrt(F.avg(F.pow("absolute_error", F.lit(2)))), digits).alias("rmse"),
            _rounded(F.avg("percent_error"), digits).alias("mape"),
        )
        .orderBy(F.col("mape").asc_nulls_last(), by)
    )


def holdout_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: n, MAE, RMSE, MAPE and R2 of ``predicted`` against ``actual``."""
    y, error = F.col(actual), F.col(actual) - F.col(predicted)
    squares = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    return df.where(y.isNotNull() & F.col(predicted).isNotNull()).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(error, y))) * 100).alias("mape"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
    )


def latest_stats(df: DataFrame, as_of=None, months: int = 1) -> DataFrame:
    """Last date, mean and sample deviation of the close per symbol over the last months."""
    return df.where(since(df, "date", as_of, months=months)).groupBy("symbol").agg(
        F.max("date").alias("last_date"),
        F.avg("close").alias("avg_price"),
        F.stddev_samp("close").alias("price_stddev"),
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.countDistinct("symbol").alias("num_stocks"),
        F.count("*").alias("num_predictions"),
        F.max("created_at").alias("last_run"),
        F.avg("predicted_close").alias("avg_predicted_price"),
    )


def actual_vs_predicted(actuals: DataFrame, predictions: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Recent actual prices and all predictions as one tagged series."""
    recent = actuals.where(since(actuals, "date", as_of, days=days)).select(
        "symbol", "date", F.col("close").alias("price"), F.lit("actual").alias("type")
    )
    made = predictions.select(
        "symbol",
        F.col("prediction_date").alias("date"),
        F.col("predicted_close").alias("price"),
        F.lit("predicted").alias("type"),
    )
    return recent.unionByName(made)


def ingest_profile(df: DataFrame, by: str = "symbol", date: str = "date") -> DataFrame:
    """Rows and date range per group, one pass."""
    return df.groupBy(by).agg(
        F.count("*").alias("num_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def feature_profile(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Distinct keys and row count in one pass."""
    return df.agg(F.countDistinct(key).alias("num_symbols"), F.count("*").alias("num_rows"))
