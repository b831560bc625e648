"""Token cost and usage roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage_cost(usage: DataFrame, rates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cost per model at the given rates per million tokens, and models without a rate.

    Tokens are summed per model before the join, so one busy model is one row by
    the time rows move.
    """
    totals = usage.groupBy("model").agg(
        F.count("*").alias("requests"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
    )
    known = rates.select("model", "input_rate", "output_rate")
    cost = (
        F.col("input_tokens") * F.col("input_rate") + F.col("output_tokens") * F.col("output_rate")
    ) / 1_000_000
    priced = totals.join(known, "model").select(*totals.columns, cost.alias("estimated_usd"))
    return priced, totals.join(known, "model", "left_anti")


def usage_by_day(usage: DataFrame, functions: list[str] | None = None) -> DataFrame:
    """Requests and credits per day, newest first; only the given functions if any."""
    if functions is not None:
        usage = usage.where(F.col("function_name").isin(functions))
    return (
        usage.groupBy(F.to_date("start_time").alias("day"))
        .agg(F.count("*").alias("requests"), F.sum("credits_used").alias("total_credits"))
        .orderBy(F.desc("day"))
    )
