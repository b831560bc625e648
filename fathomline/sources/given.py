"""The given star-schema, event and text tables seen as prices, filings, turns and usage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_FILING_DAY = "2024-01-01"
#: The stored column that filings show as their text.
FILING_TEXT = "text"
TURN_PLACES = 1_000_000_000
# A fixed ingestion stamp keeps results comparable between runs.
LOADED_AT = "2024-12-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices(spark: SparkSession, sf_dir: str, first_day: dt.date | None = None) -> DataFrame:
    """Daily bars per brand: first, highest, lowest and last unit price, and quantity.

    The (order, line) number places sales within a day.  Order and price are packed
    into one decimal, which keeps the aggregation a hash aggregation with map-side
    partial results.  (symbol, date) is unique by construction.  ``first_day`` is a
    bound on the stored column, so it reaches the parquet filter.
    """
    sold = table(spark, sf_dir, "lineitem")
    if first_day is not None:
        sold = sold.where(F.col("l_shipdate") >= F.lit(first_day).cast(sold.schema["l_shipdate"].dataType))
    items = sold.select(
        "l_partkey",
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(20,0)").alias("k"),
        "l_quantity",
    )
    brands = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("symbol"))
    sales = items.join(brands, F.col("l_partkey") == F.col("p_partkey")).withColumn(
        "place",
        (F.col("k") * 10**18 + F.floor(F.col("price") * 1_000_000).cast("decimal(18,0)")).cast(
            "decimal(38,0)"
        ),
    )
    return sales.groupBy("symbol", "date").agg(
        F.min_by("price", "place").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "place").alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )


def last_price_day(spark: SparkSession, sf_dir: str) -> Column:
    """Latest day with a sale, as a scalar; reads one column."""
    return table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").cast("date").alias("d")).scalar()


def day_back(spark: SparkSession, sf_dir: str, days: int) -> dt.date:
    """The day ``days`` days before the latest sale; the driver reads that one value."""
    last = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").cast("date").alias("d")).first()["d"]
    return last - dt.timedelta(days=days)


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as filings: one company per source, one form type per language."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("cik"),
        F.col("source").alias("company_name"),
        F.col("lang").alias("form_type"),
        F.date_add(F.lit(FIRST_FILING_DAY).cast("date"), (F.col("doc_id") % 365).cast("int")).alias("filing_date"),
        F.col("text").alias("filing_text"),
        F.concat(F.lit("https://files/data/"), F.col("doc_id").cast("string"), F.lit("/index.htm")).alias("url"),
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def marked(marks: list[str], number: Column, text: str) -> Column:
    """``text`` after the mark whose turn it is by ``number``; nothing is put before every last one."""
    mark = F.element_at(F.array(*[F.lit(m) for m in marks], F.lit("")), (F.pmod(number, F.lit(len(marks) + 1)) + 1).cast("int"))
    return F.concat(mark, F.col(text))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as review comments; an assistant turn replies to the one before."""
    # Far more places than a conversation has turns, so ids of two conversations never meet.
    number = F.col("conv_id") * TURN_PLACES + F.col("turn")
    login = (
        F.when(F.col("role") == "assistant", "Assistant[bot]")
        .when(F.col("role") == "system", "sys-bot")
        .otherwise(F.col("role"))
    )
    return turns(spark, sf_dir).select(
        number.alias("id"),
        F.when((F.col("role") == "assistant") & (F.col("turn") > 0), number - 1).alias("in_reply_to_id"),
        login.alias("user_login"),
        F.col("text").alias("body"),
        F.concat(F.lit("src/"), F.col("conv_id").cast("string")).alias("path"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("model"),
        F.col("event_type").alias("function_name"),
        (F.col("value") * 100).cast("bigint").alias("input_tokens"),
        (F.col("value") * 10).cast("bigint").alias("output_tokens"),
        F.col("value").alias("credits_used"),
        F.col("ts").alias("start_time"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.col("value") > 50
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("name"),
        F.when(failed, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.col("ts").alias("scheduled_time"),
        F.when(failed, "E1").alias("error_code"),
    )
