"""Filing feeds: XML entries to filing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY_SCHEMA = "`title` string, `filing-href` string, `filing-date` string, `summary` string"
UNKNOWN = "UNKNOWN"


def cik_from_link(link: Column) -> Column:
    """Second-last path segment of the link."""
    return F.try_element_at(F.split(link, "/"), F.lit(-2))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The ``entry`` elements of all feed files below ``path``."""
    return spark.read.schema(ENTRY_SCHEMA).xml(path, rowTag="entry", ignoreSurroundingSpaces=False)


def parse_entries(
    entries: DataFrame,
    form_type: Column | str,
    cap: int | None = None,
    as_of: Column | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """Filing rows of feed entries; entries whose date cannot be read are skipped."""
    today = F.current_date() if as_of is None else as_of
    text = F.coalesce("summary", F.lit(""))
    given = F.col("filing-date")
    link = F.col("filing-href")
    return entries.select(
        F.when(link.isNull(), UNKNOWN).otherwise(cik_from_link(link)).alias("cik"),
        F.coalesce("title", F.lit(UNKNOWN)).alias("company_name"),
        (F.lit(form_type) if isinstance(form_type, str) else form_type).alias("form_type"),
        F.when(given.isNull(), today).otherwise(F.trim(given).try_cast("date")).alias("filing_date"),
        (text if cap is None else F.substring(text, 1, cap)).alias("filing_text"),
        F.coalesce(link, F.lit("")).alias("url"),
        (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp_ntz").alias("ingested_at"),
    ).where(F.col("cik").isNotNull() & F.col("filing_date").isNotNull())


def parse_filing_feed(
    spark: SparkSession,
    path: str,
    form_type: str,
    count: int | None = None,
    cap: int | None = None,
    as_of: Column | None = None,
    run_ts: Column | None = None,
) -> DataFrame:
    """Filing rows of a feed; ``count`` keeps the newest only.

    A feed file is one reply of the service and is read by one task.
    """
    rows = parse_entries(read_feed(spark, path), form_type, cap, as_of, run_ts)
    return rows if count is None else rows.orderBy(F.desc("filing_date"), "url").limit(count)
