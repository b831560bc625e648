"""Declared schemas of the base tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


PRICES = _schema(
    ("symbol", T.StringType()),
    ("date", T.DateType()),
    ("open", T.DoubleType()),
    ("high", T.DoubleType()),
    ("low", T.DoubleType()),
    ("close", T.DoubleType()),
    ("volume", T.LongType()),
    ("ingested_at", T.TimestampNTZType()),
)

FILINGS = _schema(
    ("cik", T.StringType()),
    ("company_name", T.StringType()),
    ("form_type", T.StringType()),
    ("filing_date", T.DateType()),
    ("filing_text", T.StringType()),
    ("url", T.StringType()),
    ("ingested_at", T.TimestampNTZType()),
)

REAL_ESTATE = _schema(
    ("region_name", T.StringType()),
    ("date", T.DateType()),
    ("zhvi", T.DoubleType()),
    ("median_sale_price", T.DoubleType()),
    ("inventory_count", T.LongType()),
    ("ingested_at", T.TimestampNTZType()),
)

PREDICTIONS = _schema(
    ("symbol", T.StringType()),
    ("prediction_date", T.DateType()),
    ("predicted_close", T.DoubleType()),
    ("confidence_interval_low", T.DoubleType()),
    ("confidence_interval_high", T.DoubleType()),
    ("model_version", T.StringType()),
    ("created_at", T.TimestampNTZType()),
)

SUMMARIES = T.StructType(
    [T.StructField("filing_id", T.LongType(), False)]
    + _schema(
        ("cik", T.StringType()),
        ("company_name", T.StringType()),
        ("form_type", T.StringType()),
        ("filing_date", T.DateType()),
        ("original_text", T.StringType()),
        ("ai_summary", T.StringType()),
        ("sentiment", T.StringType()),
        ("sentiment_score", T.DoubleType()),
        ("classification", T.StringType()),
        ("processed_at", T.TimestampNTZType()),
    ).fields
)

RUN_LOG = _schema(
    ("name", T.StringType()),
    ("state", T.StringType()),
    ("scheduled_time", T.TimestampNTZType()),
    ("completed_time", T.TimestampNTZType()),
    ("error_code", T.StringType()),
    ("error_message", T.StringType()),
)
