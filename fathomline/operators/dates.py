"""Look-back predicates relative to an explicit reference day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_column(df: DataFrame, date: str, as_of=None) -> Column:
    """``as_of`` as a date column; the latest date of ``df`` when it is not given."""
    if as_of is None:
        return df.agg(F.max(date).cast("date").alias("as_of")).scalar()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date")


def days_back(as_of: Column, days: int = 0, months: int = 0) -> Column:
    """The day ``months`` months (clamped to month end) and ``days`` days before ``as_of``."""
    day = F.add_months(as_of, -months) if months else as_of
    return F.date_sub(day, days) if days else day


def since(df: DataFrame, date: str, as_of=None, days: int = 0, months: int = 0) -> Column:
    return F.col(date) >= days_back(as_of_column(df, date, as_of), days, months)


def utc_instant(ts: str) -> Column:
    """A zone-less time read as UTC, whatever the session time zone is."""
    second = F.expr(f"extract(SECOND FROM `{ts}`)")
    return F.make_timestamp_ltz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), second, F.lit("UTC")
    )


def zoned(df: DataFrame, ts: str, out: str) -> DataFrame:
    """``df`` with ``out``: the time ``ts`` as an instant, zone-less times read as UTC."""
    plain = df.schema[ts].dataType.typeName() == "timestamp_ntz"
    return df.withColumn(out, utc_instant(ts) if plain else F.col(ts))
