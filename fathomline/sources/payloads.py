"""Daily-series payloads: JSON text to price rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key names of the payload.
META, SYMBOL = "Meta Data", "2. Symbol"
SERIES, ERROR, NOTE = "Time Series (Daily)", "Error Message", "Note"
FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}

PAYLOAD_SCHEMA = (
    f"`{META}` map<string,string>, `{SERIES}` map<string,map<string,string>>, "
    f"`{ERROR}` string, `{NOTE}` string"
)


def reject_reason(payload: Column) -> Column:
    """``error``, ``rate_limit`` or ``unexpected``; null for a good payload."""
    return (
        F.when(payload.getField(ERROR).isNotNull(), "error")
        .when(payload.getField(NOTE).isNotNull(), "rate_limit")
        .when(payload.getField(SERIES).isNull(), "unexpected")
    )


def parse_daily_series(
    df: DataFrame, payload_col: str, symbol: Column | None = None, run_ts: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Price rows of the good payloads, and one reject row per other payload.

    The symbol is read from the payload unless a column (for example one made from
    the file name) is given.
    """
    parsed = df.select(
        F.col(payload_col).alias("_raw"),
        F.from_json(payload_col, PAYLOAD_SCHEMA).alias("_p"),
        (F.lit(None).cast("string") if symbol is None else symbol).alias("_symbol"),
    ).withColumns(
        {
            "symbol": F.coalesce("_symbol", F.col("_p").getField(META).getItem(SYMBOL)),
            "_reason": reject_reason(F.col("_p")),
        }
    )
    days = parsed.where(F.col("_reason").isNull()).select(
        "symbol", F.explode(F.col("_p").getField(SERIES)).alias("_day", "_v")
    )
    kinds = {name: ("bigint" if name == "volume" else "double") for name in FIELDS}
    rows = days.select(
        "symbol",
        F.col("_day").try_cast("date").alias("date"),
        *[F.col("_v").getItem(key).try_cast(kinds[name]).alias(name) for name, key in FIELDS.items()],
        (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp_ntz").alias("ingested_at"),
    )
    message = F.coalesce(F.col("_p").getField(ERROR), F.col("_p").getField(NOTE), F.col("_raw"))
    rejects = parsed.where(F.col("_reason").isNotNull()).select(
        "symbol", F.col("_reason").alias("reason"), message.alias("message")
    )
    return rows, rejects


def daily_payload(bars: DataFrame, *period: Column) -> DataFrame:
    """Price rows as payload texts, one per symbol and ``period`` (at most one entry per day)."""
    fields = F.map_from_arrays(
        F.array(*[F.lit(key) for key in FIELDS.values()]),
        F.array(*[F.col(name).cast("string") for name in FIELDS]),
    )
    entry = F.struct(F.col("date").cast("string").alias("day"), fields.alias("values"))
    grouped = bars.groupBy("symbol", *period).agg(F.collect_list(entry).alias("entries"))
    body = F.struct(
        F.create_map(F.lit(SYMBOL), F.col("symbol")).alias(META),
        F.map_from_entries("entries").alias(SERIES),
    )
    return grouped.select("symbol", F.to_json(body).alias("payload"))
