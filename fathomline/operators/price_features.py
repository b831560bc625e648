"""Rolling price features per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.dates import since
from fathomline.operators.ranks import overlapping_chunks

REGRESSOR_FEATURES = [
    "ma_7", "ma_30", "momentum_1d", "momentum_7d", "volatility_7d", "volume_momentum",
    "day_of_week", "open", "high", "low", "close", "volume",
]

_REACH_BACK, _REACH_AHEAD = 30, 1


def day_of_week(date: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(date) - 1).cast("bigint")


def percent_change(value: Column, base: Column) -> Column:
    return F.try_divide(value - base, base) * 100


def feature_columns(series: list[str], ts: str, target: str, inclusive: bool = False) -> dict[str, Column]:
    """Feature expressions that all share one window ordering (one sort).

    The default frames hold the current row plus 7 or 30 rows before it, that is
    8 and 31 rows; ``inclusive=True`` gives 7 and 30.
    """
    w = Window.partitionBy(*series).orderBy(ts)
    edge = 1 if inclusive else 0
    week = w.rowsBetween(edge - 7, 0)
    month = w.rowsBetween(edge - 30, 0)
    close, volume = F.col("close"), F.col("volume").cast("double")
    prev_1, prev_7 = F.lag("close", 1).over(w), F.lag("close", 7).over(w)
    avg_volume = F.avg(volume).over(week)
    columns = {
        "ma_7": F.avg(close).over(week),
        "ma_30": F.avg(close).over(month),
        "momentum_1d": percent_change(close, prev_1),
        "momentum_7d": percent_change(close, prev_7),
        "volatility_7d": F.stddev_samp(close).over(week),
        "volume_momentum": F.try_divide(volume - avg_volume, avg_volume),
        "day_of_week": day_of_week(F.col(ts)),
    }
    if target == "same_day":
        columns |= {"prev_close": prev_1, "target_price": close}
    elif target == "next_day":
        columns |= {
            "prev_close_1d": prev_1,
            "prev_close_7d": prev_7,
            "avg_volume_7d": avg_volume,
            "target_price": F.lead("close", 1).over(w),
        }
    else:
        raise ValueError("target is 'same_day' or 'next_day'")
    return columns


def price_features(
    df: DataFrame,
    as_of=None,
    lookback: dict | None = None,
    target: str = "next_day",
    dropna: bool = True,
    subset: list[str] | None = None,
    inclusive: bool = False,
    series: str = "symbol",
    ts: str = "date",
    layout: str = "ranged",
    chunk_rows: int = 200_000,
) -> DataFrame:
    """Add moving averages, momentum, volatility, relative volume and the target.

    ``lookback`` is ``{"months": n}`` or ``{"days": n}`` counted back from ``as_of``
    and applied before the windows.  ``dropna`` drops rows with a null in any column
    (or in ``subset``) for the next-day target.

    ``layout="ranged"`` cuts the ordered rows into equal overlapping chunks, so a
    series holding a large share of all rows is spread over many tasks.
    ``layout="keyed"`` uses one window partition per series and saves that sort; use
    it where (series, ts) is unique with a daily ``ts``, which bounds a series by the
    number of calendar days.
    """
    if lookback:
        df = df.where(since(df, ts, as_of, **lookback))
    if layout == "ranged":
        placed = overlapping_chunks(df, [series, ts], _REACH_BACK, _REACH_AHEAD, chunk_rows)
        keys = [series, "_chunk"]
    elif layout == "keyed":
        placed, keys = df, [series]
    else:
        raise ValueError("layout is 'ranged' or 'keyed'")
    out = placed.withColumns(feature_columns(keys, ts, target, inclusive))
    if layout == "ranged":
        out = out.where("_own").drop("_chunk", "_own")
    if target == "same_day":
        return out.select(
            series, ts, "target_price", "ma_7", "ma_30", "momentum_1d", "momentum_7d",
            "volatility_7d", "volume_momentum", "day_of_week", "prev_close",
        )
    return out.dropna(how="any", subset=subset) if dropna else out
