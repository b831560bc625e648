"""Per-series forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.operators.evaluate import latest_per_key
from fathomline.operators.ranks import number_rows

DAY_ZERO = "1970-01-01"
#: Weights of level and trend that smoothing tries by default.
SETTINGS = [(level, trend) for level in (0.2, 0.5, 0.8) for trend in (0.1, 0.3)]


def _day_number(date: Column) -> Column:
    return F.datediff(date, F.lit(DAY_ZERO).cast("date")).cast("double")


def fit_lines(df: DataFrame, series: str, ts: str, y: str) -> DataFrame:
    """Least-squares line per series: slope, intercept, residual error, row count, last day.

    One aggregation with partial sums on the map side, whatever the series size.
    """
    t, v = _day_number(F.col(ts)), F.col(y).cast("double")
    moments = df.groupBy(series).agg(
        F.regr_slope(v, t).alias("slope"),
        F.regr_intercept(v, t).alias("intercept"),
        F.regr_syy(v, t).alias("_syy"),
        F.regr_sxy(v, t).alias("_sxy"),
        F.regr_count(v, t).alias("n"),
        F.max(ts).alias("last_ts"),
    )
    squares = F.greatest(F.col("_syy") - F.col("slope") * F.col("_sxy"), F.lit(0.0))
    return moments.select(
        series, "slope", "intercept", "n", "last_ts",
        F.sqrt(F.try_divide(squares, F.when(F.col("n") > 2, F.col("n") - 2))).alias("residual_error"),
    )


def _fold(values: Column, first: Column, level: Column, trend: Column) -> Column:
    """What a run of values does to any state (level above ``first``, trend) before it.

    Smoothing maps states affinely: the new level is ``l1``, ``l2`` times the old level and
    trend plus ``l0``, the new trend likewise ``b1``, ``b2``, ``b0``.  The squared errors of
    one step are a quadratic form of the old state: ``e0`` - 2 ``e1``, ``e2`` + ``e11``, ``e12``, ``e22``.
    """
    zero = F.lit(0.0)
    start = {"l1": F.lit(1.0), "l2": zero, "l0": zero, "b1": zero, "b2": F.lit(1.0), "b0": zero}
    start |= dict.fromkeys(["e0", "e1", "e2", "e11", "e12", "e22"], zero)

    def step(s: Column, value: Column) -> Column:
        q1, q2, q0 = (s[f"l{i}"] + s[f"b{i}"] for i in (1, 2, 0))
        error = value - first - q0
        made = {
            "l1": (1 - level) * q1,
            "l2": (1 - level) * q2,
            "l0": q0 + level * error,
            "b1": s["b1"] - level * trend * q1,
            "b2": s["b2"] - level * trend * q2,
            "b0": s["b0"] + level * trend * error,
            "e0": s["e0"] + error * error,
            "e1": s["e1"] + error * q1,
            "e2": s["e2"] + error * q2,
            "e11": s["e11"] + q1 * q1,
            "e12": s["e12"] + q1 * q2,
            "e22": s["e22"] + q2 * q2,
        }
        return F.struct(*[made[name].alias(name) for name in start])

    return F.aggregate(values, F.struct(*[v.alias(k) for k, v in start.items()]), step)


def _through(s: Column, run: Column) -> Column:
    """State and squared errors after one more run."""
    m, high, trend = run["fold"], s["level"] - run["first"], s["trend"]
    squares = (
        m["e0"] - 2 * (high * m["e1"] + trend * m["e2"])
        + high * high * m["e11"] + 2 * high * trend * m["e12"] + trend * trend * m["e22"]
    )
    return F.struct(
        (run["first"] + m["l1"] * high + m["l2"] * trend + m["l0"]).alias("level"),
        (m["b1"] * high + m["b2"] * trend + m["b0"]).alias("trend"),
        (s["sse"] + F.greatest(squares, F.lit(0.0))).alias("sse"),
    )


def smooth(
    df: DataFrame, series: str, ts: str, y: str, settings=SETTINGS, chunk_rows: int = 4096
) -> DataFrame:
    """Level and trend of each series by double exponential smoothing.

    Starts from the first value and the first difference.  Of ``settings``, pairs of weights
    in 0..1 of level and trend, a series takes that with the least squared errors of one
    step, ties to the smaller weights.  Returns ``series``, ``level``, ``trend``, ``sse``,
    ``alpha``, ``beta``, ``n``, ``last_ts``.

    Rows are numbered by range and cut into runs; a run becomes one affine map, and the maps
    of a series are applied in order, so the rows of one series may fill any number of tasks.
    Rows without a day or value are left out; equal days are taken by value; a series
    of one value has no trend.
    """
    if not settings:
        raise ValueError("smoothing needs at least one pair of weights")
    known = df.where(F.col(ts).isNotNull() & F.col(y).isNotNull()).select(
        F.col(series).alias("series"), F.col(ts).alias("ts"), F.col(y).cast("double").alias("y")
    )
    numbered, _ = number_rows(known, ["series", "ts", "y"], "row", first=0)
    runs = numbered.groupBy("series", F.floor(F.col("row") / chunk_rows).alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("row", "y")))["y"].alias("values"), F.max("ts").alias("last_ts")
    )
    weights = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("beta")) for a, b in settings])
    folded = runs.select("*", F.inline(weights)).select(
        "series", "alpha", "beta", "last_ts",
        F.struct(
            "run",
            F.get("values", F.lit(0)).alias("first"),
            F.slice("values", 1, 2).alias("head"),
            F.size("values").cast("long").alias("n"),
            _fold(F.col("values"), F.get("values", F.lit(0)), F.col("alpha"), F.col("beta")).alias("fold"),
        ).alias("run"),
    )
    joined = folded.groupBy("series", "alpha", "beta").agg(
        F.sort_array(F.collect_list("run")).alias("runs"), F.max("last_ts").alias("last_ts"), F.sum("run.n").alias("n")
    )
    head = F.flatten(F.col("runs.head"))
    rise = F.coalesce(F.get(head, F.lit(1)) - F.get(head, F.lit(0)), F.lit(0.0))
    # One step before the first value, on the line through the first two.
    before = F.struct((F.get(head, F.lit(0)) - rise).alias("level"), rise.alias("trend"), F.lit(0.0).alias("sse"))
    ended = joined.select("*", F.aggregate("runs", before, _through).alias("end"))
    row = F.struct(F.col("end.sse").alias("sse"), "alpha", "beta", "end.level", "end.trend", "n", "last_ts")
    best = ended.groupBy("series").agg(F.min(row).alias("best"))
    return best.select(F.col("series").alias(series), "best.level", "best.trend", "best.sse", "best.alpha", "best.beta", "best.n", "best.last_ts")


def _smoothed(df: DataFrame, series: str, ts: str, y: str, horizon: int, z: float, settings) -> DataFrame:
    """Level plus trend per step; the error grows with the steps as the state's does."""
    h, a = F.col("_ahead"), F.col("alpha")
    b = a * F.col("beta")
    growth = 1 + (h - 1) * (a * a + a * b * h + b * b * h * (2 * h - 1) / 6)
    margin = z * F.sqrt(F.try_divide(F.col("sse"), F.when(F.col("n") > 2, F.col("n") - 2)) * growth)
    value = F.col("level") + h * F.col("trend")
    days = smooth(df, series, ts, y, settings).select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_ahead"))
    return days.select(
        series,
        F.date_add("last_ts", h).alias("ts"),
        value.alias("forecast"),
        (value - margin).alias("lower"),
        (value + margin).alias("upper"),
    )


def forecast(
    df: DataFrame, series: str, ts: str, y: str, horizon: int = 7, z: float = 1.96, method: str = "linear", settings=SETTINGS
) -> DataFrame:
    """``horizon`` days after the last day of each series with lower and upper bounds.

    ``method`` is ``linear`` (a least-squares line over the days) or ``holt`` (smoothed
    level and trend over the rows, weights out of ``settings``).  A series of fewer than
    three rows has no bounds.
    """
    if method == "holt":
        return _smoothed(df, series, ts, y, horizon, z, settings)
    if method != "linear":
        raise ValueError(f"unknown method {method!r}")
    lines = fit_lines(df, series, ts, y)
    days = lines.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_ahead")
    ).withColumn("ts", F.date_add("last_ts", F.col("_ahead")))
    value = F.col("intercept") + F.col("slope") * _day_number(F.col("ts"))
    margin = z * F.col("residual_error")
    return days.select(
        series,
        "ts",
        value.alias("forecast"),
        (value - margin).alias("lower"),
        (value + margin).alias("upper"),
    )


def as_predictions(forecasts: DataFrame, version: str = "v1.0", run_ts: Column | None = None) -> DataFrame:
    """Rename forecast columns to those of the predictions table."""
    return forecasts.select(
        "symbol",
        F.col("ts").alias("prediction_date"),
        F.col("forecast").alias("predicted_close"),
        F.col("lower").alias("confidence_interval_low"),
        F.col("upper").alias("confidence_interval_high"),
        F.lit(version).alias("model_version"),
        (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp_ntz").alias("created_at"),
    )


def forecast_flat(
    features: DataFrame,
    predict,
    horizon: int = 7,
    z: float = 1.96,
    series: str = "symbol",
    ts: str = "date",
    version: str = "flat_v1",
    run_ts: Column | None = None,
) -> DataFrame:
    """Score the latest row of each series and repeat the value for the next days.

    ``predict`` is a fitted model (its ``prediction`` column is used) or a column.
    Bounds are the value -/+ ``z`` times that row's 7-row volatility.  Pass feature
    rows without the null drop to score the true last day of each series.
    """
    latest = latest_per_key(features, series, ts)
    if isinstance(predict, Column):
        scored = latest.withColumn("prediction", predict)
    else:
        scored = predict.transform(latest)
    margin = z * F.col("volatility_7d")
    days = scored.withColumn("_ahead", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    return days.select(
        series,
        F.date_add(ts, F.col("_ahead")).alias("prediction_date"),
        F.col("prediction").alias("predicted_close"),
        (F.col("prediction") - margin).alias("confidence_interval_low"),
        (F.col("prediction") + margin).alias("confidence_interval_high"),
        F.lit(version).alias("model_version"),
        (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp_ntz").alias("created_at"),
    )
