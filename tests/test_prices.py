"""Price features, forecasts and evaluation against hand-computed rows."""

from __future__ import annotations

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fathomline import schemas
from fathomline.operators import evaluate, forecast, price_features, ranks, regress
from fathomline.plans import catalog, runs

DAY = dt.date(2026, 1, 1)


def bars(spark, rows):
    """rows: (symbol, day number, close, volume)"""
    data = [(s, DAY + dt.timedelta(days=d), c, c, c, c, v, None) for s, d, c, v in rows]
    return spark.createDataFrame(data, schemas.PRICES).drop("ingested_at")


def features(df, **options):
    out = price_features.price_features(df, dropna=False, **options).orderBy("symbol", "date").collect()
    return [r.asDict() for r in out]


@pytest.mark.parametrize("options", [{"layout": "keyed"}, {"layout": "ranged", "chunk_rows": 30}])
def test_nine_days(spark, options):
    df = bars(spark, [("A", d, float(d + 1), 100) for d in range(9)])
    rows = features(df, **options)
    assert [r["ma_7"] for r in rows][7:] == [4.5, 5.5]
    assert [r["momentum_7d"] for r in rows] == [None] * 7 + [700.0, 350.0]
    assert rows[0]["volatility_7d"] is None
    assert rows[1]["volatility_7d"] == pytest.approx(math.sqrt(0.5))
    assert rows[-1]["target_price"] is None
    kept = price_features.price_features(df, **options).collect()
    assert [(r.close, r.target_price) for r in kept] == [(8.0, 9.0)]


def test_inclusive_frames(spark):
    rows = features(bars(spark, [("A", d, float(d + 1), 1) for d in range(9)]), layout="keyed", inclusive=True)
    assert rows[8]["ma_7"] == 6.0


def test_volume_zero_price_and_gap(spark):
    df = bars(spark, [("A", 0, 0.0, 100), ("A", 1, 5.0, 300), ("A", 4, 10.0, 300)])
    rows = features(df, layout="keyed", target="same_day")
    assert rows[1]["volume_momentum"] == 0.5
    assert rows[1]["momentum_1d"] is None
    assert rows[2]["momentum_1d"] == 100.0 and rows[2]["prev_close"] == 5.0


def test_day_of_week(spark):
    sunday = spark.range(1).select(price_features.day_of_week(F.lit(dt.date(2026, 3, 15))).alias("d"))
    assert sunday.first().d == 0


def test_lookback(spark):
    df = bars(spark, [("A", d, 1.0, 1) for d in range(100)])
    months = price_features.price_features(df, lookback={"months": 1}, target="same_day", layout="keyed")
    assert months.agg(F.min("date")).first()[0] == dt.date(2026, 3, 10)
    days = price_features.price_features(
        df, as_of=dt.date(2026, 2, 1), lookback={"days": 30}, target="same_day", layout="keyed"
    )
    assert days.agg(F.min("date")).first()[0] == dt.date(2026, 1, 2)


def test_one_series_over_many_chunks(spark):
    """A series with most of the rows gives the same features when it is cut up."""
    rng = random.Random(1)
    rows = [("hot", d, rng.uniform(1, 9), rng.randrange(1, 99)) for d in range(500)]
    rows += [(f"s{i}", d, rng.uniform(1, 9), 5) for i in range(20) for d in range(i + 1)]
    df = bars(spark, rows)
    assert features(df, layout="ranged", chunk_rows=31) == features(df, layout="keyed")
    closes = [c for s, _, c, _ in rows if s == "hot"]
    got = [r for r in features(df, layout="ranged", chunk_rows=37) if r["symbol"] == "hot"]
    for i, r in enumerate(got):
        assert r["ma_30"] == pytest.approx(statistics.fmean(closes[max(0, i - 30) : i + 1]))


def test_chunk_shorter_than_frame_is_refused(spark):
    with pytest.raises(ValueError):
        price_features.price_features(bars(spark, [("A", 0, 1.0, 1)]), chunk_rows=10)


def test_number_rows_equals_sorting(spark):
    rng = random.Random(2)
    values = [(rng.randrange(5), i) for i in range(1000)]
    df = spark.createDataFrame(values, "a int, b int")
    numbered, n = ranks.number_rows(df, [F.desc("a"), "b"], "rn")
    assert n == 1000
    expected = sorted(values, key=lambda v: (-v[0], v[1]))
    assert [(r.a, r.b) for r in numbered.orderBy("rn").collect()] == expected
    assert [r.rn for r in numbered.orderBy("rn").collect()] == list(range(1, 1001))
    assert "Window" not in numbered._jdf.queryExecution().toString()


def test_number_rows_of_nothing(spark):
    numbered, n = ranks.number_rows(spark.range(0), ["id"], "rn")
    assert n == 0 and numbered.count() == 0


def test_number_by_key_with_null_keys(spark):
    df = spark.createDataFrame([(None, "x"), ("a", None), (None, None)], "k string, v string")
    out = ranks.number_by_key(df, ["k", "v"], ["k", "v"], "n")
    assert sorted(r.n for r in out.collect()) == [1, 2, 3]


def test_running_total(spark):
    df = spark.range(100).select((99 - F.col("id")).alias("k"), F.lit(2).cast("bigint").alias("v"))
    out = ranks.running_total(df, ["k"], "v", "before").orderBy("k").collect()
    assert [r.before for r in out] == [2 * i for i in range(100)]


def test_error_metrics_and_backtest(spark):
    actual = bars(spark, [("A", 0, 100.0, 1), ("A", 1, 200.0, 1), ("A", 2, 0.0, 1)])
    made = spark.createDataFrame(
        [("A", DAY, 110.0), ("A", DAY + dt.timedelta(1), 190.0), ("B", DAY, 1.0)],
        "symbol string, prediction_date date, predicted_close double",
    )
    tested = evaluate.backtest(actual, made)
    assert tested.count() == 2
    row = evaluate.error_metrics(tested).first()
    assert (row.num_predictions, row.mae, row.rmse, row.mape) == (2, 10.0, 10.0, 7.5)
    zero = evaluate.backtest(actual, made.withColumn("prediction_date", F.lit(DAY + dt.timedelta(2))))
    assert evaluate.error_metrics(zero.where("symbol = 'A'")).first().mape is None


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    bars(spark, [("A", d, 1.0, 1) for d in range(5)]).write.parquet(str(tmp_path / "bars"))
    return spark.read.parquet(str(tmp_path / "bars"))


def test_lookback_reaches_the_scan_and_windows_share_one_sort(stored):
    out = price_features.price_features(
        stored, as_of=dt.date(2026, 2, 1), lookback={"days": 30}, target="same_day", layout="keyed"
    )
    plan = plan_of(out)
    assert "GreaterThanOrEqual(date,2026-01-02)" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_series_filter_reaches_the_scan_and_unused_columns_do_not(stored):
    out = price_features.price_features(stored, target="same_day", layout="keyed")
    plan = plan_of(out.where("symbol = 'A'").select("symbol", "date", "ma_7"))
    assert "EqualTo(symbol,A)" in plan
    assert "ReadSchema: struct<symbol:string,date:date,close:double>" in plan


def test_backtest_is_an_inner_join_with_pushed_filter(spark, stored):
    made = spark.createDataFrame([], schemas.PREDICTIONS)
    plan = plan_of(evaluate.backtest(stored, made, dt.date(2026, 2, 1)))
    assert "Inner" in plan and "LeftOuter" not in plan
    assert "GreaterThanOrEqual(date,2026-01-02)" in plan


def test_line_fit_aggregates_before_the_shuffle(stored):
    plan = plan_of(forecast.forecast(stored, "symbol", "date", "close"))
    assert "partial_regr" in plan or "partial_" in plan
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_holdout_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0)], "y double, p double")
    row = evaluate.holdout_metrics(df, "y", "p").first()
    assert row.n == 3 and row.mae == pytest.approx(1 / 3) and row.r2 == pytest.approx(0.5)
    assert row.mape == pytest.approx(50 / 3)


def test_line_forecast(spark):
    df = bars(spark, [("A", t, 2.0 * t + 1, 1) for t in range(10)])
    rows = forecast.forecast(df, "symbol", "date", "close").orderBy("ts").collect()
    assert [r.ts for r in rows] == [DAY + dt.timedelta(days=t) for t in range(10, 17)]
    for r, want in zip(rows, range(21, 34, 2)):
        assert r.forecast == pytest.approx(want, abs=1e-6)
        assert r.lower == pytest.approx(want, abs=1e-3) and r.upper == pytest.approx(want, abs=1e-3)


def smoothed_by_hand(values, alpha, beta):
    level, trend, sse = values[0], values[1] - values[0] if len(values) > 1 else 0.0, 0.0
    for y in values[1:]:
        error = y - level - trend
        level, trend = level + trend + alpha * error, trend + alpha * beta * error
        sse += error * error
    return level, trend, sse


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_smoothing_in_runs(spark, chunk_rows):
    chance = random.Random(4)
    series = {"A": 40, "B": 1, "C": 2, "D": 17}
    closes = {s: [1000 + 5 * d + chance.gauss(0, 20) for d in range(n)] for s, n in series.items()}
    df = bars(spark, [(s, d, c, 1) for s, cs in closes.items() for d, c in enumerate(cs)]).repartition(5)
    settings = [(0.2, 0.1), (0.7, 0.4), (1.0, 0.0)]
    rows = {r.symbol: r for r in forecast.smooth(df, "symbol", "date", "close", settings, chunk_rows).collect()}
    assert {s: r.n for s, r in rows.items()} == series
    for s, r in rows.items():
        tried = {w: smoothed_by_hand(closes[s], *w) for w in settings}
        assert r.sse == pytest.approx(min(t[2] for t in tried.values()), abs=1e-6)
        assert (r.level, r.trend) == pytest.approx(tried[(r.alpha, r.beta)][:2], abs=1e-6)
        assert r.last_ts == DAY + dt.timedelta(days=series[s] - 1)


def test_holt_forecast(spark):
    df = bars(spark, [("A", d, 10.0 + 2 * d, 1) for d in range(6)] + [("B", 3, 7.0, 1)])
    gaps = df.union(df.limit(1).withColumn("close", F.lit(None).cast("double")))
    for rows in (df, gaps):
        made = forecast.forecast(rows, "symbol", "date", "close", horizon=3, method="holt").orderBy("symbol", "ts").collect()
        assert [r.forecast for r in made] == pytest.approx([22, 24, 26, 7, 7, 7])
        assert [r.upper for r in made[:3]] == pytest.approx([22, 24, 26])
        assert all(r.lower is None and r.upper is None for r in made[3:])
    assert forecast.forecast(df.limit(0), "symbol", "date", "close", method="holt").collect() == []


def test_holt_bounds_widen(spark):
    df = bars(spark, [("A", d, float(d % 3), 1) for d in range(30)])
    made = forecast.forecast(df, "symbol", "date", "close", horizon=3, method="holt", settings=[(0.5, 0.1)]).orderBy("ts").collect()
    sigma = math.sqrt(smoothed_by_hand([float(d % 3) for d in range(30)], 0.5, 0.1)[2] / 28)
    steps = [0.5 * (1 + 0.1 * j) for j in (1, 2)]
    want = [1.96 * sigma * math.sqrt(1 + sum(c * c for c in steps[:j])) for j in range(3)]
    assert [r.upper - r.forecast for r in made] == pytest.approx(want)


def test_unknown_forecast_method(spark):
    with pytest.raises(ValueError):
        forecast.forecast(bars(spark, [("A", 0, 1.0, 1)]), "symbol", "date", "close", method="other")


def test_flat_forecast(spark):
    df = spark.createDataFrame([("A", DAY, 2.0), ("A", DAY - dt.timedelta(1), 9.0)], "symbol string, date date, volatility_7d double")
    rows = forecast.forecast_flat(df, F.lit(50.0)).orderBy("prediction_date").collect()
    assert [r.prediction_date for r in rows] == [DAY + dt.timedelta(days=i) for i in range(1, 8)]
    assert {(r.predicted_close, r.confidence_interval_low, r.confidence_interval_high) for r in rows} == {(50.0, 46.08, 53.92)}


def test_split_and_folds(spark):
    ten = spark.range(10)
    parts = {r.id: r.part for r in regress.ordered_split(ten, ["id"]).collect()}
    assert [i for i in range(10) if parts[i] == "test"] == [8, 9]
    folds = {r.id: r.fold for r in regress.assign_folds(spark.range(8), ["id"]).collect()}
    assert [folds[i] for i in range(8)] == [0, 0, 0, 1, 1, 1, 2, 2]
    few = {r.id: r.fold for r in regress.assign_folds(spark.range(2), ["id"]).collect()}
    assert few == {0: 0, 1: 1}


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in regress.standardize(df, ["a", "b"], df).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_full_grid_size():
    assert math.prod(len(v) for v in regress.FULL_GRID.values()) == 72


@pytest.mark.parametrize("name", ["regressor_scores", "model_roundtrip", "price_run"])
def test_registered_searches_are_the_full_one(spark, sf, monkeypatch, name):
    grids = []

    def fit(df, features, label, grid, **_):
        grids.append(grid)
        raise InterruptedError

    monkeypatch.setattr(regress, "fit_regressor", fit)
    monkeypatch.setattr(runs, "fit_regressor", fit)
    with pytest.raises(InterruptedError):
        catalog.QUERIES[name](spark, sf)
    assert grids == [regress.FULL_GRID]


def test_regressor_learns_and_reloads(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"s{i % 4}", DAY + dt.timedelta(days=i // 4), x := rng.uniform(0, 10), 3 * x + 1) for i in range(400)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double, y double")
    model, metrics = regress.fit_regressor(df, ["x"], "y", {"maxIter": [10]}, folds=2)
    assert metrics.first().r2 > 0.9
    regress.save_model(spark, model, str(tmp_path), "v1")
    again = regress.load_model(spark, str(tmp_path), "v1")
    assert again.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()


def test_actual_vs_predicted_is_a_union(spark):
    actual = bars(spark, [("A", d, 1.0, 1) for d in range(40)])
    made = forecast.as_predictions(forecast.forecast(actual, "symbol", "date", "close"))
    out = evaluate.actual_vs_predicted(actual, made)
    assert out.groupBy("type").count().orderBy("type").collect() == [("actual", 31), ("predicted", 7)]
