from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import fx, series, stats


def months(n: int, start: int = 2000) -> list[dt.date]:
    return [dt.date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def numpy_decompose(y: np.ndarray, period: int = 12):
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period
    half = period // 2
    trend = np.full(len(y), np.nan)
    if len(y) > period:
        trend[half:-half] = np.convolve(y, weights, "valid")
    means = np.array([np.nanmean((y - trend)[i::period]) for i in range(period)])
    seasonal = np.resize(means - means.mean(), len(y))
    return trend, seasonal, y - trend - seasonal


@pytest.mark.parametrize("n", [24, 25, 80])
def test_decomposition_equals_numpy(spark, n):
    y = np.random.default_rng(n).integers(10, 90, n).astype(float)
    rows = spark.createDataFrame([(k, m, int(v) + k) for k in (0, 1) for m, v in zip(months(n), y)], "k int, month date, v long")
    for key, part in ((["k"], rows), ([], rows.where("k = 0").drop("k"))):
        got = series.decompose(part, "v", key).orderBy(*key, "month").toPandas().head(n)
        for name, want in zip(("trend", "seasonality", "residual"), numpy_decompose(y)):
            np.testing.assert_allclose(got[name].to_numpy(dtype=float), want, atol=1e-9)


@pytest.mark.parametrize("n", [1, 3, 12, 13, 23])
def test_short_series_have_no_seasonality(spark, n):
    rows = spark.createDataFrame([(m, 5) for m in months(n)], "month date, v long")
    got = series.decompose(rows, "v")
    assert got.count() == n and got.where(F.col("seasonality").isNotNull()).count() == 0
    assert got.where(F.col("trend").isNotNull()).count() == max(0, n - 12)


def test_volume_lags_and_split(spark):
    orders = spark.createDataFrame(
        [(str(i) if i % 5 else None, m, "x") for i, m in enumerate(months(20) * 2)] + [("n", None, "x")], "id string, d date, k string"
    )
    volume = series.monthly_volume(orders, "d", "id", ["k"])
    assert volume.agg(F.sum("volume")).first()[0] == 32
    lagged = series.add_lags(volume, "volume", 2, ["k"], log=True).orderBy("month").collect()
    assert lagged[0].volume_lag_1 is None
    assert lagged[2].volume_lag_2 == pytest.approx(np.log1p(lagged[0].volume))
    counts = {r.split: r["count"] for r in series.positional_split(volume, ["k"]).groupBy("split").count().collect()}
    assert counts == {"train": 5, "test": 9, "tail": 3}


def test_gaps_are_filled(spark):
    rows = spark.createDataFrame([("a", dt.date(2020, 1, 1), 3), ("a", dt.date(2020, 4, 1), 2), ("b", dt.date(2020, 2, 1), 1)], "k string, month date, volume long")
    got = sorted((r.k, r.month.month, r.volume) for r in series.fill_month_gaps(rows, ["k"]).collect())
    assert got == [("a", 1, 3), ("a", 2, 0), ("a", 3, 0), ("a", 4, 2), ("b", 2, 1)]


def test_macro_rollup_and_factor_table(spark):
    day = dt.date
    rows = spark.createDataFrame([("cpi", day(2020, 1, 1), 2.0), ("cpi", day(2020, 1, 8), 4.0), ("gpdi", day(2020, 2, 1), 9.0), ("cpi", None, 1.0)], "series string, date date, value double")
    for how, want in (("count", 2.0), ("mean", 3.0), ("last", 4.0)):
        table = series.factor_table(series.macro_rollup(rows, how), ["cpi", "gpdi"]).orderBy("month").collect()
        assert [(r.cpi, r.gpdi is None) for r in table] == [(want, True), (None, False)]


def test_as_of_rates(spark):
    day = dt.date
    rates = spark.createDataFrame([("CAD", day(2020, 1, 10), 0.5), ("CAD", day(2020, 1, 20), 0.75), ("JPY", day(2020, 1, 1), 0.01)], "currency string, rate_date date, usd_rate double")
    rows = spark.createDataFrame(
        [(1, "CAD", day(2020, 1, 9)), (2, "CAD", day(2020, 1, 10)), (3, "CAD", day(2020, 1, 19)), (4, "CAD", day(2021, 1, 1)), (5, "USD", day(2019, 1, 1)), (6, "EUR", day(2020, 5, 1)), (7, "XXX", day(2020, 5, 1)), (8, None, day(2020, 5, 1))],
        "i int, c string, d date",
    ).withColumn("v", F.lit(100.0))
    kept = fx.to_usd(rows, rates, "c", {"v": "usd"}, date_col="d", overrides={"EUR": "JPY"})
    assert {r.i: r.usd for r in kept.collect()} == {2: 50.0, 3: 50.0, 4: 75.0, 5: 100.0, 6: 1.0}
    assert fx.to_usd(rows, rates, "c", {"v": "usd"}, date_col="d", how="left").count() == 8
    latest = fx.to_usd(rows, rates, "c", {"v": "usd"})
    assert {r.i: r.usd for r in latest.collect()} == {1: 75.0, 2: 75.0, 3: 75.0, 4: 75.0, 5: 100.0}
    assert fx.currency_subset(rows, "c").count() == 6


def test_correlations_with_nulls_and_constants(spark):
    import pandas as pd

    rng = np.random.default_rng(0)
    data = pd.DataFrame(rng.normal(1e6, 3, (60, 4)), columns=["a", "b", "c", "d"])
    data["b"] += data["a"]
    data.loc[::7, "b"] = np.nan
    data.loc[1::5, "c"] = np.nan
    data["d"] = 0.1
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in data.to_numpy()]
    got = stats.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c double, d double")).collect()
    want = data.corr()
    assert len(got) == 16
    for r in got:
        if "d" in (r.row_name, r.col_name):
            assert r.r is None
        else:
            assert r.r == pytest.approx(want.loc[r.row_name, r.col_name], abs=1e-9)


def test_metrics(spark):
    rows = spark.createDataFrame([(2.0, 1.0), (4.0, 5.0), (0.0, 2.0), (3.0, None)], "y double, p double")
    got = stats.regression_metrics(rows, "y", "p").first()
    assert (got.n, got.mse, got.rmse) == (3, 2.0, pytest.approx(2**0.5))
    assert got.mape == pytest.approx(37.5) and got.mape_by_prediction == pytest.approx((1 + 0.2 + 1) / 3 * 100)
    assert got.r_squared == pytest.approx(1 - 6 / 8)
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "y int, p int")
    assert tuple(stats.confusion_matrix(labels, "y", "p").first()) == (1, 1, 1, 2, 60.0)


def test_best_run_breaks_ties_by_name(spark):
    rows = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5), ("d", None)], "job string, value double")
    runs = rows.select("job", F.lit("m").alias("model"), F.lit(None).cast("map<string,string>").alias("params"), F.lit("x").alias("metric"), "value")
    assert stats.best_run(runs, "x", True).first().job == "a"
    assert stats.best_run(runs, "x", False).first().job == "c"
    assert stats.best_run(runs, "y", False).collect() == []
