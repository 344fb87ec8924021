from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.models import absolute_forest, arma, churn, forecast, inference, least_squares, network, regression, runs
from ledgerline.models.forest import Node, read_nodes, score_forest
from ledgerline.plans import jobs, results
from ledgerline.schemas import CHURN_FEATURES


def months(n):
    return [dt.date(1995 + i // 12, i % 12 + 1, 1) for i in range(n)]


def test_grouped_regression_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for k in ("a", "b", "c"):
        x = rng.normal(size=(40, 3))
        y = x @ rng.normal(size=3) + rng.normal(size=40)
        rows += [(k, *map(float, r), float(v)) for r, v in zip(x, y)]
        want[k] = np.linalg.lstsq(np.c_[x, np.ones(40)], y, rcond=None)[0]
    rows += [("a", None, 1.0, 1.0, 1.0), (None, 1.0, 1.0, 1.0, 2.0)]
    frame = spark.createDataFrame(rows, "k string, x0 double, x1 double, x2 double, y double")
    got = least_squares.grouped_regression(frame, ["k"], ["x0", "x1", "x2"], "y").where("k is not null").collect()
    for r in got:
        at = ["x0", "x1", "x2", "intercept"].index(r.feature)
        assert r.coefficient == pytest.approx(want[r.k][at], abs=1e-9) and r.n == 40
    assert len(got) == 12


def seasonal(n, k, noise=0.0):
    rng = np.random.default_rng(k)
    return [100 + 10 * k + 2 * i + 30 * np.sin(2 * np.pi * i / 12) + noise * rng.normal() for i in range(n)]


def test_forecast_follows_trend_and_season(spark):
    rows = [(k, m, float(v)) for k in range(3) for m, v in zip(months(84), seasonal(84, k, 1.0))]
    rows += [(9, m, float(v)) for m, v in zip(months(20), seasonal(20, 9))]
    frame = spark.createDataFrame(rows, "k int, month date, v double")
    got = forecast.seasonal_forecast(frame, "v", ["k"]).toPandas()
    assert got.groupby("k").size().to_dict() == {0: 12, 1: 12, 2: 12, 9: 12}
    long = got[got.k < 9]
    assert set(long.method) == {"seasonal_arima"}
    assert (long.forecast - long.actual).abs().max() < 8  # the value one season earlier is off by 24
    short = got[got.k == 9]
    assert set(short.method) == {"seasonal_naive"} and short.forecast.notna().sum() == 8  # too short for a model
    naive = forecast.seasonal_naive(frame.where("k = 0"), "v", ["k"]).toPandas()
    assert 20 < (naive.actual - naive.forecast).mean() < 28


def test_one_series_without_a_key(spark):
    frame = spark.createDataFrame([(m, float(v)) for m, v in zip(months(84), seasonal(84, 1, 1.0))], "month date, v double")
    got = forecast.seasonal_forecast(frame, "v", horizon=6).toPandas()
    assert len(got) == 6 and (got.forecast - got.actual).abs().max() < 8
    fitted = forecast.fitted_values(frame, "v").toPandas()
    assert len(fitted) == 72 and (fitted.actual - fitted.fitted).abs().mean() < 3
    with pytest.raises(ValueError):
        forecast.seasonal_forecast(frame, "v", horizon=0)


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    rows = [(m, int(50 + i + rng.integers(20))) for i, m in enumerate(months(80))]
    volume = spark.createDataFrame(rows, "month date, volume long")
    factors = spark.createDataFrame(
        [(m, 1.0, float(rng.normal()), float(rng.normal()), 0.0, 0.0) for m in months(78)],
        "month date, cpi double, inpi double, totci double, gpdi double, pubdeb double",
    )
    return regression.regression_frame(volume, factors).cache()


def test_linear_regression_equals_numpy(frame):
    used = regression.varying(frame, regression.FEATURES)
    assert used == regression.FEATURES[1:]  # cpi is constant
    train = frame.where("split = 'train'").orderBy("month").toPandas()
    x = np.c_[train[used].to_numpy(dtype=float), np.ones(len(train))]
    want = np.linalg.lstsq(x, train.volume.to_numpy(dtype=float), rcond=None)[0]
    table = {r.feature: r for r in regression.coefficient_table(frame, regression.FEATURES).collect()}
    assert table["cpi"].coefficient is None and table["cpi"].p_value is None
    for name, c in zip(used, want):
        assert table[name].coefficient == pytest.approx(c, rel=1e-6) and 0 <= table[name].p_value <= 1


def test_months_without_factors_have_no_prediction(frame):
    used = regression.varying(frame, regression.FEATURES)
    got = regression.predictions(regression.fit_linear(frame, used), frame, used)
    assert got.count() == 77  # 80 months, three without lags
    assert got.where("prediction IS NULL").count() == 2  # two without factors


def test_forest_grid_and_best_run(spark, frame, tmp_path):
    used = regression.varying(frame, regression.FEATURES)
    train = frame.where("split = 'train'")
    made = runs.run_grid(
        spark, "forest", "MAPE", runs.grid(feature_subset=["all", "sqrt"], num_trees=[2, 5]),
        lambda **p: regression.fit_forest(train, used, **p),
        lambda m: float(m.stages[-1].getNumTrees), folder=str(tmp_path / "models"),
    )
    rows = made.orderBy("job").collect()
    assert [r.params["num_trees"] for r in rows] == ["2", "5", "2", "5"]
    assert [PipelineModel.load(r.path).stages[-1].getNumTrees for r in rows] == [2, 5, 2, 5]
    folder = str(tmp_path / "results")
    with pytest.raises(ValueError):
        results.best_model(spark, folder, "forest", "MAPE", False)
    assert results.publish_results(spark, folder, "forest", {"runs": made, "rows": train}) == 1
    assert results.best_model(spark, folder, "forest", "MAPE", False).stages[-1].getNumTrees == 2
    assert results.best_model(spark, folder, "forest", "MAPE", True).stages[-1].getNumTrees == 5


def customers(spark, n=400):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        active = int(rng.integers(2))
        rows.append((i, f"s{i}", int(rng.integers(300, 850)), ["Spain", "France", "Germany"][i % 3], ["Male", "Female"][i % 2],
                     int(rng.integers(18, 80)), int(rng.integers(10)), float(rng.normal(5e4, 1e4)), int(rng.integers(1, 4)),
                     int(rng.integers(2)), active, float(rng.normal(1e5, 1e4)), int(active == 0)))
    return spark.createDataFrame(rows, "customerid long, surname string, " + ", ".join(
        f"{c} {'string' if c in ('geography', 'gender') else 'double' if c in ('balance', 'estimatedsalary') else 'long'}" for c in CHURN_FEATURES
    ) + ", exited long")


def test_churn_inputs_are_standardised(spark):
    from pyspark.ml import Pipeline

    rows = customers(spark)
    fitted = Pipeline(stages=churn.feature_stages(rows)).fit(rows)
    x = np.array([r[0] for r in fitted.transform(rows).select(vector_to_array("features")).collect()])
    assert x.shape == (400, 11)
    np.testing.assert_allclose(x.mean(axis=0), 0, atol=1e-9)
    np.testing.assert_allclose(x.std(axis=0), 1, atol=1e-9)
    geography = {r.geography: tuple(r.f) for r in fitted.transform(rows).select("geography", vector_to_array("geography_flags").alias("f")).distinct().collect()}
    assert geography == {"Spain": (1.0, 0.0), "Germany": (0.0, 1.0), "France": (0.0, 0.0)}


def test_churn_model_learns_and_scores_every_row(spark, tmp_path):
    rows = customers(spark)
    train, test = churn.stable_split(rows, "customerid")
    again, _ = churn.stable_split(rows.repartition(5), "customerid")
    assert train.exceptAll(again).count() == 0 and train.count() + test.count() == 400
    churn.fit_logistic(train).write().save(str(tmp_path / "m"))
    scored = churn.score(PipelineModel.load(str(tmp_path / "m")), rows)
    assert scored.count() == 400
    assert scored.where("predicted = exited").count() > 380
    network = churn.fit_network(train, max_iter=60)
    assert churn.score(network, test).where("predicted = exited").count() > 0.85 * test.count()


FOREST = [
    Node(0, 0, None, None, None, None, (3, 3)), Node(0, 1, 0, "x", "lessOrEqual", 1.0, (3, 1)),
    Node(0, 2, 0, "x", "greaterThan", 1.0, (0, 2)), Node(0, 3, 1, "y", "lessOrEqual", 0.0, (3, 0)),
    Node(0, 4, 1, "y", "greaterThan", 0.0, (0, 1)),
    Node(1, 0, None, None, None, None, (1, 3)),
]


def test_forest_scoring(spark):
    table = spark.createDataFrame(
        [(n.tree, n.node, n.parent, n.feature, n.op, n.threshold, [float(c) for c in n.class_counts]) for n in FOREST],
        "tree int, node int, parent int, feature string, op string, threshold double, class_counts array<double>",
    )
    nodes = read_nodes(table)
    rows = spark.createDataFrame([(1.0, 0.0), (1.0, 0.5), (2.0, 0.0), (None, 0.0)], "x double, y double")
    got = [(r.probability_a, r.probability_b, r.predicted) for r in score_forest(rows, nodes, ["a", "b"]).collect()]
    assert got == [(0.625, 0.375, "a"), (0.125, 0.875, "b"), (0.125, 0.875, "b"), (0.375, 0.625, "b")]
    with pytest.raises(ValueError):
        score_forest(rows, [FOREST[0], Node(0, 1, 0, "x", "like", 1.0, (1, 1))], ["a", "b"])


def test_grouped_regression_with_large_means(spark):
    rng = np.random.default_rng(8)
    x = 1e8 + 10 * np.arange(200.0)
    y = 2.0002 * x - 22000 + rng.normal(0, 3, 200)
    z = rng.normal(0, 1, 200)
    rows = [("a", float(p), float(q), float(r)) for p, q, r in zip(x, z, y)]
    rows += [("flat", 5.0, float(q), float(r)) for q, r in zip(z, y)]
    frame = spark.createDataFrame(rows, "k string, x double, z double, y double")
    got = least_squares.grouped_regression(frame, ["k"], ["x", "z"], "y")
    found = {(r.k, r.feature): r.coefficient for r in got.collect()}
    centred = np.column_stack([x - x.mean(), z - z.mean()])
    slope = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    np.testing.assert_allclose([found["a", "x"], found["a", "z"]], slope, rtol=1e-6)
    np.testing.assert_allclose(found["a", "intercept"], y.mean() - slope @ [x.mean(), z.mean()], rtol=1e-5)
    assert [found["flat", f] for f in ("x", "z", "intercept")] == [None] * 3


def test_odd_customers_are_scored(spark):
    rows = customers(spark)
    for fit in (churn.fit_logistic, churn.fit_network):
        model = fit(rows.where("geography <> 'Spain' OR age > 0"))
        odd = rows.selectExpr(
            "*", "CASE customerid % 4 WHEN 0 THEN 'Atlantis' WHEN 1 THEN NULL ELSE geography END AS g2",
            "IF(customerid % 3 = 0, NULL, age) AS a2", "IF(customerid % 5 = 0, NULL, gender) AS s2",
        ).drop("geography", "age", "gender").withColumnsRenamed({"g2": "geography", "a2": "age", "s2": "gender"})
        scored = churn.score(model, odd)
        assert scored.count() == rows.count()
        assert scored.where("probability_exit BETWEEN 0 AND 1").count() == rows.count()


def test_a_fourth_geography_fits(spark):
    rows = customers(spark).withColumn("geography", F.expr("IF(customerid % 9 = 0, 'Italy', geography)"))
    assert churn.score(churn.fit_network(rows, max_iter=2), rows).count() == rows.count()


def test_months_without_factors_stay(spark):
    rows = [(m, "train" if m < 30 else "test", float(m % 7) if m % 4 else None, float(m)) for m in range(40)]
    frame = spark.createDataFrame(rows, "month int, split string, cpi double, volume double")
    model = regression.fit_linear(frame.where("split = 'train'"), ["cpi"])
    got = regression.predictions(model, frame, ["cpi"]).collect()
    assert len(got) == 40 and all((r.prediction is None) == (r.cpi is None) for r in got)


def test_a_series_is_an_upload_however_many_files_it_fills(spark, tmp_path):
    from ledgerline.plans import jobs, results
    from ledgerline.sources.files import read_csv
    from ledgerline.sources.sinks import write_zone

    def upload(kind, k, n):
        volumes = [round(v) for v in seasonal(n, k, 1.0)]
        rows = [(f"{k}-{i}-{j}", f"{m:%m/%d/%Y}", "Usa", kind) for i, (m, v) in enumerate(zip(months(n), volumes)) for j in range(v)]
        return spark.createDataFrame(rows, "UniqueId string, OrderReceivedDate string, Country string, file_type string")

    uploads = {"007": upload("training", 1, 84), "7": upload("training", 2, 72), "x": upload("testing", 3, 84)}
    got = {}
    for files in (1, 50):
        zone = str(tmp_path / f"zone{files}")
        for name, rows in uploads.items():
            write_zone(rows.repartition(files), zone, "DS1", "csv", upload_id=name)
        assert len(list((tmp_path / f"zone{files}").rglob("part-*.csv"))) == 3 * files
        read = read_csv(spark, f"{zone}/DS1", uploads["x"].withColumn("upload_id", F.lit("")).schema)
        got[files] = sorted(map(tuple, jobs.JOBS["AremaRetrain"](published=read).collect()))
    assert got[1] == got[50] and len(got[1]) == 24
    assert {(r[0], r[-1]) for r in got[1]} == {("007", "seasonal_arima"), ("7", "seasonal_arima")}
    with pytest.raises(ValueError):
        jobs.JOBS["AremaRetrain"](published=uploads["x"].withColumn("source_file", F.lit("part-0")))


def test_a_series_with_a_null_key_has_a_model(spark):
    rows = [(k, m, float(v)) for k in (None, "a") for m, v in zip(months(84), seasonal(84, 1, 1.0))]
    frame = spark.createDataFrame(rows, "k string, month date, v double")
    got = forecast.seasonal_forecast(frame, "v", ["k"]).collect()
    assert len(got) == 24 and {r.method for r in got} == {"seasonal_arima"}
    by_key = [[r.forecast for r in sorted(got, key=lambda r: r.step) if r.k == k] for k in (None, "a")]
    np.testing.assert_allclose(*by_key)
    checked = {r.k: r for r in forecast.holdout_check(frame, "v", ["k"]).collect()}
    assert set(checked) == {None, "a"} and all(r.n == 12 and r.rmse < r.naive_rmse for r in checked.values())


# ---------------------------------------------------------------- product form, states, inference, published results


def plain_residuals(w, orders, b):
    """The recursion of the product form, written out term by term."""
    p, q, sp, sq = orders
    phi, theta, big_phi, big_theta = b[:p], b[p : p + q], b[p + q : p + q + sp], b[p + q + sp :]
    ar = {0: 1.0, **{k + 1: -c for k, c in enumerate(phi)}}
    sar = {0: 1.0, **{12 * (k + 1): -c for k, c in enumerate(big_phi)}}
    ma = {0: 1.0, **{k + 1: c for k, c in enumerate(theta)}}
    sma = {0: 1.0, **{12 * (k + 1): c for k, c in enumerate(big_theta)}}
    e = []
    for t in range(len(w)):
        value = sum(a * s * w[t - i - j] for i, a in ar.items() for j, s in sar.items() if t - i - j >= 0)
        value -= sum(a * s * e[t - i - j] for i, a in ma.items() for j, s in sma.items() if i + j and t - i - j >= 0)
        e.append(value)
    return np.array(e)


@pytest.mark.parametrize("orders", [(0, 0, 0, 0), (3, 0, 0, 0), (0, 2, 0, 2), (2, 1, 1, 1), (3, 3, 2, 2)])
def test_product_form_residuals(orders):
    rng = np.random.default_rng(sum(orders))
    w, points = rng.normal(size=70), [rng.uniform(-0.4, 0.4, sum(orders)) for _ in range(3)]
    found = arma.residuals(w, orders, points)
    for column, b in zip(found.T, points):
        np.testing.assert_allclose(column, plain_residuals(w, orders, b), atol=1e-9)


def test_fit_finds_the_product_model():
    rng = np.random.default_rng(4)
    e = rng.normal(size=3000)
    w = e.copy()
    w[1:] -= 0.5 * e[:-1]
    w[12:] -= 0.6 * e[:-12]
    w[13:] += 0.3 * e[:-13]
    b, total = arma.fit(w, (0, 1, 0, 1))
    np.testing.assert_allclose(b, [-0.5, -0.6], atol=0.06)
    assert total / 3000 == pytest.approx(1, abs=0.08)
    assert not arma.stable((1, 0, 0, 0), [1.01]) and not arma.stable((0, 1, 0, 0), [-1.0]) and arma.stable((0, 0, 0, 0), [])


def test_advancing_equals_one_pass():
    rng = np.random.default_rng(9)
    y = np.cumsum(rng.normal(size=90)) + np.tile(np.arange(12.0), 8)[:90]
    orders, b = (2, 1, 1, 1), np.array([0.3, -0.2, 0.4, 0.2, -0.5])
    state, expected = arma.advance(arma.tails(y[:60], orders, b), orders, b, y[60:75])
    for one, other in zip(state, arma.tails(y[:75], orders, b)):
        np.testing.assert_allclose(one, other, atol=1e-8)
    shocks = arma.residuals(arma.difference(y), orders, [b])[:, 0]
    np.testing.assert_allclose(y[60:75] - expected, shocks[47:62], atol=1e-8)


def airline(n, seed):
    """A series of the product model with shocks that carry over a month and a year."""
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 13)
    w = e[13:] - 0.6 * e[12:-1] - 0.7 * e[1:-12] + 0.42 * e[:-13]
    y = list(50 + 10 * np.sin(np.arange(13)))
    for step in w[13:]:
        y.append(step + y[-1] + y[-12] - y[-13])
    return y[:n]


def test_long_horizon_long_series_and_choice(spark):
    rows = [(k, m, float(v)) for k in range(6) for m, v in zip(months(240), airline(240, k))]
    frame = spark.createDataFrame(rows, "k int, month date, v double")
    got = forecast.seasonal_forecast(frame, "v", ["k"], horizon=30)
    assert got.groupBy("k").count().where("count = 30").count() == 6 and got.where("forecast IS NULL").count() == 0
    checked = forecast.holdout_check(frame, "v", ["k"]).collect()
    assert sum(r.rmse**2 for r in checked) <= sum(r.naive_rmse**2 for r in checked)
    assert "seasonal_arima" in {r.method for r in checked}
    walk = [(m, float(v)) for m, v in zip(months(100), np.tile(np.random.default_rng(2).normal(size=12) * 50, 9))]
    same = forecast.seasonal_forecast(spark.createDataFrame(walk, "month date, v double"), "v").collect()
    assert all(abs(r.actual - r.forecast) < 1e-6 for r in same)  # the same every year


def test_forecast_of_odd_series(spark):
    schema = "k string, month date, v double"
    rows = [("short", m, 1.0) for m in months(5)] + [("gap", m, None if i % 9 == 4 else float(i)) for i, m in enumerate(months(80))]
    rows += [("flat", m, 7.0) for m in months(60)] + [("none", m, None) for m in months(40)]
    got = forecast.seasonal_forecast(spark.createDataFrame(rows, schema), "v", ["k"]).collect()
    counts = {k: sum(r.k == k for r in got) for k in ("short", "gap", "flat", "none")}
    assert counts == {"short": 5, "gap": 12, "flat": 12, "none": 0}
    assert all(r.forecast is None for r in got if r.k == "short")
    assert all(r.forecast == pytest.approx(7.0) for r in got if r.k == "flat")
    empty = spark.createDataFrame([], schema)
    assert forecast.seasonal_forecast(empty, "v", ["k"]).count() == 0 and forecast.seasonal_forecast(empty, "v").count() == 0
    assert forecast.forecast_states(forecast.held_out_models(empty, "v", ["k"]), ["k"]).count() == 0


def test_saved_forecasts_go_on(spark, tmp_path):
    rows = [(k, m, float(v)) for k in (None, "a") for m, v in zip(months(84), seasonal(84, 1, 1.0))]
    rows += [("short", m, float(i)) for i, m in enumerate(months(30))]
    frame = spark.createDataFrame(rows, "k string, month date, v double")
    models = forecast.held_out_models(frame, "v", ["k"], 12)
    path = str(tmp_path / "states")
    forecast.forecast_states(models, ["k"]).write.parquet(path)
    states = spark.read.parquet(path)
    assert states.where("size(y) > 27").count() == 0
    ahead = forecast.forecast_from_states(states, ["k"], 12).collect()
    want = {(r.k, r.month): r.forecast for r in forecast.forecast_rows(models, ["k"]).collect()}
    assert len(ahead) == 36 and all(r.forecast == pytest.approx(want[r.k, r.month]) for r in ahead)
    moved = forecast.advance_states(states, frame, "v", ["k"])  # months that were seen do not count again
    assert {(r.k, str(r.last_month)) for r in moved.collect()} == {(None, "2001-12-01"), ("a", "2001-12-01"), ("short", "1997-06-01")}
    again = forecast.advance_states(moved, frame, "v", ["k"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, moved.collect()))
    next_year = forecast.forecast_from_states(moved, ["k"], 12).where("k = 'a'").orderBy("step").collect()
    true = [100 + 10 + 2 * i + 30 * np.sin(2 * np.pi * i / 12) for i in range(84, 96)]
    assert max(abs(r.forecast - v) for r, v in zip(next_year, true)) < 10


def test_grouped_inference(spark):
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for k in (None, "a", "b"):
        x = rng.normal(size=(50, 3)) * [1, 1e3, 0.1] + [1e6, 0, 5]
        y = 3 * x[:, 0] - 0.01 * x[:, 1] + rng.normal(size=50)
        rows += [(k, *map(float, r), float(v)) for r, v in zip(x, y)]
        for intercept in (True, False):
            a = np.column_stack([x, np.ones(50)]) if intercept else x
            b = np.linalg.lstsq(a, y, rcond=None)[0]
            rest = ((y - a @ b) ** 2).sum() / (50 - a.shape[1])
            scale = np.sqrt((a**2).sum(axis=0))
            want[k, intercept] = b, np.sqrt(rest * np.diag(np.linalg.inv((a / scale).T @ (a / scale)))) / scale
    rows += [("flat", 1.0, float(i), 2.0, float(i)) for i in range(9)] + [("few", 1.0, 2.0, 3.0, 4.0)] * 3
    frame = spark.createDataFrame(rows, "k string, x0 double, x1 double, x2 double, y double")
    for intercept in (True, False):
        found = inference.grouped_inference(frame, ["k"], ["x0", "x1", "x2"], "y", intercept).collect()
        for r in found:
            if r.k in ("flat", "few"):
                assert r.coefficient is None and r.p_value is None
                continue
            at = ["x0", "x1", "x2", "intercept"].index(r.feature)
            b, errors = (v[at] for v in want[r.k, intercept])
            assert r.coefficient == pytest.approx(b, rel=1e-4, abs=1e-6) and r.std_error == pytest.approx(errors, rel=1e-4)
            assert 0 <= r.p_value <= 1 and r.t == pytest.approx(r.coefficient / r.std_error)
    assert inference.grouped_inference(frame.limit(0), ["k"], ["x0"], "y").count() == 0


def test_regression_without_intercept(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(40, 2)) + [1e4, 5]
    y = x @ [2.0, -3.0] + rng.normal(size=40)
    rows = [("a", *map(float, r), float(v)) for r, v in zip(x, y)] + [("same", float(i), 2.0 * i, 1.0) for i in range(5)]
    frame = spark.createDataFrame(rows, "k string, x0 double, x1 double, y double")
    found = {(r.k, r.feature): r.coefficient for r in least_squares.grouped_regression(frame, ["k"], ["x0", "x1"], "y", False).collect()}
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    np.testing.assert_allclose([found["a", "x0"], found["a", "x1"]], want, rtol=1e-6)
    assert found["same", "x0"] is None and found["same", "x1"] is None  # one is twice the other


def test_t_probabilities():
    # Two-sided points of the t distribution from printed tables.
    for freedom, t, p in ((1, 12.706, 0.05), (5, 2.571, 0.05), (10, 3.169, 0.01), (30, 2.042, 0.05), (120, 2.617, 0.01)):
        assert inference.two_sided(t, freedom) == pytest.approx(p, rel=2e-3)
    assert inference.two_sided(0.0, 7) == pytest.approx(1) and inference.two_sided(1e9, 7) < 1e-30
    np.testing.assert_allclose(inference.two_sided(np.array([1.0, 3.0]), 1), 1 - 2 * np.arctan([1.0, 3.0]) / np.pi, atol=1e-12)


def test_published_results_are_whole(spark, tmp_path):
    folder, rows = str(tmp_path), spark.range(3)
    with pytest.raises(ValueError):
        results.read_result(spark, folder, "job", "a")
    assert results.publish_results(spark, folder, "job", {"a": rows, "b": rows}) == 1
    place = results.attempt_folder(folder, "job")
    rows.limit(1).write.parquet(f"{place}/a")  # an attempt that stopped before its version
    assert results.read_result(spark, folder, "job", "a").count() == 3
    assert results.publish_results(spark, folder, "job", {"a": rows.limit(2)}) == 2
    assert results.read_result(spark, folder, "job", "a").count() == 2
    assert results.read_result(spark, folder, "job", "b", 1).count() == 3
    with pytest.raises(ValueError):
        results.read_result(spark, folder, "job", "b")
    assert results.committed_runs(spark, folder, "job").count() == 0


def test_regression_job_tables(spark):
    rng = np.random.default_rng(8)
    volume = spark.createDataFrame([(m, int(90 + rng.integers(30))) for m in months(60)], "month date, volume long")
    tables = jobs.forecast_tables(volume)
    assert tables["volumes"].count() == 60 and tables["forecast"].count() == 12 and tables["fitted"].count() == 48
    (row,) = tables["metrics"].collect()
    made = tables["forecast"].toPandas()
    assert row.test_rmse == pytest.approx(np.sqrt(((made.actual - made.forecast) ** 2).mean()), abs=0.006)
    (run,) = tables["runs"].collect()
    assert run.metric == "MAPE" and run.value == row.test_mape


# ---------------------------------------------------------------- the network


def plain_loss(weights, sizes, x, y):
    for k, (matrix, constants) in enumerate(network.layers(weights, sizes)):
        x = x @ matrix + constants
        x = x if k == len(sizes) - 1 else np.maximum(x, 0)
    p = 1 / (1 + np.exp(-x[:, 0]))
    return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()


def test_network_gradient(spark):
    rng = np.random.default_rng(6)
    sizes = network.shapes(4, (3, 2))
    weights = rng.normal(size=sum((a + 1) * b for a, b in sizes))
    x, y = rng.normal(size=(60, 4)), rng.integers(2, size=60).astype(float)
    slope, loss = network.gradient(weights, sizes, x, y)
    assert loss == pytest.approx(plain_loss(weights, sizes, x, y))
    for k in range(len(weights)):
        step = np.zeros_like(weights)
        step[k] = 1e-6
        numeric = (plain_loss(weights + step, sizes, x, y) - plain_loss(weights - step, sizes, x, y)) / 2e-6
        assert slope[k] == pytest.approx(numeric, abs=1e-4)
    frame = spark.createDataFrame([(list(map(float, r)), float(t)) for r, t in zip(x, y)], "x array<double>, y double")
    summed, total, n = network.summed_gradient(frame.repartition(5), weights, sizes)
    np.testing.assert_allclose(summed, slope, atol=1e-9)
    assert total == pytest.approx(loss) and n == 60
    assert network.summed_gradient(frame.limit(0), weights, sizes)[2] == 0


def test_network_learns_and_is_saved(spark, tmp_path):
    rows = customers(spark, 600)
    train, test = churn.stable_split(rows, "customerid")
    made = network.fit_network(train, epochs=12, batches=3)
    assert made.losses[-1] < made.losses[0] / 4 and network.accuracy(made, test) > 95
    made.save(str(tmp_path / "n"))
    loaded = network.Network.load(spark, str(tmp_path / "n"))
    one, two = (n.score(rows).orderBy("customerid").select("probability_exit").collect() for n in (made, loaded))
    assert one == two and len(one) == 600
    x = np.array(made.encoder.transform(rows).orderBy("customerid").select(vector_to_array("features").alias("v")).toPandas().v.tolist())
    for k, (matrix, constants) in enumerate(network.layers(made.weights, made.sizes)):
        x = x @ matrix + constants
        x = x if k == len(made.sizes) - 1 else np.maximum(x, 0)
    np.testing.assert_allclose([r[0] for r in one], 1 / (1 + np.exp(-x[:, 0])), atol=1e-9)


# ---------------------------------------------------------------- the forest by absolute error


def plain_tree(x, y, depth, min_leaf):
    """A tree by trying every cut of every feature."""
    total = np.abs(y - np.median(y)).sum()
    best = None
    for f in range(x.shape[1]):
        for value in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= value
            if min(left.sum(), (~left).sum()) >= min_leaf:
                error = sum(np.abs(y[s] - np.median(y[s])).sum() for s in (left, ~left))
                if best is None or error < best[0] - 1e-9:
                    best = (error, f, value)
    if not depth or best is None or best[0] >= total - 1e-9:
        return lambda row: np.median(y)
    _, f, value = best
    left = x[:, f] <= value
    below = [plain_tree(x[s], y[s], depth - 1, min_leaf) for s in (left, ~left)]
    return lambda row: below[int(row[f] > value)](row)


@pytest.mark.parametrize("depth,min_leaf", [(0, 1), (1, 4), (2, 1), (4, 3)])
def test_tree_equals_brute_force(spark, depth, min_leaf):
    rng = np.random.default_rng(depth)
    x = rng.integers(0, 9, (70, 3)).astype(float)
    y = np.round(x[:, 0] * 3 - (x[:, 1] > 4) * 10 + rng.normal(size=70) * 2)
    frame = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    made = absolute_forest.fit_forest(frame.repartition(3), ["a", "b", "c"], "y", 1, depth, min_leaf, bootstrap=False)
    plain = plain_tree(x, y, depth, min_leaf)
    got = made.predict(frame).collect()
    assert all(r.prediction == pytest.approx(plain([r.a, r.b, r.c])) for r in got)


def test_absolute_forest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = np.where(x[:, 0] > 0, 50, 0) + x[:, 1] + rng.normal(size=400)
    y[::40] += 5000  # medians do not follow outliers
    schema = "a double, b double, c double, y double"
    frame = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], schema)
    made = absolute_forest.fit_forest(frame, ["a", "b", "c"], "y", 8, 4, 5, take=2)
    again = absolute_forest.fit_forest(frame.repartition(7), ["a", "b", "c"], "y", 8, 4, 5, take=2)
    assert made.trees == again.trees and len({tuple(t.cut) for t in made.trees}) > 1
    got = made.predict(frame).toPandas()
    near = np.abs(got.prediction - np.where(got.a > 0, 50, 0))
    assert near.median() < 5
    odd = spark.createDataFrame([(None, 1.0, 1.0, 1.0), (1e9, -1e9, 0.0, None)], schema)
    assert [r.prediction is None for r in made.predict(odd).collect()] == [True, False]
    none = absolute_forest.fit_forest(frame.limit(0), ["a"], "y", 2, 3)
    assert [r.prediction for r in none.predict(odd.where("a > 0")).collect()] == [0.0]
    copies = absolute_forest.drawn_copies(np.arange(20_000), 3, 0)
    assert copies.mean() == pytest.approx(1, abs=0.05) and (copies == 0).mean() == pytest.approx(np.exp(-1), abs=0.03)
