"""Regression, churn, forecast, forest scoring and run tracking."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.models import absolute_forest, churn, forecast, inference, least_squares, network, regression
from ledgerline.models.forest import read_nodes, score_forest
from ledgerline.operators import series, stats
from ledgerline.plans import adapters, jobs, results
from ledgerline.plans.catalog import Catalog
from ledgerline.plans.catalog.analysis import DECOMPOSED, FACTORS, REGRESSION_VOLUME, VOLUMES, country_volume, usa_volume
from ledgerline.plans.catalog.cleaning import published
from ledgerline.plans.catalog.loading import CHURN_TABLE, LOG
from ledgerline.schemas import CHURN_FEATURES
from ledgerline.session import cut_lineage, scratch_path, table, written
from ledgerline.sources.files import read_csv, read_metric_files
from ledgerline.sources.sinks import UPLOAD_COLUMN, write_result, write_zone

CATALOG = Catalog()


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months with factors and lags, computed once: the fits read it many times."""
    return cut_lineage(jobs.regression_rows(published(spark, sf_dir), adapters.macro(spark, sf_dir)))


def _month_text(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.col("month").cast("string"))


# ---------------------------------------------------------------- regression


@CATALOG.query(
    f"""{VOLUMES}, lagged AS (SELECT country, CAST(volume AS DOUBLE) AS y,
      CAST(lag(volume, 1) OVER w AS DOUBLE) AS a, CAST(lag(volume, 12) OVER w AS DOUBLE) AS b
      FROM volume WINDOW w AS (PARTITION BY country ORDER BY month)),
    s AS (SELECT country, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS saa, var_pop(b) AS sbb,
      covar_pop(a, b) AS sab, covar_pop(a, y) AS say, covar_pop(b, y) AS sby
      FROM lagged WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY country),
    c AS (SELECT *, (sbb * say - sab * sby) / (saa * sbb - sab * sab) AS ca,
      (saa * sby - sab * say) / (saa * sbb - sab * sab) AS cb FROM s)
    SELECT country, n, 'volume_lag_1' AS feature, round(ca, 6) AS coefficient FROM c
    UNION ALL SELECT country, n, 'volume_lag_12', round(cb, 6) FROM c
    UNION ALL SELECT country, n, 'intercept', round(my - ca * ma - cb * mb, 6) FROM c"""
)
def volume_regression_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume on the volume one and twelve months earlier, one regression per country in one job."""
    lagged = series.add_lags(country_volume(spark, sf_dir), "volume", 12, ["country"])
    fitted = least_squares.grouped_regression(lagged, ["country"], ["volume_lag_1", "volume_lag_12"], "volume")
    return fitted.withColumn("coefficient", F.round("coefficient", 6))


@CATALOG.query(
    "WITH v AS (SELECT o_orderpriority AS priority, o_totalprice + 1e8 AS x, 3 * o_totalprice + o_custkey AS y FROM orders) "
    "SELECT priority, count(*) AS n, 'x' AS feature, round(regr_slope(y, x), 6) AS coefficient FROM v GROUP BY 1 UNION ALL "
    "SELECT priority, count(*), 'intercept', round(regr_intercept(y, x) / 1e8, 6) FROM v GROUP BY 1"
)
def money_regression_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regressor whose mean is large beside its spread; the intercept in hundreds of millions."""
    price = F.col("o_totalprice")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"), (price + 1e8).alias("x"), (3 * price + F.col("o_custkey")).alias("y")
    )
    fitted = least_squares.grouped_regression(rows, ["priority"], ["x"], "y")
    scaled = F.when(F.col("feature") == "intercept", F.col("coefficient") / 1e8).otherwise(F.col("coefficient"))
    return fitted.withColumn("coefficient", F.round(scaled, 6))


# The t distribution's density is integrated by Simpson's rule: an independent form of the p-value.
@CATALOG.query(
    f"""{VOLUMES}, lagged AS (SELECT country, CAST(volume AS DOUBLE) AS y,
      CAST(lag(volume, 12) OVER (PARTITION BY country ORDER BY month) AS DOUBLE) AS x FROM volume),
    s AS (SELECT country, count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS level, regr_sxx(y, x) AS sxx,
      regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS mx FROM lagged WHERE x IS NOT NULL GROUP BY country),
    e AS (SELECT *, (syy - slope * sxy) / (n - 2) AS rest FROM s WHERE n > 2 AND sxx > 0),
    r AS (SELECT country, n, 'volume_lag_12' AS feature, slope AS b, sqrt(rest / sxx) AS se FROM e
      UNION ALL SELECT country, n, 'intercept', level, sqrt(rest * (1.0 / n + mx * mx / sxx)) FROM e),
    p AS (SELECT *, b / se AS t, n - 2.0 AS f FROM r),
    area AS (SELECT country, feature, sum(CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
        * pow(1 + pow(abs(t) * k / 4000.0, 2) / f, -(f + 1) / 2)) * abs(max(t)) / 12000 AS a
      FROM p, generate_series(0, 4000) AS g(k) GROUP BY country, feature)
    SELECT p.country, n, p.feature, round(b, 6) AS coefficient, round(se, 6) AS std_error,
      round(1 - 2 * a * exp(lgamma((f + 1) / 2) - lgamma(f / 2)) / sqrt(f * pi()), 6) + 0.0 AS p_value
    FROM p JOIN area ON p.country IS NOT DISTINCT FROM area.country AND p.feature = area.feature"""
)
def volume_inference_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume on the volume of a year before: coefficients, standard errors and p-values per country in one job."""
    lagged = series.add_lags(country_volume(spark, sf_dir), "volume", 12, ["country"])
    found = inference.grouped_inference(lagged, ["country"], ["volume_lag_12"], "volume")
    rounded = [F.round(c, 6).alias(c) for c in ("coefficient", "std_error", "p_value")]
    return found.where(F.col("coefficient").isNotNull()).select("country", "n", "feature", *rounded)


def _least_squares_sql(features: list[str]) -> str:
    """Predictions of a regression with intercept on the training rows, by taking each feature's part out of the later
    ones and out of the label in turn; what is left of the label is the residual."""
    complete = " AND ".join(f"{c} IS NOT NULL" for c in features)
    train = f"FILTER (split = 'train' AND {complete}) OVER ()"
    steps = [
        "c0 AS (SELECT *, "
        + ", ".join(f"{c} - avg({c}) {train} AS r_{c}" for c in [*features, "y"])
        + " FROM split_rows)"
    ]
    for i, x in enumerate(features):
        later = [*features[i + 1 :], "y"]
        parts = ", ".join(
            f"r_{c} - r_{x} * (covar_pop(r_{c}, r_{x}) {train}) / (var_pop(r_{x}) {train}) AS r_{c}" for c in later
        )
        steps.append(f"c{i + 1} AS (SELECT * REPLACE ({parts}) FROM c{i})")
    return ", ".join(steps) + f", predicted AS (SELECT month, split, volume, y, y - r_y AS prediction FROM c{len(features)})"


_SPLIT_ROWS = f"""{REGRESSION_VOLUME}, {FACTORS.format(how='last')},
joined AS (SELECT v.month, volume, CAST(volume AS DOUBLE) AS y, cpi, inpi, totci,
    ln(1 + lag(volume, 1) OVER w) AS volume_lag_1, ln(1 + lag(volume, 2) OVER w) AS volume_lag_2,
    ln(1 + lag(volume, 3) OVER w) AS volume_lag_3, row_number() OVER w AS pos, count(*) OVER () AS n
  FROM volume v LEFT JOIN factors f ON v.month = f.month WINDOW w AS (ORDER BY v.month)),
split_rows AS (SELECT *, CASE WHEN pos <= n - 12 THEN 'train' WHEN pos <= n - 3 THEN 'test' ELSE 'tail' END AS split
  FROM joined WHERE pos > 3), {_least_squares_sql(regression.FEATURES)}"""


@CATALOG.query(
    f"{_SPLIT_ROWS} SELECT CAST(month AS VARCHAR) AS month, split, volume, round(prediction, 4) AS prediction "
    "FROM predicted WHERE split <> 'tail'"
)
def volume_linear_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = _month_text(jobs.linear_predictions(_frame(spark, sf_dir)))
    return predicted.withColumn("prediction", F.round("prediction", 4))


@CATALOG.query(
    f"{_SPLIT_ROWS} SELECT split, count(*) AS n, round(avg((y - prediction) ** 2), 4) AS mse, "
    "round(sqrt(avg((y - prediction) ** 2)), 4) AS rmse, round(avg(abs(y - prediction) / nullif(y, 0)) * 100, 4) AS mape, "
    "round(avg(abs(y - prediction) / nullif(prediction, 0)) * 100, 4) AS mape_by_prediction, "
    "round(1 - sum((y - prediction) ** 2) / nullif(var_pop(y) * count(*), 0), 4) AS r_squared "
    "FROM predicted WHERE split <> 'tail' AND prediction IS NOT NULL GROUP BY split"
)
def linear_model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = jobs.linear_predictions(_frame(spark, sf_dir))
    metrics = stats.regression_metrics(predicted, "volume", "prediction", ["split"])
    return metrics.withColumns({c: F.round(c, 4) for c in ("mse", "rmse", "mape", "mape_by_prediction", "r_squared")})


@CATALOG.query()
def ols_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regression.coefficient_table(_frame(spark, sf_dir), regression.FEATURES)


@CATALOG.query()
def volume_forest_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = jobs.forest_runs(_frame(spark, sf_dir))
    return made.select("job", "model", F.to_json("params").alias("params"), "metric", "value")


_ACCURACY = (
    "runs AS (SELECT 'job-' || CAST(user_id AS VARCHAR) AS job, "
    "CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS value FROM events GROUP BY 1)"
)


@CATALOG.query(
    f"WITH {_ACCURACY} SELECT * FROM (SELECT 'largest' AS pick, job, value FROM runs ORDER BY value DESC, job LIMIT 1) "
    "UNION ALL SELECT * FROM (SELECT 'smallest', job, value FROM runs ORDER BY value, job LIMIT 1)"
)
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metric row per job is written as CSV files; all of them are read back and compared."""
    events = table(spark, sf_dir, "events")
    accuracy = F.count_if(F.col("event_type") == "click").cast("double") * 100 / F.count(F.lit(1))
    folder = scratch_path(spark, "metrics")
    events.groupBy(F.concat(F.lit("job-"), F.col("user_id")).alias("job")).agg(accuracy.alias("value")).write.option(
        "header", True
    ).csv(folder)
    made = read_metric_files(spark, folder).withColumns(
        {"model": F.lit("events"), "params": F.lit(None).cast("map<string,string>"), "metric": F.lit("Accuracy")}
    )
    largest = stats.best_run(made, "Accuracy", True).select(F.lit("largest").alias("pick"), "job", "value")
    return largest.unionByName(
        stats.best_run(made, "Accuracy", False).select(F.lit("smallest").alias("pick"), "job", "value")
    )


# ---------------------------------------------------------------- churn

_SCALED = ", ".join(
    f"round(({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER (), 6) AS {name}"
    for name, x in [
        ("geo_spain", "CASE WHEN geography = 'Spain' THEN 1.0 ELSE 0.0 END"),
        ("geo_germany", "CASE WHEN geography = 'Germany' THEN 1.0 ELSE 0.0 END"),
        ("gender", "CASE WHEN gender = 'Male' THEN 1.0 ELSE 0.0 END"),
        *[(c, f"CAST({c} AS DOUBLE)") for c in CHURN_FEATURES if c not in ("geography", "gender")],
    ]
)


@CATALOG.query(f"WITH {CHURN_TABLE} SELECT customerid, {_SCALED} FROM churn")
def churn_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eleven encoded and standardised inputs of the classifier."""
    rows = written(adapters.churn_table(spark, sf_dir), "customers")
    fitted = Pipeline(stages=churn.feature_stages(rows)).fit(rows)
    names = ["geo_spain", "geo_germany", "gender", *[c for c in CHURN_FEATURES if c not in ("geography", "gender")]]
    values = fitted.transform(rows).select("customerid", vector_to_array("features").alias("v"))
    return values.select("customerid", *[F.round(F.col("v")[i], 6).alias(n) for i, n in enumerate(names)])


@CATALOG.query(
    f"WITH {CHURN_TABLE}, p AS (SELECT exited, CASE WHEN isactivemember = 0 AND tenure < 6 THEN 1 ELSE 0 END AS predicted "
    "FROM churn) SELECT count(*) FILTER (exited = 0 AND predicted = 0) AS tn, "
    "count(*) FILTER (exited = 0 AND predicted = 1) AS fp, count(*) FILTER (exited = 1 AND predicted = 0) AS fn, "
    "count(*) FILTER (exited = 1 AND predicted = 1) AS tp, "
    "round(avg(CASE WHEN exited = predicted THEN 1.0 ELSE 0.0 END) * 100, 6) AS accuracy FROM p"
)
def churn_confusion_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain rule as the predictor: inactive and with the bank for less than six years."""
    rows = adapters.churn_table(spark, sf_dir)
    rule = ((F.col("isactivemember") == 0) & (F.col("tenure") < 6)).cast("int")
    matrix = stats.confusion_matrix(rows.withColumn("predicted", rule), "exited", "predicted")
    return matrix.withColumn("accuracy", F.round("accuracy", 6))


@CATALOG.query()
def churn_network_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.churn_classifier(adapters.churn_table(spark, sf_dir))


@CATALOG.query()
def churn_network_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = jobs.churn_runs(adapters.churn_table(spark, sf_dir))
    return made.select("job", "model", F.to_json("params").alias("params"), "metric", "value")


@CATALOG.query()
def churn_batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model is fitted, saved, loaded and applied to every customer."""
    customers = written(adapters.churn_table(spark, sf_dir), "customers")
    train, _ = churn.stable_split(customers, "customerid")
    path = scratch_path(spark, "model")
    churn.fit_logistic(train).write().save(path)
    return churn.score(PipelineModel.load(path), customers).select("customerid", "probability_exit", "predicted")


@CATALOG.query(
    f"WITH {CHURN_TABLE} SELECT customerid, customerid % 3 = 0 AS new_geography, TRUE AS scored FROM churn"
)
def churn_scoring_of_odd_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer gets a probability: also those of a geography that training did not know, without a gender, age
    or balance."""
    customers = written(adapters.churn_table(spark, sf_dir), "customers")
    train, _ = churn.stable_split(customers, "customerid")
    key = F.col("customerid")
    odd = customers.withColumns(
        {
            "geography": F.when(key % 3 == 0, "Atlantis").when(key % 5 != 0, F.col("geography")),
            "gender": F.when(key % 4 != 0, F.col("gender")),
            "age": F.when(key % 7 != 0, F.col("age")),
            "balance": F.when(key % 11 != 0, F.col("balance")),
        }
    )
    scored = churn.score(churn.fit_logistic(train), odd)
    return scored.select(
        "customerid",
        F.col("geography").eqNullSafe("Atlantis").alias("new_geography"),
        F.col("probability_exit").between(0, 1).alias("scored"),
    )


# ---------------------------------------------------------------- forecast


@CATALOG.query(
    f"{VOLUMES}, placed AS (SELECT *, CAST(lag(volume, 12) OVER w AS DOUBLE) AS forecast, row_number() OVER w AS pos, "
    "count(*) OVER (PARTITION BY country) AS n FROM volume WINDOW w AS (PARTITION BY country ORDER BY month)) "
    "SELECT country, CAST(month AS VARCHAR) AS month, pos - (n - 12) AS step, CAST(volume AS DOUBLE) AS actual, forecast "
    "FROM placed WHERE pos > n - 12"
)
def seasonal_naive_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    naive = forecast.seasonal_naive(country_volume(spark, sf_dir), "volume", ["country"])
    return _month_text(naive).withColumn("step", F.col("step").cast("bigint"))


_BEFORE = (
    f"{VOLUMES}, placed AS (SELECT *, CAST(lag(volume, 12) OVER w AS DOUBLE) AS p, CAST(volume AS DOUBLE) AS y, "
    "CASE WHEN row_number() OVER w > count(*) OVER (PARTITION BY country) - 12 THEN 'test' ELSE 'train' END AS split "
    "FROM volume WINDOW w AS (PARTITION BY country ORDER BY month))"
)


@CATALOG.query(
    f"{_BEFORE}, {DECOMPOSED.replace('placed', 'windowed')}, parts AS (SELECT t.country, CAST(t.month AS VARCHAR) AS month, "
    "volume, trend, seasonality, volume - trend - seasonality AS residual FROM trended t "
    "JOIN centred c ON t.country IS NOT DISTINCT FROM c.country AND t.phase = c.phase), "
    "scores AS (SELECT country, "
    + ", ".join(
        f"round_even({start} FILTER (split = '{side}' AND p IS NOT NULL){end}, 2) AS {side}_{name}"
        for side in ("train", "test")
        for name, start, end in (("rmse", "sqrt(avg((y - p) ** 2)", ")"), ("mape", "avg(abs(y - p) / nullif(y, 0))", " * 100"))
    )
    + " FROM placed GROUP BY country) "
    "SELECT 'volumes' AS source, country, month, 'volume' AS name, CAST(volume AS DOUBLE) AS value FROM parts "
    "UNION ALL SELECT 'decomposition', country, month, 'trend', round(trend, 6) FROM parts "
    "UNION ALL SELECT 'decomposition', country, month, 'seasonality', round(seasonality, 6) FROM parts "
    "UNION ALL SELECT 'decomposition', country, month, 'residual', round(residual, 6) FROM parts "
    + "".join(
        f"UNION ALL SELECT 'baseline', country, NULL, '{side}_{name}', {side}_{name} FROM scores "
        for side in ("train", "test")
        for name in ("rmse", "mape")
    )
    + "UNION ALL SELECT 'runs', NULL, NULL, 'committed', 1.0"
)
def forecast_job_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast job's tables, published under one version and read back through it; an attempt that was not committed
    is not seen."""
    folder, job = scratch_path(spark, "results"), "volume_forecast"
    volume = written(country_volume(spark, sf_dir), "volumes")
    write_result(volume.limit(1), results.attempt_folder(folder, job), "volumes")
    results.publish_results(spark, folder, job, jobs.forecast_tables(volume, ["country"]))

    def read(name: str) -> DataFrame:
        return results.read_result(spark, folder, job, name)

    def long(name: str, columns: list[str], month: Column) -> DataFrame:
        values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
        return read(name).select(F.lit(name).alias("source"), "country", month.alias("month"), F.inline(values))

    month, none = F.col("month").cast("string"), F.lit(None).cast("string")
    parts = long("decomposition", ["trend", "seasonality", "residual"], month).withColumn("value", F.round("value", 6))
    runs = results.committed_runs(spark, folder, job).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return (
        long("volumes", ["volume"], month)
        .unionByName(parts)
        .unionByName(long("baseline", ["train_rmse", "train_mape", "test_rmse", "test_mape"], none))
        .unionByName(
            runs.select(F.lit("runs").alias("source"), none.alias("country"), none.alias("month"), F.lit("committed").alias("name"), "value")
        )
    )


@CATALOG.query(
    f"{VOLUMES}, placed AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY month) AS pos, "
    "count(*) OVER (PARTITION BY country) AS n FROM volume) "
    "SELECT country, pos - (n - 6) AS step, TRUE AS equal FROM placed WHERE pos > n - 6"
)
def saved_forecast_goes_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts are fitted without the last year and saved; the saved ones are taken on by half a year of new months without a
    fit, and forecast the other half as the same models do that have seen these months from the start."""
    key, path = ["country"], scratch_path(spark, "states")
    volume = written(country_volume(spark, sf_dir), "volumes")
    stepped = forecast.with_steps(volume, key, 12)
    models = forecast.held_out_models(volume, "volume", key, 12)
    forecast.forecast_states(models, key).write.parquet(path)
    arrived = stepped.where("step BETWEEN 1 AND 6")
    saved = forecast.advance_states(spark.read.parquet(path), arrived.where("step <= 4"), "volume", key)
    saved = forecast.advance_states(saved, arrived.where("step >= 3"), "volume", key)  # two months come twice
    fuller = models.withColumns(
        {c: F.concat(c, F.slice(F.col("ahead")[f], 1, 6)) for c, f in (("y", "y"), ("months", "month"))}
    )
    direct = forecast.forecast_states(fuller, key)
    both = [forecast.forecast_from_states(s, key, 6).withColumnRenamed("forecast", name) for s, name in ((saved, "a"), (direct, "b"))]
    joined = both[0].join(both[1].select("country", "month", "b"), ["country", "month"])
    # A series of fewer than twelve months has nothing to go on from: both are null.
    same = F.coalesce(F.abs(F.col("a") - F.col("b")) < 1e-6, F.col("a").isNull() & F.col("b").isNull())
    return joined.select("country", F.col("step").cast("bigint").alias("step"), same.alias("equal"))


@CATALOG.query(f"WITH {CHURN_TABLE} SELECT customerid, TRUE AS equal FROM churn")
def churn_network_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer scored by the network and by the same network saved and loaded."""
    customers = written(adapters.churn_table(spark, sf_dir), "customers")
    train, _ = churn.stable_split(customers, "customerid")
    model, path = churn.fit_network(train), scratch_path(spark, "model")
    model.write().save(path)
    direct = churn.score(model, customers).select("customerid", F.col("probability_exit").alias("a"))
    loaded = churn.score(PipelineModel.load(path), customers).select("customerid", F.col("probability_exit").alias("b"))
    return direct.join(loaded, "customerid").select("customerid", (F.abs(F.col("a") - F.col("b")) < 1e-9).alias("equal"))


@CATALOG.query(f"WITH {CHURN_TABLE} SELECT customerid, TRUE AS equal FROM churn")
def named_network_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The network of rectified units, trained by distributed gradients: every customer scored by it and by the same one saved
    and loaded."""
    customers = written(adapters.churn_table(spark, sf_dir), "customers")
    train, _ = churn.stable_split(customers, "customerid")
    made, path = network.fit_network(train, epochs=3), scratch_path(spark, "network")
    made.save(path)
    direct = made.score(customers).select("customerid", F.col("probability_exit").alias("a"))
    loaded = network.Network.load(spark, path).score(customers).select("customerid", F.col("probability_exit").alias("b"))
    same = (F.abs(F.col("a") - F.col("b")) < 1e-9) & F.col("a").between(0, 1)
    return direct.join(loaded, "customerid").select("customerid", same.alias("equal"))


_TREE_FEATURES = ["l_linenumber", "l_discount", "l_tax"]
_TREE_LABEL = "CAST(l_quantity AS DOUBLE) + CASE WHEN l_linenumber > 3 THEN 10 ELSE 0 END"


@CATALOG.query(
    f"WITH t AS (SELECT {', '.join(_TREE_FEATURES)}, {_TREE_LABEL} AS y FROM lineitem), "
    + ", ".join(
        f"c{i} AS (SELECT {i} AS f, cut, (SELECT sum(abs(y - m)) FROM (SELECT y, median(y) OVER (PARTITION BY {f} <= cut) AS m FROM t)) AS e "
        f"FROM (SELECT DISTINCT {f} AS cut FROM t WHERE {f} < (SELECT max({f}) FROM t)))"
        for i, f in enumerate(_TREE_FEATURES)
    )
    + ", best AS (SELECT * FROM (SELECT * FROM c0 UNION ALL SELECT * FROM c1 UNION ALL SELECT * FROM c2) ORDER BY e, f, cut LIMIT 1), "
    "sides AS (SELECT y, CASE f WHEN 0 THEN l_linenumber <= cut WHEN 1 THEN l_discount <= cut ELSE l_tax <= cut END AS low FROM t, best), "
    "leaves AS (SELECT low, median(y) AS prediction, count(*) AS n FROM sides GROUP BY low) "
    "SELECT prediction, sum(n)::BIGINT AS n FROM leaves GROUP BY prediction"
)
def absolute_error_tree_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first split of a tree by absolute error over all order lines, and the lines that get each median."""
    lines = table(spark, sf_dir, "lineitem").select(*_TREE_FEATURES, F.expr(_TREE_LABEL).alias("y"))
    forest = absolute_forest.fit_forest(lines, _TREE_FEATURES, "y", num_trees=1, max_depth=1, bootstrap=False)
    return forest.predict(lines).groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@CATALOG.query()
def seasonal_arima_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_text(forecast.seasonal_forecast(country_volume(spark, sf_dir), "volume", ["country"]))


@CATALOG.query()
def forecast_holdout_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast's error beside that of the value one season earlier, per country."""
    return forecast.holdout_check(country_volume(spark, sf_dir), "volume", ["country"])


@CATALOG.query()
def forecast_per_training_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retraining job: every training upload has a series and a forecast of its own."""
    zone = scratch_path(spark, "published")
    rows = published(spark, sf_dir).select("UniqueId", "OrderReceivedDate", "Country", "file_type")
    write_zone(rows, zone, "DS1", "csv", upload_id="first")
    read = read_csv(spark, f"{zone}/DS1", rows.withColumn(UPLOAD_COLUMN, F.lit("")).schema)
    metrics = stats.regression_metrics(jobs.JOBS["AremaRetrain"](published=read), "actual", "forecast", [UPLOAD_COLUMN, "method"])
    return metrics.select(F.lit("Training").alias("upload_type"), UPLOAD_COLUMN, "method", "n", "rmse", "mape")


@CATALOG.query()
def forecast_fitted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_text(forecast.fitted_values(usa_volume(spark, sf_dir), "volume"))


# ---------------------------------------------------------------- forest scoring

# A forest of three trees as (tree, node, parent, feature, op, threshold, class counts).
FOREST = [
    (0, 0, None, None, None, None, [60.0, 40.0, 20.0]),
    (0, 1, 0, "age", "lessOrEqual", 40.0, [50.0, 10.0, 4.0]),
    (0, 2, 0, "age", "greaterThan", 40.0, [10.0, 30.0, 16.0]),
    (0, 3, 2, "balance", "lessOrEqual", 5000.0, [8.0, 4.0, 4.0]),
    (0, 4, 2, "balance", "greaterThan", 5000.0, [2.0, 26.0, 12.0]),
    (1, 0, None, None, None, None, [50.0, 50.0, 25.0]),
    (1, 1, 0, "creditscore", "lessOrEqual", 600.5, [5.0, 40.0, 5.0]),
    (1, 2, 0, "creditscore", "greaterThan", 600.5, [45.0, 10.0, 20.0]),
    (2, 0, None, None, None, None, [64.0, 32.0, 32.0]),
    (2, 1, 0, "numofproducts", "lessOrEqual", 9.0, [4.0, 28.0, 8.0]),
    (2, 2, 0, "numofproducts", "greaterThan", 9.0, [60.0, 4.0, 24.0]),
]
CLASSES = ["stay", "leave", "unsure"]
_TREES = [
    "CASE WHEN age <= 40 THEN [50.0/64, 10.0/64, 4.0/64]::DOUBLE[] WHEN balance <= 5000 THEN [8.0/16, 4.0/16, 4.0/16]::DOUBLE[] "
    "ELSE [2.0/40, 26.0/40, 12.0/40]::DOUBLE[] END",
    "CASE WHEN creditscore <= 600.5 THEN [5.0/50, 40.0/50, 5.0/50]::DOUBLE[] ELSE [45.0/75, 10.0/75, 20.0/75]::DOUBLE[] END",
    "CASE WHEN numofproducts <= 9 THEN [4.0/40, 28.0/40, 8.0/40]::DOUBLE[] ELSE [60.0/88, 4.0/88, 24.0/88]::DOUBLE[] END",
]


@CATALOG.query(
    f"WITH {CHURN_TABLE}, t AS (SELECT customerid, {_TREES[0]} AS a, {_TREES[1]} AS b, {_TREES[2]} AS c FROM churn), "
    "p AS (SELECT customerid, "
    + ", ".join(f"(a[{i}] + b[{i}] + c[{i}]) / 3 AS p{i}" for i in (1, 2, 3))
    + " FROM t) SELECT customerid, round(p1, 9) AS probability_stay, round(p2, 9) AS probability_leave, "
    "round(p3, 9) AS probability_unsure, CASE greatest(p1, p2, p3) WHEN p1 THEN 'stay' WHEN p2 THEN 'leave' "
    "ELSE 'unsure' END AS predicted FROM p"
)
def forest_table_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = spark.createDataFrame(
        FOREST,
        "tree int, node int, parent int, feature string, op string, threshold double, class_counts array<double>",
    )
    scored = score_forest(adapters.churn_table(spark, sf_dir), read_nodes(nodes), CLASSES)
    probabilities = [F.round(f"probability_{c}", 9).alias(f"probability_{c}") for c in CLASSES]
    return scored.select("customerid", *probabilities, "predicted")


# ---------------------------------------------------------------- jobs


@CATALOG.query(
    f"WITH {LOG} SELECT file_src_cd, file_upld_type, max_by(model, (upld_ts, file_upld_log_id)) AS model "
    "FROM log GROUP BY 1, 2"
)
def latest_model_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.latest_model_per_source(adapters.ingest_log(spark, sf_dir))


@CATALOG.query()
def job_of_newest_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the job that the newest log row asks for, run on the whole tables."""
    name = jobs.model_of_newest_upload(adapters.ingest_log(spark, sf_dir))
    result = jobs.JOBS[name](
        published=published(spark, sf_dir),
        macro=adapters.macro(spark, sf_dir),
        customers=adapters.churn_table(spark, sf_dir),
    )
    maps = [c for c, kind in result.dtypes if kind.startswith("map")]
    return result.withColumns({c: F.to_json(c) for c in maps}).withColumn("asked_by_log", F.lit(name))
