"""Analytics jobs by the model name that the ingest log holds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import parse_us_date
from ledgerline.models import churn, forecast, regression, runs
from ledgerline.operators import fx, rfm, series, stats
from ledgerline.plans.ingest_log import newest_log_row
from ledgerline.schemas import CHURN_TARGET, MACRO_SERIES, RUNS
from ledgerline.session import cut_lineage, written
from ledgerline.sources.sinks import PARTITION_COLUMN, UPLOAD_COLUMN

# The parameter grids of the retraining jobs.
FOREST_GRID = {"feature_subset": ["all", "sqrt"], "num_trees": [10, 300, 5000]}
NETWORK_GRID = {"block_size": [10, 50], "max_iter": [20, 50]}

HOME_COUNTRY = ("Usa",)


def home_volume(
    published: DataFrame, countries: Sequence[str] = HOME_COUNTRY, key: Sequence[str] = ()
) -> DataFrame:
    rows = published.withColumn("received", parse_us_date(F.col("OrderReceivedDate")))
    return series.monthly_volume(rows.where(F.col("Country").isin(*countries)), "received", "UniqueId", key)


def regression_volume(published: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """The volume that the regressions explain: orders in the three currencies only. Forecasts count all orders."""
    return home_volume(fx.currency_subset(published, "CurrencyCode"), key=key)


def customer_segmentation(published: DataFrame) -> DataFrame:
    rows = published.withColumn("received", parse_us_date(F.col("OrderReceivedDate")))
    return rfm.rfm_segments(rows, "ShipToName", "received", "OrderNumber", "Adj_OrderNetValue")


def volume_forecast(published: DataFrame) -> DataFrame:
    return forecast.seasonal_forecast(home_volume(published), "volume")


def forecast_per_upload(published: DataFrame) -> DataFrame:
    """One forecast per training upload; the rows carry their upload in ``upload_id``, so that the files a writer
    happened to split an upload into do not matter. Testing and retraining uploads have no series."""
    training = published.where(F.col(PARTITION_COLUMN) == "training")
    return forecast.seasonal_forecast(home_volume(training, key=[UPLOAD_COLUMN]), "volume", [UPLOAD_COLUMN])


def forecast_tables(volume: DataFrame, key: Sequence[str] = (), horizon: int = forecast.SEASON) -> dict[str, DataFrame]:
    """What the forecast job publishes of a monthly volume: ``volumes``, ``decomposition``, ``fitted``, ``forecast``, ``metrics`` of
    the forecast and ``baseline`` ones of the value one season earlier, the ``states`` to go on from, and its ``runs``."""
    volume = cut_lineage(volume)
    models = forecast.held_out_models(volume, "volume", key, horizon)
    fitted, ahead = cut_lineage(forecast.fitted_rows(models, key)), cut_lineage(forecast.forecast_rows(models, key))

    def sides(train: DataFrame, test: DataFrame) -> DataFrame:
        columns = [*key, "actual", "prediction", "split"]
        return train.withColumn("split", F.lit("train")).select(columns).unionByName(
            test.withColumn("split", F.lit("test")).select(columns)
        )

    made = sides(fitted.withColumnRenamed("fitted", "prediction"), ahead.withColumnRenamed("forecast", "prediction"))
    before = F.lag("volume", forecast.SEASON).over(series.in_order(key))
    naive = forecast.with_steps(volume, key, horizon).withColumns({"prediction": before, "actual": F.col("volume")})
    baseline = sides(naive.where("step = 0"), naive.where("step > 0"))
    error = stats.split_metrics(made, "actual", "prediction")
    names = [f.name for f in RUNS if f.name not in ("params", "path")]
    run = error.select(
        F.lit("volume_forecast").alias("job"),
        F.lit("seasonal_arima").alias("model"),
        F.lit("MAPE").alias("metric"),
        F.col("test_mape").alias("value"),
        F.current_timestamp().alias("ts"),
    ).select(*names)
    return {
        "volumes": volume,
        "decomposition": series.decompose(volume, "volume", key).select(*key, "month", "trend", "seasonality", "residual"),
        "fitted": fitted,
        "forecast": ahead,
        "metrics": stats.split_metrics(made, "actual", "prediction", key),
        "baseline": stats.split_metrics(baseline, "actual", "prediction", key),
        "states": forecast.forecast_states(models, key),
        "runs": run,
    }


def regression_tables(published: DataFrame, macro: DataFrame) -> dict[str, DataFrame]:
    """What the regression job publishes: ``volumes``, ``fitted`` rows, ``coefficients``, ``correlations`` of the features,
    ``metrics`` and its ``runs``."""
    frame = cut_lineage(regression_rows(published, macro))
    predicted = cut_lineage(linear_predictions(frame))
    metrics = stats.split_metrics(predicted, "volume", "prediction")
    run = metrics.select(
        F.lit("volume_regression").alias("job"),
        F.lit("linear").alias("model"),
        F.lit("MAPE").alias("metric"),
        F.col("test_mape").alias("value"),
        F.current_timestamp().alias("ts"),
    )
    return {
        "volumes": frame.select("month", "volume"),
        "fitted": predicted,
        "coefficients": regression.coefficient_table(frame, regression.FEATURES),
        "correlations": stats.correlation_matrix(frame, [regression.LABEL, *regression.FEATURES]),
        "metrics": metrics,
        "runs": run,
    }


def retraining_forecast(published: DataFrame) -> DataFrame:
    if UPLOAD_COLUMN in published.columns:
        return forecast_per_upload(published)
    if "source_file" in published.columns:
        raise ValueError(f"a file is not an upload: rows of several uploads need a column {UPLOAD_COLUMN}")
    return volume_forecast(published)


def regression_rows(published: DataFrame, macro: DataFrame, how: str = "last") -> DataFrame:
    factors = series.factor_table(series.macro_rollup(macro, how), MACRO_SERIES)
    return regression.regression_frame(regression_volume(published), factors)


def volume_regression(published: DataFrame, macro: DataFrame) -> DataFrame:
    """Predictions of the linear model for the training and test months."""
    return linear_predictions(cut_lineage(regression_rows(published, macro)))


def linear_predictions(frame: DataFrame) -> DataFrame:
    used = regression.varying(frame, regression.FEATURES)
    model = regression.fit_linear(frame.where(F.col("split") == "train"), used)
    predicted = regression.predictions(model, frame.where(F.col("split") != "tail"), used)
    return predicted.select("month", "split", "volume", "prediction")


def forest_runs(frame: DataFrame, grid: dict[str, list] | None = None, folder: str | None = None) -> DataFrame:
    """One run per forest setting, measured by the percentage error on the test months; models go to ``folder``."""
    train, test = frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")
    used = regression.varying(frame, regression.FEATURES)

    def error(model) -> float:
        predicted = regression.predictions(model, test, used)
        return stats.regression_metrics(predicted, "volume", "prediction").first()["mape"]

    return runs.run_grid(
        frame.sparkSession, "volume_forest", "MAPE", runs.grid(**(grid or FOREST_GRID)),
        lambda **params: regression.fit_forest(train, used, **params), error, folder=folder,
    )


def churn_classifier(customers: DataFrame) -> DataFrame:
    """Scores of the held-out customers. The fit passes over the rows many times, so they are written first."""
    train, test = churn.stable_split(written(customers, "customers"), "customerid")
    return churn.score(churn.fit_network(train), test).select("customerid", CHURN_TARGET, "probability_exit", "predicted")


def churn_runs(customers: DataFrame, grid: dict[str, list] | None = None, folder: str | None = None) -> DataFrame:
    train, test = churn.stable_split(written(customers, "customers"), "customerid")

    def accuracy(model) -> float:
        return stats.confusion_matrix(churn.score(model, test), CHURN_TARGET, "predicted").first()["accuracy"]

    return runs.run_grid(
        customers.sparkSession, "churn_network", "Accuracy", runs.grid(**(grid or NETWORK_GRID)),
        lambda **params: churn.fit_network(train, **params), accuracy, folder=folder,
    )


JOBS: dict[str, Callable[..., DataFrame]] = {
    "Customer_Segmentation": lambda published, **_: customer_segmentation(published),
    "Arema": lambda published, **_: volume_forecast(published),
    "AremaRetrain": lambda published, **_: retraining_forecast(published),
    "lr": lambda published, macro, **_: volume_regression(published, macro),
    "LinearRetrain": lambda published, macro, **_: forest_runs(cut_lineage(regression_rows(published, macro))),
    "Churn": lambda customers, **_: churn_classifier(customers),
    "ChurnRetrain": lambda customers, **_: churn_runs(customers),
}


def model_of_newest_upload(log: DataFrame) -> str:
    row = newest_log_row(log).select("model").first()
    if row is None or row.model not in JOBS:
        raise ValueError(f"no job for the newest upload: {row}")
    return row.model


def latest_model_per_source(log: DataFrame) -> DataFrame:
    """The model of the newest upload of every source and upload type."""
    return log.groupBy("file_src_cd", "file_upld_type").agg(
        F.max_by("model", F.struct("upld_ts", "file_upld_log_id")).alias("model")
    )
