"""Seasonal forecasts for many series at once.

The model is a seasonal ARIMA with one ordinary and one seasonal difference, in product form: up to 3 ordinary and 2
seasonal lags of the value and of the shocks. Orders are searched stepwise: each round fits, for every series whose
last round brought something better, the untried neighbours of its best orders, one row per series and candidate,
spread over all tasks. A model is kept if it beats the value one season earlier on an inner hold-out.

The input is the monthly series, not the orders. A series is one row with its months as an array: a century has 1,200.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructField, StructType

from ledgerline.models import arma
from ledgerline.operators.series import in_order, whole
from ledgerline.session import cut_lineage

SEASON = arma.SEASON
MAX_P = MAX_Q = 3
MAX_SP = MAX_SQ = 2
STARTS = [(2, 2, 1, 1), (0, 0, 0, 0), (1, 0, 1, 0), (0, 1, 0, 1)]
# Neighbours of orders: one more or less of one kind, or of both ordinary or both seasonal ones.
_MOVES = [m for m in product((-1, 0, 1), repeat=4) if sum(map(abs, m)) == 1 or m in (
    (1, 1, 0, 0), (-1, -1, 0, 0), (0, 0, 1, 1), (0, 0, -1, -1))]
_LEAST = 2 * SEASON  # differenced rows that a model needs

_ORDERS = "struct<p:int,q:int,sp:int,sq:int>"
_NUMBERS = ArrayType(DoubleType())
_ORDERS_TYPE = StructType([StructField(name, IntegerType()) for name in ("p", "q", "sp", "sq")])
_MODEL = StructType().add("orders", _ORDERS_TYPE).add("coefficients", _NUMBERS).add("aic", DoubleType())
_STATE = StructType().add("orders", _ORDERS_TYPE).add("coefficients", _NUMBERS)
for _part in ("y", "w", "e"):
    _STATE = _STATE.add(_part, _NUMBERS)


def with_steps(df: DataFrame, key: Sequence[str], horizon: int = SEASON) -> DataFrame:
    """``step``: 0 for training rows, 1..horizon for the last ``horizon`` rows of a series."""
    size = F.count(F.lit(1)).over(whole(key))
    step = F.row_number().over(in_order(key)) - (size - horizon)
    return df.withColumn("step", F.greatest(step, F.lit(0)).cast("int"))


def series_rows(df: DataFrame, value: str, key: Sequence[str], holdout: int = 0) -> DataFrame:
    """One row per series: ``key, y`` and ``months`` without its last ``holdout`` rows, which are ``ahead`` (structs of
    ``month`` and ``y``). A null key is a key like any other; rows without a value are left out."""
    entry = F.struct(F.col("month"), F.col(value).cast("double").alias("y"))
    rows = df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("s"))
    kept = F.greatest(F.size("s") - holdout, F.lit(0))
    return rows.where(F.size("s") > 0).select(
        *key,
        F.slice("s", F.lit(1), kept)["y"].alias("y"),
        F.slice("s", F.lit(1), kept)["month"].alias("months"),
        F.slice("s", kept + 1, F.size("s")).alias("ahead"),
    )


def _spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Few rows with much work each: dealt over all cores, which Spark would not do for so few bytes."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 8), *columns)


def _tuple(orders: dict) -> tuple[int, ...]:
    return tuple(int(orders[name]) for name in ("p", "q", "sp", "sq"))


@pandas_udf(_MODEL)
def _fitted(y: pd.Series, orders: pd.DataFrame) -> pd.DataFrame:
    """The model of given orders; a null criterion if the series is too short for it or no stable one is found."""

    def one(values, wanted):
        w, k = arma.difference(np.asarray(values, float)), sum(wanted)
        if len(w) < max(_LEAST, 3 * k + 5):
            return None, None
        b, total = arma.fit(w, wanted)
        return b.tolist(), float(arma.criterion(total, len(w), k))

    listed = [_tuple(row) for row in orders.to_dict("records")]
    found = [one(values, wanted) for values, wanted in zip(y, listed)]
    return pd.DataFrame(
        {
            "orders": [dict(zip(("p", "q", "sp", "sq"), wanted)) for wanted in listed],
            "coefficients": [b for b, _ in found],
            "aic": [aic for _, aic in found],
        }
    )


def _orders_array(listed: Sequence[tuple[int, ...]]) -> Column:
    rows = ", ".join(f"named_struct('p', {p}, 'q', {q}, 'sp', {sp}, 'sq', {sq})" for p, q, sp, sq in listed)
    return F.expr(f"array({rows})")


def _neighbours(best: str) -> Column:
    limits = {"p": MAX_P, "q": MAX_Q, "sp": MAX_SP, "sq": MAX_SQ}
    moved = ", ".join(f"'{n}', int({best}.{n} + m.{n})" for n in limits)
    inside = " AND ".join(f"o.{n} BETWEEN 0 AND {most}" for n, most in limits.items())
    moves = ", ".join(f"named_struct('p', {p}, 'q', {q}, 'sp', {sp}, 'sq', {sq})" for p, q, sp, sq in _MOVES)
    return F.expr(f"filter(transform(array({moves}), m -> named_struct({moved})), o -> {inside})")


def search(series: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of ``series`` (with ``y``) and the ``best`` model of each: a struct of orders, coefficients and criterion, null
    for a series too short for any. A round is one job: fits per series and candidate, then one aggregation per
    series; a series is done once all neighbours of its best orders have been tried.
    """
    size = F.size("found.coefficients")
    order = F.struct("found.aic", size.alias("k"), "found.orders")
    todo = series.withColumns(
        {
            "best": F.lit(None).cast(f"struct<orders:{_ORDERS},coefficients:array<double>,aic:double>"),
            "tried": F.array().cast(f"array<{_ORDERS}>"),
            "next": _orders_array(STARTS),
        }
    )
    carried, usable = [c for c in series.columns if c not in key], F.col("found.aic").isNotNull()
    finished = []
    while True:
        rows = todo.withColumn("wanted", F.explode("next")).drop("next")
        fits = _spread(rows, [*key, "wanted"]).withColumn("found", _fitted("y", "wanted"))
        merged = fits.groupBy(*key).agg(
            *[F.first(c).alias(c) for c in [*carried, "best"]],
            F.concat(F.first("tried"), F.collect_list("wanted")).alias("tried"),
            F.min_by("found", F.when(usable, order)).alias("new"),
        )
        gained = F.col("new").isNotNull() & (F.col("best").isNull() | (F.col("new.aic") < F.col("best.aic")))
        merged = merged.withColumn("best", F.when(gained, F.col("new")).otherwise(F.col("best"))).drop("new")
        following = F.when(F.col("best").isNotNull(), F.array_except(_neighbours("best.orders"), F.col("tried")))
        merged = merged.withColumn("next", F.coalesce(following, F.array().cast(f"array<{_ORDERS}>")))
        state = cut_lineage(merged)
        finished.append(state.where(F.size("next") == 0).select(*series.columns, "best"))
        todo = state.where(F.size("next") > 0)
        if todo.isEmpty():
            break
    return reduce(DataFrame.unionByName, finished)


def _naive(y: np.ndarray, steps: int) -> np.ndarray:
    """The last season over and over; ``nan`` where the series is shorter than a season."""
    if len(y) < SEASON:
        return np.full(steps, np.nan)
    return np.resize(y[-SEASON:], steps)


@pandas_udf(StructType().add("beats", BooleanType()))
def _beats_naive(y: pd.Series, best: pd.DataFrame) -> pd.DataFrame:
    """Whether the chosen orders, fitted without the last season, forecast it with a smaller squared error than the
    season before does. Null if the series is too short for that."""

    def one(values, model):
        if model["orders"] is None:
            return None
        y, orders = np.asarray(values, float), _tuple(model["orders"])
        inner, last = y[:-SEASON], y[-SEASON:]
        w = arma.difference(inner)
        if len(w) < max(_LEAST, 3 * sum(orders) + 5):
            return None
        b, _ = arma.fit(w, orders)
        _, made = arma.advance(arma.tails(inner, orders, b), orders, b, [None] * SEASON)
        return bool(((made - last) ** 2).sum() < ((_naive(inner, SEASON) - last) ** 2).sum())

    return pd.DataFrame({"beats": [one(*row) for row in zip(y, best.to_dict("records"))]})


@pandas_udf(_NUMBERS)
def _model_ahead(y: pd.Series, best: pd.DataFrame, steps: pd.Series) -> pd.Series:
    def one(values, model, n):
        y, orders, b = np.asarray(values, float), _tuple(model["orders"]), np.asarray(model["coefficients"], float)
        return arma.advance(arma.tails(y, orders, b), orders, b, [None] * int(n))[1].tolist()

    return pd.Series([one(*row) for row in zip(y, best.to_dict("records"), steps)])


def _naive_ahead(y: Column, steps: Column) -> Column:
    """The last season of ``y``, repeated; null where the series does not reach back so far."""
    places = F.slice(F.sequence(F.lit(0), steps), F.lit(1), steps)
    return F.transform(places, lambda k: F.get(y, (F.size(y) - SEASON + k % SEASON).cast("int")))


def fit_models(train: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of :func:`series_rows` with ``best`` and ``method``: ``seasonal_arima``, or ``seasonal_naive_by_check`` where the
    inner check prefers the season before, or ``seasonal_naive`` where the series is too short for a model or the check."""
    checked = search(train, key).withColumn("beats", _beats_naive("y", "best")["beats"])
    method = F.when(F.col("beats"), "seasonal_arima").when(~F.col("beats"), "seasonal_naive_by_check")
    return cut_lineage(checked.withColumn("method", F.coalesce(method, F.lit("seasonal_naive"))).drop("beats"))


def held_out_models(df: DataFrame, value: str, key: Sequence[str] = (), horizon: int = SEASON) -> DataFrame:
    """The models of all series, fitted without their last ``horizon`` rows."""
    if horizon < 1:
        raise ValueError("the horizon must be one step or more")
    return fit_models(cut_lineage(series_rows(df, value, key, horizon)), key)


def seasonal_forecast(df: DataFrame, value: str, key: Sequence[str] = (), horizon: int = SEASON) -> DataFrame:
    """Forecast the last ``horizon`` rows of each series from the rows before them: ``(key, month, step, actual, forecast,
    method)``; see :func:`fit_models` for ``method``. A series without a season before its last rows has null forecasts."""
    return forecast_rows(held_out_models(df, value, key, horizon), key)


def forecast_rows(models: DataFrame, key: Sequence[str]) -> DataFrame:
    """Forecasts of the rows that the models were fitted without."""
    uses = F.col("method") == "seasonal_arima"
    modelled = _spread(models.where(uses), [*key, "y"]).withColumn("made", _model_ahead("y", "best", F.size("ahead")))
    plain = models.where(~uses).withColumn("made", _naive_ahead(F.col("y"), F.size("ahead")))
    both = modelled.unionByName(plain)
    steps = F.arrays_zip(F.col("ahead"), F.col("made"), F.transform("ahead", lambda _, k: k + 1).alias("step"))
    rows = both.select(*key, "method", F.inline(steps).alias("ahead", "forecast", "step"))
    return rows.select(
        *key, F.col("ahead.month").alias("month"), "step", F.col("ahead.y").alias("actual"), "forecast", "method"
    )


def seasonal_naive(df: DataFrame, value: str, key: Sequence[str] = (), horizon: int = SEASON) -> DataFrame:
    """The value one season earlier as the forecast of each held-out row."""
    naive = F.lag(F.col(value).cast("double"), SEASON).over(in_order(key))
    stepped = with_steps(df.where(F.col(value).isNotNull()), key, horizon).withColumn("forecast", naive)
    return stepped.where(F.col("step") > 0).select(
        *key, "month", "step", F.col(value).cast("double").alias("actual"), "forecast"
    )


def holdout_check(df: DataFrame, value: str, key: Sequence[str] = (), horizon: int = SEASON) -> DataFrame:
    """Root mean squared errors of the forecast and of the value one season earlier over the held-out rows of each
    series: ``(key, method, n, rmse, naive_rmse)``, over the rows that have both."""
    made = seasonal_forecast(df, value, key, horizon)
    history = series_rows(df, value, key, horizon)
    naive = history.select(*key, F.posexplode(_naive_ahead(F.col("y"), F.size("ahead"))).alias("at", "naive"))
    naive = naive.select(*key, (F.col("at") + 1).alias("step"), "naive")
    # Rows of one step stand together, whether or not a key is null.
    rows = made.select(*key, "step", "actual", "forecast", "method", F.lit(None).cast("double").alias("naive"))
    both = rows.unionByName(naive, allowMissingColumns=True).groupBy(*key, "step").agg(
        *[F.max(c).alias(c) for c in ("actual", "forecast", "method", "naive")]
    )
    both = both.where(F.col("forecast").isNotNull() & F.col("naive").isNotNull())

    def rmse(name: str) -> Column:
        return F.sqrt(F.avg((F.col("actual") - F.col(name)) ** 2))

    return both.groupBy(*key, "method").agg(
        F.count(F.lit(1)).alias("n"), rmse("forecast").alias("rmse"), rmse("naive").alias("naive_rmse")
    )


@pandas_udf(_NUMBERS)
def _one_step(y: pd.Series, best: pd.DataFrame) -> pd.Series:
    def one(values, model):
        y, orders, b = np.asarray(values, float), _tuple(model["orders"]), np.asarray(model["coefficients"], float)
        e = arma.residuals(arma.difference(y), orders, [b])[:, 0]
        return [None] * (SEASON + 1) + (y[SEASON + 1 :] - e).tolist()

    return pd.Series([one(*row) for row in zip(y, best.to_dict("records"))])


def fitted_values(df: DataFrame, value: str, key: Sequence[str] = (), horizon: int = SEASON) -> DataFrame:
    """One-step-ahead fit of the training rows: ``(key, month, actual, fitted, method)``; see :func:`fitted_rows`."""
    return fitted_rows(held_out_models(df, value, key, horizon), key)


def fitted_rows(models: DataFrame, key: Sequence[str]) -> DataFrame:
    """The value that the row before would have led one to expect; the season before where that is the method. Null in the
    first rows, which have no season before them."""
    uses = F.col("method") == "seasonal_arima"
    modelled = models.where(uses).withColumn("fitted", _one_step("y", "best"))
    before = F.transform("y", lambda _, k: F.get("y", k - SEASON))
    rows = F.arrays_zip(F.col("months"), F.col("y"), F.col("fitted"))
    both = modelled.unionByName(models.where(~uses).withColumn("fitted", before))
    return both.select(*key, F.inline(rows).alias("month", "actual", "fitted"), "method")


# ------------------------------------------------------------------ saved forecasts


@pandas_udf(_STATE)
def _state(y: pd.Series, best: pd.DataFrame) -> pd.DataFrame:
    def one(values, model):
        orders, b = _tuple(model["orders"]), np.asarray(model["coefficients"], float)
        kept = arma.tails(np.asarray(values, float), orders, b)
        return [dict(zip(("p", "q", "sp", "sq"), orders)), b.tolist(), *[part.tolist() for part in kept]]

    rows = [one(*row) for row in zip(y, best.to_dict("records"))]
    return pd.DataFrame(rows, columns=["orders", "coefficients", "y", "w", "e"])


def forecast_states(models: DataFrame, key: Sequence[str]) -> DataFrame:
    """What forecasting needs of each series, without its history: ``key, method, last_month, orders, coefficients`` and the last
    values ``y``, differences ``w`` and shocks ``e``, at most 27 each. Series without a model keep their last values."""
    last = F.element_at("months", -1).alias("last_month")
    with_model = models.where("method = 'seasonal_arima'").select(*key, "method", last, _state("y", "best").alias("s"))
    tail = F.slice("y", F.greatest(F.size("y") - SEASON, F.lit(1)), F.lit(SEASON + 1))
    without = models.where("method <> 'seasonal_arima'").select(*key, "method", last, tail.alias("y"))
    return with_model.select(*key, "method", "last_month", "s.*").unionByName(without, allowMissingColumns=True)


@pandas_udf(StructType([*_STATE.fields]).add("expected", _NUMBERS))
def _advanced(state: pd.DataFrame, values: pd.Series) -> pd.DataFrame:
    def one(row, new):
        new = [None if v is None or np.isnan(v) else float(v) for v in new]
        if row["orders"] is None:
            y = np.asarray(row["y"], float)
            made = []
            for v in new:
                made.append(float(y[-SEASON]) if len(y) >= SEASON else None)
                y = np.append(y, made[-1] if v is None and made[-1] is not None else np.nan if v is None else v)
            return [None, None, y[-SEASON - 1 :].tolist(), None, None, made]
        orders, b = _tuple(row["orders"]), np.asarray(row["coefficients"], float)
        kept, made = arma.advance(tuple(row[c] for c in "ywe"), orders, b, new)
        return [row["orders"], b.tolist(), *[part.tolist() for part in kept], made.tolist()]

    rows = [one(*row) for row in zip(state.to_dict("records"), values)]
    return pd.DataFrame(rows, columns=["orders", "coefficients", "y", "w", "e", "expected"])


def _with_new(states: DataFrame, values: Column) -> DataFrame:
    parts = F.struct("orders", "coefficients", "y", "w", "e")
    return states.withColumn("s", _advanced(parts, values)).drop("orders", "coefficients", "y", "w", "e")


def advance_states(states: DataFrame, new: DataFrame, value: str, key: Sequence[str]) -> DataFrame:
    """Saved states taken on by the rows of ``new`` (``key, month, value``) after their last month, without a fit. Months at or
    before the last one have been seen and are left out; series that ``new`` does not name stay as they are."""
    entry = F.struct(F.col("month"), F.col(value).cast("double").alias("v"))
    arrived = new.where(F.col(value).isNotNull()).groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("arrived"))
    columns = [c for c in states.columns if c not in key]
    # A full grouping instead of a join: a null key is a key like any other, and each side has one row per series.
    both = states.withColumn("has_state", F.lit(True)).unionByName(arrived, allowMissingColumns=True)
    one = both.groupBy(*key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in [*columns, "has_state", "arrived"]])
    later = F.filter("arrived", lambda x: x["month"] > F.col("last_month"))
    one = one.where("has_state").withColumn("later", F.coalesce(later, F.array().cast(arrived.schema["arrived"].dataType)))
    moved = _with_new(one, F.col("later.v"))
    last = F.coalesce(F.array_max("later.month"), F.col("last_month"))
    return moved.select(
        *key, "method", last.alias("last_month"), "s.orders", "s.coefficients", "s.y", "s.w", "s.e"
    )


def forecast_from_states(states: DataFrame, key: Sequence[str], steps: int = SEASON) -> DataFrame:
    """``key, month, step, forecast, method`` of the ``steps`` months after each state's last one."""
    ahead = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda _: F.lit(None).cast("double"))
    made = _with_new(states, ahead).select(*key, "method", "last_month", F.posexplode("s.expected").alias("at", "forecast"))
    return made.select(
        *key,
        F.add_months("last_month", (F.col("at") + 1).cast("int")).alias("month"),
        (F.col("at") + 1).cast("int").alias("step"),
        "forecast",
        "method",
    )
