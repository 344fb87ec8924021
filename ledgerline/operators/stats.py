"""Correlations and model metrics, each computed in one aggregation over the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import quoted


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(row_name, col_name, r)`` for all ordered pairs of numeric columns, over the rows where both have a value;
    null where a column does not vary.

    One aggregation: covariances and variances about running means, each pair's variances over the pair's own rows.
    """
    names = list(columns) if columns else numeric_columns(df)
    values = df.select(*[F.col(quoted(n)).cast("double").alias(f"v{i}") for i, n in enumerate(names)])
    index = range(len(names))

    def spread(of: int, beside: int) -> Column:
        return F.var_pop(F.when(F.col(f"v{beside}").isNotNull(), F.col(f"v{of}")))

    def r(a: int, b: int) -> Column:
        return F.try_divide(F.covar_pop(f"v{a}", f"v{b}"), F.sqrt(spread(a, b)) * F.sqrt(spread(b, a)))

    pairs = list(combinations(index, 2))
    wide = values.agg(
        *[F.var_pop(f"v{i}").alias(f"s{i}") for i in index], *[r(a, b).alias(f"r{a}_{b}") for a, b in pairs]
    )

    def cell(a: int, b: int) -> Column:
        return F.when(F.col(f"s{a}") > 0, 1.0) if a == b else F.col(f"r{min(a, b)}_{max(a, b)}")

    entries = [
        F.struct(F.lit(names[a]).alias("row_name"), F.lit(names[b]).alias("col_name"), cell(a, b).alias("r"))
        for a in index
        for b in index
    ]
    return wide.select(F.inline(F.array(*entries)))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that hold at most one distinct value (nulls aside)."""
    row = df.agg(
        *[F.coalesce(F.min(quoted(c)) == F.max(quoted(c)), F.lit(True)).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    return [c for i, c in enumerate(columns) if row[i]]


def mape(actual: Column, predicted: Column, denominator: str = "actual") -> Column:
    """Mean absolute percentage error over the rows with a non-zero denominator."""
    by = {"actual": actual, "prediction": predicted}[denominator]
    return F.avg(F.try_divide(F.abs(actual - predicted), by)) * 100


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, F.lit(2))))


def r_squared(actual: Column, predicted: Column) -> Column:
    known = F.when(predicted.isNotNull(), actual)
    return 1 - F.try_divide(F.sum(F.pow(actual - predicted, F.lit(2))), F.var_pop(known) * F.count(known))


def regression_metrics(df: DataFrame, actual: str, predicted: str, key: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    scored = df.where(y.isNotNull() & p.isNotNull())
    return scored.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.pow(y - p, F.lit(2))).alias("mse"),
        rmse(y, p).alias("rmse"),
        mape(y, p).alias("mape"),
        mape(y, p, "prediction").alias("mape_by_prediction"),
        r_squared(y, p).alias("r_squared"),
    )


def split_metrics(
    df: DataFrame, actual: str, predicted: str, key: Sequence[str] = (), split: str = "split", places: int = 2
) -> DataFrame:
    """``train_rmse, test_rmse, train_mape, test_mape, test_r_squared`` in one pass, rounded half-even; rows of other splits
    and rows without a prediction do not count."""
    y, p, side = F.col(actual).cast("double"), F.col(predicted).cast("double"), F.col(split)
    known = df.where(y.isNotNull() & p.isNotNull() & side.isin("train", "test"))

    def of(kind: str, measure: Callable[[Column, Column], Column]) -> Column:
        return F.bround(measure(F.when(side == kind, y), F.when(side == kind, p)), places)

    measures = {f"{kind}_{name}": of(kind, m) for name, m in (("rmse", rmse), ("mape", mape)) for kind in ("train", "test")}
    measures["test_r_squared"] = of("test", r_squared)
    return known.groupBy(*key).agg(*[measure.alias(name) for name, measure in measures.items()])


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts of true and false negatives and positives of a 0/1 classifier, and the accuracy in percent."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        (F.avg((y == p).cast("double")) * 100).alias("accuracy"),
    )


def best_run(runs: DataFrame, metric: str, largest: bool) -> DataFrame:
    """Job with the largest or smallest value of a metric; the smaller job name wins a tie."""
    of_metric = runs.where((F.col("metric") == metric) & F.col("value").isNotNull())
    rank = F.struct((-F.col("value") if largest else F.col("value")).alias("v"), F.col("job"))
    known = [c for c in ("job", "model", "params", "metric", "value", "path") if c in runs.columns]
    best = F.min_by(F.struct(*known), rank)
    return of_metric.agg(best.alias("b")).where(F.col("b").isNotNull()).select("b.*")
