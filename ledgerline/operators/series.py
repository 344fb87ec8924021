"""Monthly series: volumes, macro factors, lags, positional splits and seasonal decomposition.

The volume and roll-up operators aggregate the full data once. Everything after them works on one row per
series and month, so a window without a series key spans at most the calendar months of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerline.functions.dates import month_start
from ledgerline.functions.money import amount_mean


def in_order(key: Sequence[str], order: str = "month") -> WindowSpec:
    return Window.partitionBy(*key).orderBy(order) if key else Window.orderBy(order)


def whole(key: Sequence[str], order: str = "month") -> WindowSpec:
    return in_order(key, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def monthly_volume(df: DataFrame, date_col: str, id_col: str, key: Sequence[str] = ()) -> DataFrame:
    """Number of non-null ids per month and series."""
    month = month_start(F.col(date_col)).alias("month")
    return (
        df.where(F.col(date_col).isNotNull())
        .groupBy(*key, month)
        .agg(F.count(id_col).alias("volume"))
    )


def fill_month_gaps(volume: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Months without rows between the first and last month of a series, with volume 0."""
    last_before_next = F.coalesce(F.add_months(F.lead("month").over(in_order(key)), -1), F.col("month"))
    spans = volume.withColumn("_months", F.sequence("month", last_before_next, F.expr("interval 1 month")))
    return (
        spans.withColumn("_month", F.explode("_months"))
        .select(
            *key,
            F.col("_month").alias("month"),
            F.when(F.col("_month") == F.col("month"), F.col("volume")).otherwise(0).alias("volume"),
        )
    )


def macro_measures(macro: DataFrame) -> DataFrame:
    """``(series, date, value)`` observations by month, in one aggregation: ``count``, ``mean`` and ``last``."""
    return (
        macro.where(F.col("date").isNotNull())
        .groupBy("series", month_start(F.col("date")).alias("month"))
        .agg(
            F.count("value").cast("double").alias("count"),
            F.avg("value").alias("mean"),
            F.max_by("value", "date").alias("last"),
        )
    )


def macro_rollup(macro: DataFrame, how: str = "count") -> DataFrame:
    """Observations rolled up to months by count, mean or last observation; the other measures are not computed."""
    return macro_measures(macro).select("series", "month", F.col(how).alias("value"))


def factor_table(rolled: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per month with one column per series, null where a series has no value: a full outer join of
    all series on month, done as a single pivot."""
    return rolled.groupBy("month").pivot("series", list(series)).agg(F.first("value"))


def add_lags(df: DataFrame, value: str, lags: int = 3, key: Sequence[str] = (), log: bool = False) -> DataFrame:
    """``<value>_lag_k``: the value k rows earlier in month order, optionally as ``log(1 + x)``."""
    window = in_order(key)

    def lagged(k: int) -> Column:
        column = F.lag(value, k).over(window)
        return F.log1p(column) if log else column

    return df.withColumns({f"{value}_lag_{k}": lagged(k) for k in range(1, lags + 1)})


def positional_split(
    df: DataFrame, key: Sequence[str] = (), skip: int = 3, holdout: int = 12, unused_tail: int = 3
) -> DataFrame:
    """``split``: the first ``skip`` rows of a series are dropped, the last ``holdout`` rows are held out and
    of these the last ``unused_tail`` are marked ``tail`` instead of ``test``."""
    numbered = df.withColumns(
        {"_at": F.row_number().over(in_order(key)), "_left": F.count(F.lit(1)).over(whole(key)) }
    ).withColumn("_left", F.col("_left") - F.col("_at"))
    return (
        numbered.where(F.col("_at") > skip)
        .withColumn(
            "split",
            F.when(F.col("_left") >= holdout, "train").when(F.col("_left") >= unused_tail, "test").otherwise("tail"),
        )
        .drop("_at", "_left")
    )


def monthly_discounts(
    df: DataFrame,
    date_col: str,
    discount_col: str,
    value_col: str,
    key: Sequence[str] = (),
    places: int | None = None,
) -> DataFrame:
    """Mean discount and mean order value per month, rounded half-even to two places; for ``places`` see
    :func:`ledgerline.functions.money.amount_mean`."""
    return (
        df.where(F.col(date_col).isNotNull())
        .groupBy(*key, month_start(F.col(date_col)).alias("month"))
        .agg(
            F.bround(amount_mean(F.col(discount_col), places), 2).alias("avg_discount"),
            F.bround(amount_mean(F.col(value_col), places), 2).alias("avg_order_value"),
        )
    )


def decompose(df: DataFrame, value: str, key: Sequence[str] = (), period: int = 12) -> DataFrame:
    """Additive decomposition into trend, seasonality and residual over an even ``period``.

    The trend is the centred moving average over ``period + 1`` rows with half weights at both ends, the
    seasonality the mean detrended value of each phase, shifted to mean zero. Rows without a full window have no
    trend; a series shorter than two periods has no seasonality either.
    """
    order = in_order(key)
    half = period // 2
    frame = order.rowsBetween(-half, half)
    x = F.col(value).cast("double")
    ends = (F.lag(x, half).over(order) + F.lead(x, half).over(order)) / 2
    complete = F.count(x).over(frame) == period + 1
    rows = df.where(F.col(value).isNotNull()).withColumns(
        {
            "trend": F.when(complete, (F.sum(x).over(frame) - ends) / period),
            "_phase": F.pmod(F.row_number().over(order) - 1, F.lit(period)),
        }
    )
    # All windows below are partitioned by the series or finer, so they share one shuffle.
    phase = Window.partitionBy(*key, "_phase")
    series = Window.partitionBy(*key)
    rows = rows.withColumns(
        {"_mean": F.avg(x - F.col("trend")).over(phase), "_size": F.count(F.lit(1)).over(phase)}
    ).withColumns(
        {
            # Every row adds its share of its phase's mean, so the sums run over phases, not rows.
            "_centre": F.sum(F.col("_mean") / F.col("_size")).over(series) / period,
            "_phases": F.max("_phase").over(series) + 1,
            "_missing": F.count_if(F.col("_mean").isNull()).over(series),
        }
    )
    full = (F.col("_missing") == 0) & (F.col("_phases") == period)
    return rows.withColumn("seasonality", F.when(full, F.col("_mean") - F.col("_centre"))).withColumn(
        "residual", x - F.col("trend") - F.col("seasonality")
    ).drop("_phase", "_mean", "_size", "_centre", "_phases", "_missing")
