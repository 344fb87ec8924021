"""Currency conversion to USD by rate tables ``(currency, rate_date, usd_rate)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rate_code(currency: Column, overrides: Mapping[str, str] | None = None) -> Column:
    """The currency whose rate applies, for rows booked under another code."""
    out = currency
    for code, use in (overrides or {}).items():
        out = F.when(currency == code, use).otherwise(out)
    return out


MOST_CURRENCIES = 1_000  # ISO 4217 has some 300 codes, historic ones included


def latest_rates(rates: DataFrame) -> DataFrame:
    return rates.groupBy("currency").agg(F.max_by("usd_rate", "rate_date").alias("usd_rate"))


def daily_rates(rates: DataFrame) -> DataFrame:
    """One row per currency and calendar day, holding the last rate on or before that day.

    Turning validity spans into days makes the as-of lookup a plain equality join on currency and day, which
    Spark can spread over both, whereas a range join on the currency alone would put all rows of a common
    currency into one task. The size is bounded by currencies times the days covered by the rate table.
    """
    one_per_day = rates.groupBy("currency", "rate_date").agg(F.max("usd_rate").alias("usd_rate"))
    following = F.lead("rate_date").over(Window.partitionBy("currency").orderBy("rate_date"))
    spans = one_per_day.select(
        "currency", "usd_rate", "rate_date", F.coalesce(F.date_sub(following, 1), newest_rate(rates)).alias("_until")
    )
    return spans.select("currency", F.explode(F.sequence("rate_date", "_until")).alias("day"), "usd_rate")


def newest_rate(rates: DataFrame) -> Column:
    return rates.agg(F.max("rate_date")).scalar()


def to_usd(
    df: DataFrame,
    rates: DataFrame,
    currency_col: str,
    amounts: Mapping[str, str],
    date_col: str | None = None,
    overrides: Mapping[str, str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Convert ``amounts`` (source column to target column); USD needs no rate.

    Without ``date_col`` the latest rate of a currency applies, with it the last rate on or before the date.
    ``how="inner"`` drops rows without a rate, ``"left"`` keeps them with null amounts.
    """
    work = df.withColumn("_code", rate_code(F.col(currency_col), overrides))
    if date_col is None:
        lookup = latest_rates(rates).withColumnRenamed("currency", "_code").withColumnRenamed("usd_rate", "_rate")
        lookup = lookup.where(F.col("_code") != "USD")  # needs no rate
        if lookup.limit(MOST_CURRENCIES + 1).count() <= MOST_CURRENCIES:
            lookup = F.broadcast(lookup)  # a row per currency: no shuffle on codes, of which one may hold most rows
        on = ["_code"]
    else:
        # Days after the newest rate use the newest day of the table.
        work = work.withColumn("_day", F.least(F.col(date_col).cast("date"), newest_rate(rates)))
        lookup = daily_rates(rates).select(
            F.col("currency").alias("_code"), F.col("day").alias("_day"), F.col("usd_rate").alias("_rate")
        )
        on = ["_code", "_day"]
    joined = work.join(lookup, on, "left")
    rate = F.when(F.col("_code") == "USD", F.lit(1.0)).otherwise(F.col("_rate"))
    priced = joined.withColumn("_rate", rate)
    if how == "inner":
        priced = priced.where(F.col("_rate").isNotNull())
    return priced.withColumns({t: F.col(s) * F.col("_rate") for s, t in amounts.items()}).drop("_rate", "_code", "_day")


REGRESSION_CURRENCIES = ("USD", "CAD", "EUR")


def currency_subset(df: DataFrame, currency_col: str, codes: Sequence[str] = REGRESSION_CURRENCIES) -> DataFrame:
    return df.where(F.col(currency_col).isin(*codes))
