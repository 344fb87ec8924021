"""Recency, frequency and monetary customer segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import amount_sum
from ledgerline.operators.numbering import measure_quartiles


def rfm_measures(
    df: DataFrame, id_col: str, date_col: str, order_col: str, value_col: str, places: int | None = None
) -> DataFrame:
    """Days since the last order (counted from the day after the newest order), order count and value sum; for
    ``places`` see :func:`ledgerline.functions.money.amount_sum`."""
    per_customer = (
        df.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("customer"))
        .agg(
            F.max(F.col(date_col).cast("date")).alias("last_order"),
            F.count(order_col).alias("frequency"),
            amount_sum(F.col(value_col), places).alias("monetary"),
        )
    )
    run_date = df.agg(F.date_add(F.max(F.col(date_col).cast("date")), 1)).scalar()
    return per_customer.select(
        "customer", F.datediff(run_date, "last_order").cast("long").alias("recency"), "frequency", "monetary"
    )


def rfm_scores(measures: DataFrame) -> DataFrame:
    """Scores 1 (best) to 4: the most recent, most frequent and highest spending quarter scores 1. A customer without
    a known date has no score for it."""
    ranked = measure_quartiles(measures, "customer", ["recency", "frequency", "monetary"])
    return ranked.select(
        "customer",
        F.col("recency").cast("long").alias("recency"),
        F.col("frequency").cast("long").alias("frequency"),
        "monetary",
        F.col("recency_quartile").alias("r_score"),
        (5 - F.col("frequency_quartile")).alias("f_score"),
        (5 - F.col("monetary_quartile")).alias("m_score"),
    )


def segment_name(r: Column, f: Column, m: Column) -> Column:
    """Most specific segment first; the three-digit codes outrank the single scores."""
    code = F.concat(r.cast("string"), f.cast("string"), m.cast("string"))
    return (
        F.when(code == "444", "Lost Cheap Customers")
        .when(code == "411", "Lost Customers")
        .when(code == "311", "Almost Lost Customers")
        .when(code == "111", "Best Customers")
        .when(m == 1, "Big Spenders")
        .when(f == 1, "Loyal Customers")
        .when(r == 1, "Recent Customers")
        .otherwise("Others")
    )


def rfm_segments(
    df: DataFrame, id_col: str, date_col: str, order_col: str, value_col: str, places: int | None = None
) -> DataFrame:
    scored = rfm_scores(rfm_measures(df, id_col, date_col, order_col, value_col, places))
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "*",
        F.concat(r.cast("string"), f.cast("string"), m.cast("string")).alias("rfm"),
        segment_name(r, f, m).alias("segment"),
    )
