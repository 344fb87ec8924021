"""Segmentation, monthly series, currency conversion and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import month_start, parse_us_date
from ledgerline.operators import fx, rfm, series, stats
from ledgerline.plans import adapters, jobs
from ledgerline.plans.catalog import Catalog
from ledgerline.plans.catalog.cleaning import BOOK, PUBLISHED, published
from ledgerline.schemas import MACRO_SERIES
from ledgerline.session import table

CATALOG = Catalog()

# ---------------------------------------------------------------- segmentation

_RFM_RAW = """
raw AS (
  SELECT o_custkey AS customer,
         CAST((SELECT max(CAST(o_orderdate AS DATE)) + 1 FROM orders) - max(CAST(o_orderdate AS DATE)) AS BIGINT) AS recency,
         count(o_orderkey) AS frequency,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS monetary
  FROM orders GROUP BY o_custkey
)"""
_QUARTILE = "CAST(greatest(1, ceil(4.0 * (row_number() OVER (ORDER BY {m}, customer) - 1) / (count(*) OVER () - 1))) AS BIGINT)"
_RFM_SCORES = f"""{_RFM_RAW}, scores AS (
  SELECT customer, recency, frequency, monetary,
         {_QUARTILE.format(m='recency')} AS r_score,
         5 - {_QUARTILE.format(m='frequency')} AS f_score,
         5 - {_QUARTILE.format(m='monetary')} AS m_score
  FROM raw
)"""


def _rfm_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_measures(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", places=2)


def _long_scores(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("r_score", "f_score", "m_score")})


@CATALOG.query(f"WITH {_RFM_RAW} SELECT * FROM raw")
def rfm_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rfm_measures(spark, sf_dir)


@CATALOG.query(f"WITH {_RFM_SCORES} SELECT * FROM scores")
def rfm_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long_scores(rfm.rfm_scores(_rfm_measures(spark, sf_dir)))


@CATALOG.query(
    f"""WITH {_RFM_SCORES}, coded AS (SELECT *, r_score || '' || f_score || '' || m_score AS rfm FROM scores)
    SELECT *, CASE WHEN rfm = '444' THEN 'Lost Cheap Customers' WHEN rfm = '411' THEN 'Lost Customers'
      WHEN rfm = '311' THEN 'Almost Lost Customers' WHEN rfm = '111' THEN 'Best Customers'
      WHEN m_score = 1 THEN 'Big Spenders' WHEN f_score = 1 THEN 'Loyal Customers'
      WHEN r_score = 1 THEN 'Recent Customers' ELSE 'Others' END AS segment
    FROM coded"""
)
def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return _long_scores(rfm.rfm_segments(orders, "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", places=2))


_UNKNOWN = """
odd AS (SELECT CASE WHEN o_custkey % 13 <> 0 THEN o_custkey END AS customer, o_orderkey,
               CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
               CASE WHEN o_custkey % 11 <> 0 THEN o_totalprice END AS price FROM orders),
raw AS (SELECT customer, CAST((SELECT max(day) + 1 FROM odd) - max(day) AS BIGINT) AS recency, count(o_orderkey) AS frequency,
               coalesce(CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE), 0) AS monetary
        FROM odd WHERE customer IS NOT NULL GROUP BY 1)"""
_KNOWN_QUARTILE = (
    "CASE WHEN {m} IS NOT NULL THEN CAST(greatest(1, ceil(4.0 * (row_number() OVER (PARTITION BY {m} IS NULL ORDER BY {m}, "
    "customer) - 1) / (count({m}) OVER () - 1))) AS BIGINT) END"
)


@CATALOG.query(
    f"""WITH {_UNKNOWN}, scores AS (SELECT *, {_KNOWN_QUARTILE.format(m='recency')} AS r_score,
      5 - {_KNOWN_QUARTILE.format(m='frequency')} AS f_score, 5 - {_KNOWN_QUARTILE.format(m='monetary')} AS m_score FROM raw)
    SELECT * FROM scores"""
)
def rfm_with_unknown_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a readable date have no recency score, and the other customers' quartiles do not count
    them; unknown values add nothing to a sum; orders without a customer belong to nobody."""
    key = F.col("o_custkey")
    odd = table(spark, sf_dir, "orders").select(
        F.when(key % 13 != 0, key).alias("customer"),
        "o_orderkey",
        F.when(key % 7 != 0, F.col("o_orderdate")).alias("day"),
        F.when(key % 11 != 0, F.col("o_totalprice")).alias("price"),
    )
    return _long_scores(rfm.rfm_scores(rfm.rfm_measures(odd, "customer", "day", "o_orderkey", "price", places=2)))


# ---------------------------------------------------------------- monthly series

DATED = f"{PUBLISHED}, dated AS (SELECT *, CAST(strptime(OrderReceivedDate, '%m/%d/%Y') AS DATE) AS received FROM published)"
# The regressions of the reference jobs explain orders in three currencies only; forecasts count all of them.
REGRESSION_VOLUME = (
    f"{DATED}, volume AS (SELECT CAST(date_trunc('month', received) AS DATE) AS month, count(UniqueId) AS volume "
    "FROM dated WHERE Country = 'Usa' AND CurrencyCode IN ('USD', 'CAD', 'EUR') GROUP BY 1)"
)
VOLUME = (
    f"{DATED}, volume AS (SELECT CAST(date_trunc('month', received) AS DATE) AS month, count(UniqueId) AS volume "
    "FROM dated WHERE Country = 'Usa' GROUP BY 1)"
)
VOLUMES = (
    f"{DATED}, volume AS (SELECT Country AS country, CAST(date_trunc('month', received) AS DATE) AS month, "
    "count(UniqueId) AS volume FROM dated GROUP BY 1, 2)"
)
ROLLED = f"""macro AS ({adapters.MACRO_SQL}), rolled AS (
  SELECT series, CAST(date_trunc('month', date) AS DATE) AS month, CAST(count(value) AS DOUBLE) AS n,
         avg(value) AS mean, max_by(value, date) AS last FROM macro GROUP BY 1, 2)"""
FACTORS = (
    f"{ROLLED}, factors AS (SELECT month, "
    + ", ".join(f"max(CASE WHEN series = '{s}' THEN {{how}} END) AS {s}" for s in MACRO_SERIES)
    + " FROM rolled GROUP BY month)"
)


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = published(spark, sf_dir)
    return rows.withColumn("received", parse_us_date(F.col("OrderReceivedDate")))


def usa_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    usa = dated_orders(spark, sf_dir).where(F.col("Country").isin("Usa"))
    return series.monthly_volume(usa, "received", "UniqueId")


def regression_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.regression_volume(published(spark, sf_dir))


def country_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.monthly_volume(dated_orders(spark, sf_dir), "received", "UniqueId", ["Country"]).withColumnRenamed(
        "Country", "country"
    )


def _month_text(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.col("month").cast("string"))


_MONTH = "CAST(month AS VARCHAR) AS month"


@CATALOG.query(f"{VOLUME} SELECT {_MONTH}, volume FROM volume")
def monthly_volume_usa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_text(usa_volume(spark, sf_dir))


@CATALOG.query(
    f"{DATED}, usa AS (SELECT CAST(date_trunc('month', received) AS DATE) AS month, UniqueId, CurrencyCode FROM dated "
    "WHERE Country = 'Usa') SELECT CAST(month AS VARCHAR) AS month, count(UniqueId) AS forecast_volume, "
    "nullif(count(UniqueId) FILTER (CurrencyCode IN ('USD', 'CAD', 'EUR')), 0) AS regression_volume FROM usa GROUP BY month"
)
def forecast_and_regression_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts count all orders of a month, regressions those in three currencies."""
    usa = dated_orders(spark, sf_dir).where(F.col("Country") == "Usa")
    explained = F.count(F.when(F.col("CurrencyCode").isin(*fx.REGRESSION_CURRENCIES), F.col("UniqueId")))
    both = usa.groupBy(month_start(F.col("received")).alias("month")).agg(
        F.count("UniqueId").alias("forecast_volume"), F.nullif(explained, F.lit(0)).alias("regression_volume")
    )
    return _month_text(both)


@CATALOG.query(f"{VOLUMES} SELECT country, {_MONTH}, volume FROM volume")
def monthly_volume_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_text(country_volume(spark, sf_dir))


@CATALOG.query(
    "WITH v AS (SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, "
    "count(*) AS volume FROM orders GROUP BY 1, 2), "
    "s AS (SELECT customer, min(month) AS lo, max(month) AS hi FROM v GROUP BY 1), "
    "m AS (SELECT customer, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM s) "
    "SELECT m.customer, CAST(m.month AS VARCHAR) AS month, coalesce(volume, 0) AS volume "
    "FROM m LEFT JOIN v ON m.customer = v.customer AND m.month = v.month"
)
def monthly_volume_gaps_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "customer")
    volume = series.monthly_volume(orders, "o_orderdate", "o_orderkey", ["customer"])
    return _month_text(series.fill_month_gaps(volume, ["customer"]))


@CATALOG.query(
    f"WITH {ROLLED} SELECT 'count' AS how, series, {_MONTH}, n AS value FROM rolled "
    f"UNION ALL SELECT 'mean', series, {_MONTH}, round(mean, 4) FROM rolled "
    f"UNION ALL SELECT 'last', series, {_MONTH}, last FROM rolled"
)
def macro_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = series.macro_measures(adapters.macro(spark, sf_dir))
    values = {"count": F.col("count"), "mean": F.round("mean", 4), "last": F.col("last")}
    entries = F.array(*[F.struct(F.lit(how).alias("how"), value.alias("value")) for how, value in values.items()])
    rolled = measures.select("series", F.col("month").cast("string").alias("month"), F.inline(entries).alias("how", "value"))
    return rolled.select("how", "series", "month", "value")


@CATALOG.query(f"WITH {FACTORS.format(how='n')} SELECT {_MONTH}, {', '.join(MACRO_SERIES)} FROM factors")
def factor_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = series.macro_rollup(adapters.macro(spark, sf_dir), "count")
    return _month_text(series.factor_table(rolled, MACRO_SERIES))


def volume_and_factors(spark: SparkSession, sf_dir: str, how: str = "last") -> DataFrame:
    factors = series.factor_table(series.macro_rollup(adapters.macro(spark, sf_dir), how), MACRO_SERIES)
    return regression_volume(spark, sf_dir).join(factors, "month", "left")


@CATALOG.query(
    f"{REGRESSION_VOLUME}, {FACTORS.format(how='last')} SELECT CAST(v.month AS VARCHAR) AS month, volume, {', '.join(MACRO_SERIES)} "
    "FROM volume v LEFT JOIN factors f ON v.month = f.month"
)
def volume_with_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_text(volume_and_factors(spark, sf_dir))


_LAGS = ", ".join(
    f"round(ln(1 + lag(volume, {k}) OVER (PARTITION BY country ORDER BY month)), 9) AS volume_lag_{k}" for k in (1, 2, 3)
)


@CATALOG.query(f"{VOLUMES} SELECT country, {_MONTH}, volume, {_LAGS} FROM volume")
def volume_log_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = series.add_lags(country_volume(spark, sf_dir), "volume", 3, ["country"], log=True)
    return _month_text(lagged).withColumns({f"volume_lag_{k}": F.round(f"volume_lag_{k}", 9) for k in (1, 2, 3)})


@CATALOG.query(
    f"{VOLUMES}, placed AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY month) AS pos, "
    "count(*) OVER (PARTITION BY country) AS n FROM volume) "
    f"SELECT country, {_MONTH}, volume, CASE WHEN pos <= n - 12 THEN 'train' WHEN pos <= n - 3 THEN 'test' ELSE 'tail' END "
    "AS split FROM placed WHERE pos > 3"
)
def train_test_split_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_text(series.positional_split(country_volume(spark, sf_dir), ["country"]))


def _mean_sql(column: str) -> str:
    """Mean rounded half-even to cents, in whole numbers of 0.0001."""
    units, per_cent = f"CAST(sum(CAST({column} AS DECIMAL(18,4))) * 10000 AS HUGEINT)", f"(100 * count({column}))"
    up = f"2 * ({units} % {per_cent}) > {per_cent} OR (2 * ({units} % {per_cent}) = {per_cent} AND ({units} // {per_cent}) % 2 = 1)"
    return f"({units} // {per_cent} + CASE WHEN {up} THEN 1 ELSE 0 END) / 100.0::DOUBLE"


@CATALOG.query(
    f"{DATED} SELECT Country AS country, CAST(CAST(date_trunc('month', received) AS DATE) AS VARCHAR) AS month, "
    f"{_mean_sql('Discount')} AS avg_discount, {_mean_sql('OrderNetValue')} AS avg_order_value FROM dated GROUP BY 1, 2"
)
def monthly_discount_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dated_orders(spark, sf_dir).withColumnRenamed("Country", "country")
    return _month_text(series.monthly_discounts(rows, "received", "Discount", "OrderNetValue", ["country"], places=4))


DECOMPOSED = """
placed AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER f AS full_rows,
    (sum(volume) OVER f - (lag(volume, 6) OVER w + lead(volume, 6) OVER w) / 2.0) / 12.0 AS t
  FROM volume WINDOW w AS (PARTITION BY country ORDER BY month),
    f AS (PARTITION BY country ORDER BY month ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
trended AS (SELECT country, month, volume, pos % 12 AS phase, CASE WHEN full_rows = 13 THEN t END AS trend FROM placed),
means AS (SELECT country, phase, avg(volume - trend) AS mean FROM trended GROUP BY 1, 2),
centred AS (SELECT country, phase, CASE WHEN count(mean) OVER (PARTITION BY country) = 12
    THEN mean - avg(mean) OVER (PARTITION BY country) END AS seasonality FROM means)"""


@CATALOG.query(
    f"{VOLUMES}, {DECOMPOSED} SELECT t.country, {_MONTH.replace('(month', '(t.month')}, volume, round(trend, 6) AS trend, "
    "round(seasonality, 6) AS seasonality, round(volume - trend - seasonality, 6) AS residual "
    "FROM trended t JOIN centred c ON t.country IS NOT DISTINCT FROM c.country AND t.phase = c.phase"
)
def seasonal_decomposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = series.decompose(country_volume(spark, sf_dir), "volume", ["country"])
    return _month_text(parts).withColumns({c: F.round(c, 6) for c in ("trend", "seasonality", "residual")})


# ---------------------------------------------------------------- currency conversion

_RATES = f"rates AS ({adapters.named_tables(adapters.RATES_SQL)})"
_PRICED = "CASE WHEN {code} = 'USD' THEN ordergrossvalue * 1.0 ELSE ordergrossvalue * usd_rate END"


def _book_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_order_book(spark, sf_dir)
    day = F.try_to_date("scheduledbuilddate", "dd/MM/yyyy")
    return rows.select("ordernumber", "currencycode", "ordergrossvalue", day.alias("day"))


@CATALOG.query(
    f"{BOOK}, {_RATES}, newest AS (SELECT currency, max_by(usd_rate, rate_date) AS usd_rate FROM rates GROUP BY 1) "
    "SELECT ordernumber, currencycode, CASE WHEN currencycode = 'USD' THEN ordergrossvalue "
    "ELSE ordergrossvalue * usd_rate END AS gross_usd FROM raw LEFT JOIN newest ON currency = currencycode "
    "WHERE currencycode = 'USD' OR usd_rate IS NOT NULL"
)
def fx_to_usd_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = fx.to_usd(
        _book_dates(spark, sf_dir), adapters.rates(spark, sf_dir), "currencycode", {"ordergrossvalue": "gross_usd"}
    )
    return priced.select("ordernumber", "currencycode", "gross_usd")


@CATALOG.query(
    f"{BOOK}, {_RATES}, b AS (SELECT ordernumber, currencycode, ordergrossvalue, "
    "CASE WHEN currencycode = 'EUR' THEN 'JPY' ELSE currencycode END AS code, "
    "CAST(strptime(scheduledbuilddate, '%d/%m/%Y') AS DATE) AS day FROM raw) "
    "SELECT ordernumber, currencycode, CASE WHEN code = 'USD' THEN ordergrossvalue ELSE ordergrossvalue * usd_rate END "
    "AS gross_usd FROM b ASOF LEFT JOIN rates r ON b.code = r.currency AND b.day >= r.rate_date"
)
def fx_to_usd_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of the order day, with EUR priced by the JPY rate as older reports have it; all rows stay."""
    priced = fx.to_usd(
        _book_dates(spark, sf_dir),
        adapters.rates(spark, sf_dir),
        "currencycode",
        {"ordergrossvalue": "gross_usd"},
        date_col="day",
        overrides={"EUR": "JPY"},
        how="left",
    )
    return priced.select("ordernumber", "currencycode", "gross_usd")


# ---------------------------------------------------------------- statistics

_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _corr_sql(source: str, columns: list[str]) -> str:
    cells = [(a, b) for a in columns for b in columns]
    inner = ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(cells))
    arms = " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name, "
        f"round(CASE WHEN isnan(c{i}) THEN NULL ELSE c{i} END, 6) AS r FROM wide"
        for i, (a, b) in enumerate(cells)
    )
    return f"wide AS (SELECT {inner} FROM {source}) {arms}"


@CATALOG.query(
    "WITH lines AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber, "
    "CAST(1 AS DOUBLE) AS one FROM lineitem), " + _corr_sql("lines", [*_LINE_COLUMNS, "one"])
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("one", F.lit(1.0))
    return stats.correlation_matrix(lines, [*_LINE_COLUMNS, "one"]).withColumn("r", F.round("r", 6))


_FEATURES = [
    "volume", "volume_lag_1", "volume_lag_2", "volume_lag_3", "trend", "seasonality", "avg_discount", "avg_order_value"
]


@CATALOG.query(
    f"{DATED}, volume AS (SELECT 1 AS country, CAST(date_trunc('month', received) AS DATE) AS month, count(UniqueId) AS volume "
    f"FROM dated WHERE Country = 'Usa' AND CurrencyCode IN ('USD', 'CAD', 'EUR') GROUP BY 2), {DECOMPOSED}, "
    f"lagged AS (SELECT month, volume, row_number() OVER (ORDER BY month) AS pos, {_LAGS} FROM volume), "
    f"discounts AS (SELECT CAST(date_trunc('month', received) AS DATE) AS month, {_mean_sql('Discount')} AS avg_discount, "
    f"{_mean_sql('OrderNetValue')} AS avg_order_value FROM dated WHERE Country = 'Usa' GROUP BY 1), "
    "features AS (SELECT l.volume, volume_lag_1, volume_lag_2, volume_lag_3, trend, seasonality, avg_discount, avg_order_value "
    "FROM lagged l JOIN discounts d ON l.month = d.month LEFT JOIN trended t ON l.month = t.month "
    "LEFT JOIN centred c ON t.phase = c.phase WHERE pos > 3), " + _corr_sql("features", _FEATURES)
)
def feature_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume, log lags, trend, seasonality and discount statistics of the national series."""
    usa = dated_orders(spark, sf_dir).where(F.col("Country") == "Usa")
    monthly = series.decompose(regression_volume(spark, sf_dir), "volume")
    lagged = series.positional_split(series.add_lags(monthly, "volume", 3, log=True))
    discounts = series.monthly_discounts(usa, "received", "Discount", "OrderNetValue", places=4)
    features = lagged.join(discounts, "month").select(_FEATURES)
    return stats.correlation_matrix(features, _FEATURES).withColumn("r", F.round("r", 6))


@CATALOG.query(
    f"{VOLUMES}, p AS (SELECT country, CAST(volume AS DOUBLE) AS y, "
    "CAST(lag(volume) OVER (PARTITION BY country ORDER BY month) AS DOUBLE) AS x FROM volume) "
    "SELECT country, count(*) AS n, round(avg((y - x) ** 2), 6) AS mse, round(sqrt(avg((y - x) ** 2)), 6) AS rmse, "
    "round(avg(abs(y - x) / nullif(y, 0)) * 100, 6) AS mape, "
    "round(avg(abs(y - x) / nullif(x, 0)) * 100, 6) AS mape_by_prediction, "
    "round(1 - sum((y - x) ** 2) / nullif(var_pop(y) * count(*), 0), 6) AS r_squared "
    "FROM p WHERE x IS NOT NULL GROUP BY 1"
)
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the volume of the month before predicts a month, per country."""
    lagged = series.add_lags(country_volume(spark, sf_dir), "volume", 1, ["country"])
    metrics = stats.regression_metrics(lagged, "volume", "volume_lag_1", ["country"])
    return metrics.withColumns(
        {c: F.round(c, 6) for c in ("mse", "rmse", "mape", "mape_by_prediction", "r_squared")}
    )
