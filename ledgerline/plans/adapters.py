"""Order-book, macro, rate and metadata tables derived from the test tables.

Each ``*_SQL`` text runs on Spark and on DuckDB alike, with the table names filled in, so that a check of an
operator starts from the same rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import table

# Billing country per nation key.
COUNTRIES = [
    "U.S.A.", "U.S.A.", "U.S.A.", "U.S.A.", "U.S.A.", "United States", "Germany", "germany", "Atlantis",
    "Korea, South", "Canada", "Brazil", "Australia", "South Africa", "India", "Russian Federation", "U.S.A.",
    "France", "Japan", "Egypt", "Fiji", "Peru", "Congo", "Rwada", "Mexico",
]


def _case(key: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {key} {arms} END"


def _padded(day: str) -> str:
    return (
        f"lpad(CAST(day({day}) AS STRING), 2, '0') || '/' || lpad(CAST(month({day}) AS STRING), 2, '0') || '/' "
        f"|| CAST(year({day}) AS STRING)"
    )


def _unpadded(day: str) -> str:
    return f"CAST(day({day}) AS STRING) || '/' || CAST(month({day}) AS STRING) || '/' || CAST(year({day}) AS STRING)"


_ORDERED = "CAST(o_orderdate AS DATE)"
_ACKNOWLEDGED = "(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 - 1 AS INT))"
_CURRENCY = "CASE o_custkey % 6 WHEN 3 THEN 'CAD' WHEN 4 THEN 'EUR' WHEN 5 THEN 'MXN' ELSE 'USD' END"

# Line items are summed per order before the join, so an order with very many lines is one row by then. Money is
# summed as whole numbers (cents, and hundredths of a cent after the discount), which is exact in any order. Both
# sides of that join grow with the data, hence the hint; DuckDB reads it as a comment.
ORDER_BOOK_SQL = f"""
SELECT /*+ MERGE(line_values) */
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS marketinggroup,
  o_custkey % 50 AS orderingdealer,
  o_orderkey * 10 AS orderrequestnumber,
  'BOOK' AS systemorigin,
  o_orderkey AS ordernumber,
  o_orderstatus AS ordertype,
  CASE WHEN o_orderkey % 43 = 0 THEN {_unpadded(_ORDERED)} ELSE {_padded(_ORDERED)} END AS orderreceiveddate,
  ' ' || o_orderpriority || '  ' AS deliverymethod,
  c_mktsegment AS seriescode,
  '  M' || CAST(o_custkey % 12 AS STRING) AS modelcode,
  CAST(gross AS DOUBLE) / 100 AS ordergrossvalue,
  CAST(net AS DOUBLE) / 10000 AS ordernetvalue,
  {_CURRENCY} AS currencycode,
  o_orderkey % 1000 AS workunitnumber,
  o_orderkey % 7 AS workunitrevnbr,
  'U' || CAST(o_orderkey AS STRING) AS unitserialnumber,
  {_padded(_ORDERED)} AS scheduledbuilddate,
  {_padded(_ORDERED)} AS currestctsdate,
  CASE WHEN o_orderkey % 61 = 0 THEN '31/02/2020' WHEN o_orderkey % 59 = 0 THEN {_unpadded('ship')}
       ELSE {_padded('ship')} END AS actualshpdate,
  {_padded(_ORDERED)} AS actualctsdate,
  CASE WHEN o_orderkey % 53 = 0 THEN '' WHEN o_orderkey % 41 = 0 THEN {_unpadded(_ACKNOWLEDGED)}
       ELSE {_padded(_ACKNOWLEDGED)} END AS custacknwldgmntdate,
  o_custkey % 9 AS buildplantnumber,
  o_custkey % 8 AS reclearplantnumber,
  CASE WHEN o_orderkey % 3 = 0 THEN 'Y' ELSE 'N' END AS endcustomerorder,
  o_orderkey % 5 AS itatruckclass,
  'PO' || CAST(o_orderkey AS STRING) AS billtopo,
  c_mktsegment AS nomenclature,
  o_orderkey % 11 AS sionumber,
  o_orderkey % 13 AS discountauthnumber,
  'C' || CAST(o_orderkey % 17 AS STRING) AS containercontrolnbr,
  o_custkey AS billtocode,
  c_name || '   ' AS billtoname,
  c_mktsegment AS billtobrand,
  c_name AS billtoaddressline1, '' AS billtoaddressline2, '' AS billtoaddressline3, '' AS billtoaddressline4,
  '' AS billtoaddressline5,
  'City ' || CAST(c_nationkey AS STRING) AS billtocity,
  'State ' || CAST(c_nationkey % 5 AS STRING) AS billtostate,
  CAST(o_custkey AS STRING) AS billtopostalcode,
  CAST(c_nationkey AS STRING) AS billtocountrycode,
  {_case("c_nationkey", COUNTRIES)} AS billtocountryname,
  CAST(c_nationkey AS BIGINT) AS billtocountycode,
  'County' AS billtocounty,
  'A' AS billtoextactiveinactivestatus,
  o_custkey % 4 AS billtocustomertype,
  'Type ' || CAST(o_custkey % 4 AS STRING) AS billtocustomertypedesc,
  CASE WHEN o_custkey % 2 = 0 THEN 'Y' ELSE 'N' END AS billtodualbrand,
  o_custkey AS shiptocode,
  'S' AS endcustorshipto,
  '  ' || c_name || ' ' AS shiptoname,
  c_name AS shiptoaddressline1, '' AS shiptoaddressline2, '' AS shiptoaddressline3, '' AS shiptoaddressline4,
  '' AS shiptoaddressline5,
  'Ship city ' || CAST(c_nationkey AS STRING) AS shiptocity,
  'Ship state ' || CAST(c_nationkey % 5 AS STRING) AS shiptostate,
  CAST(o_custkey AS STRING) AS shiptozipcode,
  CAST(c_nationkey AS STRING) AS shiptocountrycode,
  {_case("c_nationkey", COUNTRIES)} AS shiptocountryname,
  CAST(c_nationkey AS STRING) AS shiptocountycode,
  o_custkey % 20 AS shiptostandardindustrycode,
  CASE WHEN o_orderkey % 10 = 0 THEN 'testing' WHEN o_orderkey % 10 = 1 THEN 'retraining' ELSE 'training' END
    AS file_type
FROM {{orders}}
LEFT JOIN (
  SELECT l_orderkey,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS gross,
         sum(CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS net,
         max(CAST(l_shipdate AS DATE)) AS ship
  FROM {{lineitem}} GROUP BY l_orderkey
) AS line_values ON o_orderkey = l_orderkey
JOIN {{customer}} ON o_custkey = c_custkey
"""

# Two orders of a currency may share its first day of a month; the rate then is the same.
RATES_SQL = f"""
SELECT currency, rate_date, usd_rate FROM (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN 'CAD' WHEN 1 THEN 'EUR' ELSE 'JPY' END AS currency,
         min({_ORDERED}) AS rate_date,
         CAST(0.5 AS DOUBLE) + CAST(count(*) % 64 AS DOUBLE) / 128 AS usd_rate
  FROM {{orders}}
  GROUP BY o_orderkey % 3, year({_ORDERED}), month({_ORDERED})
) AS monthly_rates
"""

CHURN_SQL = """
SELECT CAST(c_custkey + 1 AS BIGINT) AS rownumber,
       c_custkey AS customerid,
       c_name AS surname,
       CAST(350 + (c_custkey * 37) % 500 AS BIGINT) AS creditscore,
       CASE c_nationkey % 3 WHEN 0 THEN 'France' WHEN 1 THEN 'Germany' ELSE 'Spain' END AS geography,
       CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
       CAST(18 + (c_custkey * 13) % 70 AS BIGINT) AS age,
       tenure,
       c_acctbal AS balance,
       numofproducts,
       CAST(CASE c_mktsegment WHEN 'MACHINERY' THEN 0 ELSE 1 END AS BIGINT) AS hascrcard,
       isactivemember,
       estimatedsalary,
       exited,
       CASE WHEN c_custkey % 10 = 0 THEN 'testing' ELSE 'training' END AS file_type
FROM {customer}
JOIN (
  SELECT o_custkey,
         CAST(year(max(CAST(o_orderdate AS DATE))) - year(min(CAST(o_orderdate AS DATE))) AS BIGINT) AS tenure,
         count(*) AS numofproducts,
         CAST(CASE WHEN max(CAST(o_orderdate AS DATE)) >= DATE '2001-05-01' THEN 1 ELSE 0 END AS BIGINT)
           AS isactivemember,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS estimatedsalary,
         CAST(CASE WHEN max(CAST(o_orderdate AS DATE)) < DATE '2001-02-02' THEN 1 ELSE 0 END AS BIGINT) AS exited
  FROM {orders} GROUP BY o_custkey
) AS customer_orders ON c_custkey = o_custkey
"""

INGEST_LOG_SQL = """
SELECT event_id AS file_upld_log_id,
       'SRC' || CAST(user_id AS STRING) AS file_src_cd,
       event_type AS file_upld_type,
       ts AS upld_ts,
       CAST(NULL AS STRING) AS published_file_path,
       CAST(NULL AS STRING) AS published_file_name,
       CASE event_id % 4 WHEN 0 THEN 'Arema' WHEN 1 THEN 'lr' WHEN 2 THEN 'Customer_Segmentation' ELSE 'Churn' END
         AS model
FROM {events}
"""

RULE_LISTS_SQL = """
SELECT 'SRC' || CAST(user_id AS STRING) AS file_src_cd,
       event_type AS file_upld_type,
       CAST(count(*) % 97 AS STRING) || ', ' || CAST(user_id % 31 AS STRING) || ',7 ,' ||
         CAST(user_id % 31 AS STRING) || ',99999999' AS raw_to_transformed_rules,
       CAST(user_id AS STRING) || ',,' || CAST(count(*) % 13 AS STRING) AS transformed_to_published_rules
FROM {events} GROUP BY user_id, event_type
"""

RULES_SQL = "SELECT p_partkey AS rule_id, p_name || ' ' || CAST(p_partkey AS STRING) AS rule_dscrp FROM {part}"

_TABLES = ["orders", "lineitem", "customer", "events", "part"]


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: table(spark, sf_dir, t) for t in _TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def named_tables(text: str) -> str:
    """The text with plain table names, for a session where they are views."""
    for name in _TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def raw_order_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, ORDER_BOOK_SQL)


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RATES_SQL)


def churn_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, CHURN_SQL)


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, INGEST_LOG_SQL)


def rule_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RULE_LISTS_SQL)


def rule_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, RULES_SQL)


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(series, date, value)`` with monthly, quarterly and weekly series.

    Both tables are reduced to days in one scan each; the series are sums over those few rows.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"))
        .agg(
            F.sum(cents("l_quantity")).alias("quantity"),
            (F.count(F.lit(1)) * 100).alias("n_rows"),
            F.sum(cents("l_tax")).alias("tax"),
        )
    )
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.sum(cents("o_totalprice")).alias("price"), (F.count(F.lit(1)) * 100).alias("n_rows"))
    )

    def entry(series: str, unit: str, value: Column) -> Column:
        return F.struct(
            F.lit(series).alias("series"),
            F.date_trunc(unit, "day").cast("date").alias("date"),
            value.alias("value"),
        )

    parts = [
        lines.select(
            F.inline(
                F.array(
                    entry("cpi", "month", F.col("tax")),
                    entry("inpi", "month", F.col("n_rows")),
                    entry("totci", "week", F.col("quantity")),
                )
            )
        ),
        orders.select(
            F.inline(
                F.array(entry("gpdi", "quarter", F.col("price")), entry("pubdeb", "quarter", F.col("n_rows")))
            )
        ),
    ]
    return parts[0].unionByName(parts[1]).groupBy("series", "date").agg((F.sum("value") / 100).alias("value"))


MACRO_SQL = """
SELECT 'cpi' AS series, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY 2
UNION ALL SELECT 'inpi', CAST(date_trunc('month', l_shipdate) AS DATE), CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY 2
UNION ALL SELECT 'totci', CAST(date_trunc('week', l_shipdate) AS DATE),
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem GROUP BY 2
UNION ALL SELECT 'gpdi', CAST(date_trunc('quarter', o_orderdate) AS DATE),
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM orders GROUP BY 2
UNION ALL SELECT 'pubdeb', CAST(date_trunc('quarter', o_orderdate) AS DATE), CAST(count(*) AS DOUBLE) FROM orders GROUP BY 2
"""
