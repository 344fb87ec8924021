"""Order-book cleaning and publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import iso_date, lenient_date, parse_timestamp, parse_us_date, positional_date
from ledgerline.functions.dates import us_date_text
from ledgerline.functions.regions import REGION_COUNTRIES
from ledgerline.functions.text import normalise_country
from ledgerline.operators import order_model
from ledgerline.operators.fx import currency_subset
from ledgerline.operators.numbering import sequence_numbers
from ledgerline.operators.shaping import apply_mapping, drop_columns, drop_null, first_rows, trim_strings
from ledgerline.plans.adapters import ORDER_BOOK_SQL, named_tables, raw_order_book
from ledgerline.plans.catalog import Catalog
from ledgerline.schemas import ORDER_BOOK_RAW, UNPUBLISHED_COLUMNS
from ledgerline.session import table

CATALOG = Catalog()

RAW = named_tables(ORDER_BOOK_SQL)
BOOK = f"WITH raw AS ({RAW})"
_STRINGS = [f.name for f in ORDER_BOOK_RAW if f.dataType.simpleString() == "string"]
TRIMMED = f"{BOOK}, book AS (SELECT * REPLACE ({', '.join(f'trim({c}) AS {c}' for c in _STRINGS)}) FROM raw)"

STRICT = "CAST(try_strptime(substr({c}, 7, 4) || substr({c}, 4, 2) || substr({c}, 1, 2), '%Y%m%d') AS DATE)"
LENIENT = "CAST(try_strptime(replace({c}, '/', '-'), '%d-%m-%Y') AS DATE)"
US_TEXT = "strftime(" + LENIENT + ", '%m/%d/%Y')"
SLA = "CAST(" + STRICT.format(c="custacknwldgmntdate") + " - " + STRICT.format(c="orderreceiveddate") + " AS BIGINT)"
UNIQUE_ID = "CAST(marketinggroup AS VARCHAR) || CAST(billtocode AS VARCHAR) || CAST(ordernumber AS VARCHAR)"
_PLAIN = "lower(replace(billtocountryname, '.', ''))"
COUNTRY = f"upper(substr({_PLAIN}, 1, 1)) || substr({_PLAIN}, 2)"
REGION = (
    "CASE "
    + " ".join(
        f"WHEN billtocountryname IN ({', '.join(repr(n) for n in names)}) THEN '{region}'"
        for region, names in REGION_COUNTRIES.items()
    )
    + " END"
)


def typed_order_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(apply_mapping(raw_order_book(spark, sf_dir), ORDER_BOOK_RAW))


@CATALOG.query(
    f"{BOOK} SELECT ordernumber, trim(deliverymethod) AS deliverymethod, trim(modelcode) AS modelcode, "
    "trim(billtoname) AS billtoname, trim(shiptoname) AS shiptoname, ordergrossvalue FROM raw"
)
def trim_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(raw_order_book(spark, sf_dir)).select(
        "ordernumber", "deliverymethod", "modelcode", "billtoname", "shiptoname", "ordergrossvalue"
    )


@CATALOG.query(
    "SELECT o_orderkey AS order_id, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority, "
    "TRY_CAST(o_orderstatus AS BIGINT) AS status_number, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ordered, "
    "CAST(NULL AS VARCHAR) AS remark FROM orders"
)
def apply_mapping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("Priority_Digit", F.substring("o_orderpriority", 1, 1))
    mapped = apply_mapping(
        orders,
        [
            ("O_ORDERKEY", "order_id", "bigint"),
            ("priority_digit", "priority", "bigint"),
            ("o_orderstatus", "status_number", "bigint"),
            ("o_orderdate", "ordered", "date"),
            ("remark", "remark", "string"),
        ],
        allow_missing=True,
    )
    return mapped.withColumn("ordered", F.col("ordered").cast("string"))


@CATALOG.query(
    f"{BOOK} SELECT * EXCLUDE ({', '.join(c for c in UNPUBLISHED_COLUMNS if c in ORDER_BOOK_RAW.names)}) FROM raw"
)
def drop_unpublished_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(raw_order_book(spark, sf_dir), [c.upper() for c in UNPUBLISHED_COLUMNS])


@CATALOG.query(
    f"{BOOK} SELECT ordernumber, marketinggroup, ordergrossvalue FROM raw "
    "WHERE marketinggroup IS NOT NULL AND ordergrossvalue IS NOT NULL"
)
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_order_book(spark, sf_dir).select("ordernumber", "marketinggroup", "ordergrossvalue")
    return drop_null(rows, how="any", subset=["marketinggroup", "ordergrossvalue"])


@CATALOG.query(
    f"{BOOK} SELECT ordernumber, CAST({STRICT.format(c='orderreceiveddate')} AS VARCHAR) AS received_strict, "
    f"CAST({LENIENT.format(c='orderreceiveddate')} AS VARCHAR) AS received_lenient, "
    f"{US_TEXT.format(c='actualshpdate')} AS shipped_text FROM raw"
)
def date_reformat(spark: SparkSession, sf_dir: str) -> DataFrame:
    received = F.col("orderreceiveddate")
    return raw_order_book(spark, sf_dir).select(
        "ordernumber",
        positional_date(received).cast("string").alias("received_strict"),
        lenient_date(received).cast("string").alias("received_lenient"),
        us_date_text(F.col("actualshpdate")).alias("shipped_text"),
    )


@CATALOG.query(
    "SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 5400 AS seconds, "
    "CAST(CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS VARCHAR) AS day, "
    "CAST(CAST(ts AS DATE) AS VARCHAR) AS us_day FROM events"
)
def string_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    offset = F.when(F.col("event_id") % 2 == 0, "+01:30").otherwise("+0130")
    texts = events.select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), offset).alias("stamp"),
        F.when(F.col("event_id") % 7 == 0, "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.date_format("ts", "MM/dd/yyyy").alias("us_day"),
    )
    return texts.select(
        "event_id",
        F.unix_seconds(parse_timestamp(F.col("stamp"))).alias("seconds"),
        iso_date(F.col("day")).cast("string").alias("day"),
        parse_us_date(F.col("us_day")).cast("string").alias("us_day"),
    )


@CATALOG.query(f"{BOOK} SELECT ordernumber, {SLA} AS sla FROM raw")
def order_sla_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    sla = order_model.sla_days(F.col("orderreceiveddate"), F.col("custacknwldgmntdate"))
    return raw_order_book(spark, sf_dir).select("ordernumber", sla.cast("bigint").alias("sla"))


@CATALOG.query(
    f"{BOOK} SELECT ordernumber, {UNIQUE_ID} AS unique_id, ordergrossvalue - ordernetvalue AS discount, "
    "ordergrossvalue / 71 AS adj_gross, ordernetvalue / 71 AS adj_net FROM raw"
)
def order_keys_and_adjusted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_model.add_order_measures(raw_order_book(spark, sf_dir)).select(
        "ordernumber",
        F.col("uniqueid").alias("unique_id"),
        "discount",
        F.col("adj_ordergrossvalue").alias("adj_gross"),
        F.col("adj_ordernetvalue").alias("adj_net"),
    )


@CATALOG.query(f"{BOOK} SELECT ordernumber, billtocountryname, {COUNTRY} AS country FROM raw")
def country_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("billtocountryname")
    return raw_order_book(spark, sf_dir).select("ordernumber", name, normalise_country(name).alias("country"))


@CATALOG.query(
    f"{BOOK} SELECT {REGION} AS region, count(*) AS orders, sum(CAST(ordergrossvalue AS DECIMAL(18,2)))::DOUBLE AS gross "
    "FROM raw GROUP BY 1"
)
def region_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        order_model.add_region(raw_order_book(spark, sf_dir))
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("ordergrossvalue").cast("decimal(18,2)")).cast("double").alias("gross"),
        )
    )


@CATALOG.query(
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_custkey, o_orderkey) AS s_no FROM orders"
)
def order_sequence_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_custkey", "o_orderkey")
    numbered = sequence_numbers(orders, ["o_orderpriority", "o_custkey", "o_orderkey"], "s_no", unique=True)
    return numbered.select("o_orderkey", "s_no")


PUBLISHED = f"""{TRIMMED}, published AS (
SELECT {UNIQUE_ID} AS UniqueId, marketinggroup AS MarketingGroup, ordernumber AS OrderNumber, ordertype AS OrderType,
  {US_TEXT.format(c='orderreceiveddate')} AS OrderReceivedDate, seriescode AS SeriesCode, modelcode AS ModelCode,
  ordergrossvalue AS OrderGrossValue, ordernetvalue AS OrderNetValue, ordergrossvalue - ordernetvalue AS Discount,
  ordergrossvalue / 71 AS Adj_OrderGrossValue, ordernetvalue / 71 AS Adj_OrderNetValue, currencycode AS CurrencyCode,
  unitserialnumber AS UnitSerialNumber, {US_TEXT.format(c='actualshpdate')} AS ActualSHPDate,
  endcustomerorder AS EndCustomerOrder, itatruckclass AS ITATruckClass, billtocode AS BillToCode,
  billtoname AS BillToName, billtobrand AS BillToBrand, billtocustomertype AS BillToCustomerType,
  billtocustomertypedesc AS BillToCustomerTypeDesc, billtodualbrand AS BillToDualBrand, shiptoname AS ShipToName,
  shiptocountryname AS ShipToCountryName, billtocountryname AS BillToCountryName, {COUNTRY} AS Country,
  {REGION} AS Region, billtocity AS BillToCity, billtostate AS BillToState,
  shiptostandardindustrycode AS ShipToStandardIndustryCode, shiptostate AS ShipToState, shiptocity AS ShipToCity,
  orderingdealer AS OrderingDealer, deliverymethod AS DeliveryMethod, {SLA} AS SLA, file_type
FROM book)"""


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_model.published_rows(typed_order_book(spark, sf_dir))


@CATALOG.query(f"{PUBLISHED} SELECT * FROM published")
def publish_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(spark, sf_dir).withColumn("SLA", F.col("SLA").cast("bigint"))


@CATALOG.query(
    f"{PUBLISHED} SELECT *, row_number() OVER (ORDER BY UniqueId NULLS FIRST, MarketingGroup NULLS FIRST, OrderNumber) "
    "AS s_no FROM published"
)
def published_order_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = order_model.order_model(typed_order_book(spark, sf_dir))
    return numbered.withColumnRenamed("S.No", "s_no").withColumn("SLA", F.col("SLA").cast("bigint"))


@CATALOG.query(
    "SELECT o_orderkey, o_custkey FROM orders ORDER BY CAST(o_orderdate AS DATE), o_orderkey LIMIT 5000"
)
def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return first_rows(orders, 5000, F.col("o_orderdate"), ["o_orderkey"]).drop("o_orderdate")


@CATALOG.query(
    f"{BOOK} SELECT currencycode, count(*) AS orders, sum(CAST(ordernetvalue AS DECIMAL(18,4)))::DOUBLE AS net "
    "FROM raw WHERE currencycode IN ('USD', 'CAD', 'EUR') GROUP BY 1"
)
def currency_subsets_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three currencies of the regression jobs. One filter: a union of one subset per currency would read the
    book three times."""
    book = raw_order_book(spark, sf_dir).select("currencycode", "ordernetvalue")
    return (
        currency_subset(book, "currencycode")
        .groupBy("currencycode")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("ordernetvalue").cast("decimal(18,4)")).cast("double").alias("net"),
        )
    )
