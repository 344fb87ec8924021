"""Column layouts of the order book, the churn table and the metadata tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "long": LongType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "map": MapType(StringType(), StringType()),
}


def _layout(text: str) -> StructType:
    """``name type, name type``; unlike a DDL text this needs no running session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (item.split() for item in text.split(","))])

# The raw order book, in file order.
ORDER_BOOK_RAW = _layout(
    """
    marketinggroup long, orderingdealer long, orderrequestnumber long, systemorigin string, ordernumber long,
    ordertype string, orderreceiveddate string, deliverymethod string, seriescode string, modelcode string,
    ordergrossvalue double, ordernetvalue double, currencycode string, workunitnumber long, workunitrevnbr long,
    unitserialnumber string, scheduledbuilddate string, currestctsdate string, actualshpdate string,
    actualctsdate string, custacknwldgmntdate string, buildplantnumber long, reclearplantnumber long,
    endcustomerorder string, itatruckclass long, billtopo string, nomenclature string, sionumber long,
    discountauthnumber long, containercontrolnbr string, billtocode long, billtoname string, billtobrand string,
    billtoaddressline1 string, billtoaddressline2 string, billtoaddressline3 string, billtoaddressline4 string,
    billtoaddressline5 string, billtocity string, billtostate string, billtopostalcode string,
    billtocountrycode string, billtocountryname string, billtocountycode long, billtocounty string,
    billtoextactiveinactivestatus string, billtocustomertype long, billtocustomertypedesc string,
    billtodualbrand string, shiptocode long, endcustorshipto string, shiptoname string, shiptoaddressline1 string,
    shiptoaddressline2 string, shiptoaddressline3 string, shiptoaddressline4 string, shiptoaddressline5 string,
    shiptocity string, shiptostate string, shiptozipcode string, shiptocountrycode string,
    shiptocountryname string, shiptocountycode string, shiptostandardindustrycode long, file_type string
    """
)

# The published order book as (published name, source name), in output order.
PUBLISHED_COLUMNS = [
    ("UniqueId", "uniqueid"),
    ("MarketingGroup", "marketinggroup"),
    ("OrderNumber", "ordernumber"),
    ("OrderType", "ordertype"),
    ("OrderReceivedDate", "orderreceiveddate"),
    ("SeriesCode", "seriescode"),
    ("ModelCode", "modelcode"),
    ("OrderGrossValue", "ordergrossvalue"),
    ("OrderNetValue", "ordernetvalue"),
    ("Discount", "discount"),
    ("Adj_OrderGrossValue", "adj_ordergrossvalue"),
    ("Adj_OrderNetValue", "adj_ordernetvalue"),
    ("CurrencyCode", "currencycode"),
    ("UnitSerialNumber", "unitserialnumber"),
    ("ActualSHPDate", "actualshpdate"),
    ("EndCustomerOrder", "endcustomerorder"),
    ("ITATruckClass", "itatruckclass"),
    ("BillToCode", "billtocode"),
    ("BillToName", "billtoname"),
    ("BillToBrand", "billtobrand"),
    ("BillToCustomerType", "billtocustomertype"),
    ("BillToCustomerTypeDesc", "billtocustomertypedesc"),
    ("BillToDualBrand", "billtodualbrand"),
    ("ShipToName", "shiptoname"),
    ("ShipToCountryName", "shiptocountryname"),
    ("BillToCountryName", "billtocountryname"),
    ("Country", "country"),
    ("Region", "region"),
    ("BillToCity", "billtocity"),
    ("BillToState", "billtostate"),
    ("ShipToStandardIndustryCode", "shiptostandardindustrycode"),
    ("ShipToState", "shiptostate"),
    ("ShipToCity", "shiptocity"),
    ("OrderingDealer", "orderingdealer"),
    ("DeliveryMethod", "deliverymethod"),
    ("SLA", "sla"),
    ("file_type", "file_type"),
]

# Raw columns the published layout has no use for.
UNPUBLISHED_COLUMNS = [
    "col64", "_c64", "buildplantnumber", "reclearplantnumber", "billtopo", "nomenclature", "sionumber",
    "discountauthnumber", "containercontrolnbr", "billtoaddressline1", "billtoaddressline2", "billtoaddressline3",
    "billtoaddressline4", "billtoaddressline5", "billtopostalcode", "billtocountrycode", "billtocountycode",
    "billtocounty", "billtoextactiveinactivestatus", "shiptocode", "endcustorshipto", "shiptoaddressline1",
    "shiptoaddressline2", "shiptoaddressline3", "shiptoaddressline4", "shiptoaddressline5", "shiptozipcode",
    "shiptocountrycode", "shiptocountycode", "orderrequestnumber", "systemorigin", "workunitnumber",
    "workunitrevnbr", "actualctsdate", "custacknwldgmntdate", "scheduledbuilddate", "currestctsdate",
]

# The bank churn table, in file order.
CHURN = _layout(
    """
    rownumber long, customerid long, surname string, creditscore long, geography string, gender string, age long,
    tenure long, balance double, numofproducts long, hascrcard long, isactivemember long, estimatedsalary double,
    exited long, file_type string
    """
)

CHURN_FEATURES = CHURN.names[3:13]
CHURN_TARGET = CHURN.names[13]

RULES = _layout("rule_id long, rule_dscrp string")
RULE_LISTS = _layout(
    """
    file_src_cd string, file_upld_type string, raw_to_transformed_rules string,
    transformed_to_published_rules string
    """
)
INGEST_LOG = _layout(
    """
    file_upld_log_id long, file_src_cd string, file_upld_type string, upld_ts timestamp,
    published_file_path string, published_file_name string, model string
    """
)
MACRO = _layout("series string, date date, value double")
RATES = _layout("currency string, rate_date date, usd_rate double")
METRIC_FILE = _layout("job string, value double")
RUNS = _layout(
    "job string, model string, params map, metric string, value double, ts timestamp, path string"
)

# The macro-economic series joined to the order volume.
MACRO_SERIES = ["cpi", "inpi", "gpdi", "pubdeb", "totci"]
