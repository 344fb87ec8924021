"""The order-book model: from the raw layout to the published layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import positional_date, us_date_text
from ledgerline.functions.regions import region_lookup
from ledgerline.functions.text import normalise_country, order_key
from ledgerline.operators.numbering import sequence_numbers
from ledgerline.operators.shaping import drop_columns, publish
from ledgerline.schemas import PUBLISHED_COLUMNS, UNPUBLISHED_COLUMNS


def sla_days(received: Column, acknowledged: Column) -> Column:
    return F.datediff(positional_date(acknowledged), positional_date(received))


def add_order_measures(df: DataFrame, rate: float = 71, sep: str = "") -> DataFrame:
    """Days to acknowledgement, order key, discount and values divided by a fixed rate."""
    gross, net = F.col("ordergrossvalue"), F.col("ordernetvalue")
    return df.withColumns(
        {
            "sla": sla_days(F.col("orderreceiveddate"), F.col("custacknwldgmntdate")),
            "uniqueid": order_key(F.col("marketinggroup"), F.col("billtocode"), F.col("ordernumber"), sep),
            "discount": gross - net,
            "adj_ordergrossvalue": gross / rate,
            "adj_ordernetvalue": net / rate,
        }
    )


def reformat_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({c: us_date_text(F.col(c)) for c in ("orderreceiveddate", "actualshpdate")})


def add_country(df: DataFrame) -> DataFrame:
    return df.withColumn("country", normalise_country(F.col("billtocountryname")))


def add_region(df: DataFrame, country_col: str = "billtocountryname") -> DataFrame:
    """Region of the country exactly as written; null if the spelling is not listed."""
    lookup = F.broadcast(region_lookup(df.sparkSession))  # 195 rows, fixed
    return (
        df.join(lookup, F.col(country_col) == F.col("lookup_country"), "left")
        .drop("lookup_country")
        .withColumnRenamed("lookup_region", "region")
    )


def published_rows(df: DataFrame, rate: float = 71, legacy_swap: bool = False) -> DataFrame:
    """The published layout without the sequence number. ``legacy_swap`` exchanges ship-to city and state, as
    older files have them."""
    swap = {"shiptostate": "shiptocity", "shiptocity": "shiptostate"} if legacy_swap else {}
    layout = [(target, swap.get(source, source)) for target, source in PUBLISHED_COLUMNS]
    # Measures need the raw dates, so they come before the dates are rewritten.
    modelled = add_region(add_country(reformat_dates(add_order_measures(df, rate))))
    return publish(drop_columns(modelled, UNPUBLISHED_COLUMNS), layout)


def order_model(df: DataFrame) -> DataFrame:
    """Published layout with the sequence number ``S.No`` by order key."""
    return sequence_numbers(published_rows(df), ["UniqueId", "MarketingGroup", "OrderNumber"], "S.No", ties="hash")
