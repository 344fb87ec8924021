from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.functions import dates, regions, text
from ledgerline.operators import order_model
from ledgerline.operators.shaping import apply_mapping, drop_null, first_rows, trim_strings, union_all
from ledgerline.schemas import CHURN_FEATURES, CHURN_TARGET, ORDER_BOOK_RAW, PUBLISHED_COLUMNS
import pytest


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_dates_give_null_for_bad_text(spark):
    values = ["13/05/2020", "5/7/2020", "31/02/2020", "", None, "05-07-2020"]
    day = dt.date
    assert column(spark, values, "string", dates.positional_date) == [
        day(2020, 5, 13), None, None, None, None, day(2020, 7, 5)
    ]
    assert column(spark, values, "string", dates.lenient_date) == [
        day(2020, 5, 13), day(2020, 7, 5), None, None, None, day(2020, 7, 5)
    ]
    assert column(spark, values, "string", dates.us_date_text)[:3] == ["05/13/2020", "07/05/2020", None]


def test_timestamp_offsets(spark):
    values = ["2020-01-01T10:00:00+01:00", "2020-01-01T10:00:00+0100", "2020-01-01T09:00:00Z", "rubbish", None]
    seconds = column(spark, values, "string", lambda c: F.unix_seconds(dates.parse_timestamp(c)))
    assert seconds == [1577869200] * 3 + [None, None]


def test_country_is_not_title_case(spark):
    values = ["U.S.A.", "United States", "germany", "", None]
    assert column(spark, values, "string", text.normalise_country) == ["Usa", "United states", "Germany", "", None]


def test_region_lookup_is_exact(spark):
    sizes = {region: len(names) for region, names in regions.REGION_COUNTRIES.items()}
    assert sizes == {"Asia": 44, "Europe": 47, "Africa": 54, "NorthAmerica": 24, "Oceania": 14, "SouthAmerica": 12}
    rows = spark.createDataFrame([("U.S.A.",), ("Rwada",), ("germany",), ("USA",), (None,)], "c string")
    found = {r.c: r.region for r in order_model.add_region(rows, "c").collect()}
    assert found == {"U.S.A.": "NorthAmerica", "Rwada": "Africa", "germany": None, "USA": None, None: None}


def test_order_key_is_null_if_a_part_is(spark):
    rows = spark.createDataFrame([(1, 2, 3), (None, 2, 3)], "a long, b long, c long")
    key = text.order_key(F.col("a"), F.col("b"), F.col("c"))
    dashed = text.order_key(F.col("a"), F.col("b"), F.col("c"), "-")
    assert [tuple(r) for r in rows.select(key, dashed).collect()] == [("123", "1-2-3"), (None, None)]


def test_upload_type_and_list_items(spark):
    paths = ["z/file_type=testing/a.csv", "z/file_type=retraining/b.csv", "z/file_type=training/c.csv", "z/d.csv"]
    assert column(spark, paths, "string", text.upload_type) == ["Testing", "Retraining", "Training", "Training"]
    assert column(spark, ["2, 1 ,,5", ""], "string", text.list_items) == [["2", "1", "", "5"], [""]]


def test_mapping_ignores_case_and_bad_values(spark):
    rows = spark.createDataFrame([("7", "x"), ("no", "y")], "Number string, Other string")
    out = apply_mapping(rows, [("NUMBER", "n", "bigint"), ("gone", "g", "double")], allow_missing=True)
    assert [tuple(r) for r in out.collect()] == [(7, None), (None, None)]
    assert out.dtypes == [("n", "bigint"), ("g", "double")]
    with pytest.raises(ValueError):
        apply_mapping(rows, [("gone", "g", "double")])


def test_trim_only_touches_strings(spark):
    rows = spark.createDataFrame([("  a b ", 1, None)], "`s.x` string, n int, t string")
    assert [tuple(r) for r in trim_strings(rows).collect()] == [("a b", 1, None)]


def test_drop_null_keeps_rows_unless_asked(spark):
    rows = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert drop_null(rows).count() == 2
    assert drop_null(rows, how="any").count() == 1


def test_first_rows_and_union(spark):
    rows = spark.createDataFrame([(i, dt.date(2020, 1, 1 + i // 3)) for i in range(30)] + [(99, None)], "i int, d date")
    got = [r.i for r in first_rows(rows, 7, F.col("d"), ["i"]).collect()]
    assert sorted(got) == list(range(7))
    assert first_rows(rows, 100, F.col("d"), ["i"]).count() == 31
    assert union_all(rows, rows.select("d", "i")).count() == 62


def test_layout_sizes():
    assert len(ORDER_BOOK_RAW) == 65 and len(PUBLISHED_COLUMNS) == 37
    assert CHURN_FEATURES[0] == "creditscore" and CHURN_FEATURES[-1] == "estimatedsalary" and CHURN_TARGET == "exited"


def test_published_rows_can_swap_city_and_state(spark):
    values = {f.name: None for f in ORDER_BOOK_RAW} | {"shiptocity": "C", "shiptostate": "S", "ordernumber": 1}
    rows = spark.createDataFrame([tuple(values[n] for n in ORDER_BOOK_RAW.names)], ORDER_BOOK_RAW)
    plain = order_model.published_rows(rows).first()
    swapped = order_model.published_rows(rows, legacy_swap=True).first()
    assert (plain.ShipToCity, plain.ShipToState) == ("C", "S")
    assert (swapped.ShipToCity, swapped.ShipToState) == ("S", "C")
    assert plain.Country is None and plain.SLA is None and plain.UniqueId is None
