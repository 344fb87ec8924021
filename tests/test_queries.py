from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    connection = duck(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_its_sql(spark, views, name):
    good, note = compare(spark, views, name, SF_DIR)
    assert good, note


def test_registration():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert "rfm_segments" in spark_entry.queries()


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


def test_no_python_in_the_order_model(spark):
    frame = spark_entry.queries()["publish_layout"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SinglePartition" not in plan


def test_scan_reads_only_what_the_series_needs(spark):
    frame = spark_entry.queries()["monthly_volume_by_country"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "l_orderkey" not in plan
