"""Reports over tables named in the session catalog."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest

from stocklens.functions import timewin
from stocklens.operators import demand
from stocklens.plans.catalog import TEST_DATES
from stocklens.plans.reports import Reports
from stocklens.session import ADAPTIVE, tune
from stocklens.sources.named import NamedTables
from stocklens.sources.schemas import RELATIONS, conform
from stocklens.sources.startables import StarTables

PATH = "/root/testdata/sf0.001"


@pytest.fixture
def named(spark):
    star = StarTables(spark, PATH)
    for relation in RELATIONS:
        getattr(star, relation).createOrReplaceTempView(f"wh_{relation}")
    yield NamedTables(spark, {relation: f"wh_{relation}" for relation in RELATIONS})
    for relation in RELATIONS:
        spark.catalog.dropTempView(f"wh_{relation}")


@pytest.mark.parametrize("name", ["ordering_master", "forecast_monitor", "forecast_horizons"])
def test_named_tables_give_the_same(spark, named, rows, name):
    star = Reports(StarTables(spark, PATH), TEST_DATES)
    expected = rows(getattr(star, name)())
    assert expected
    assert rows(getattr(Reports(named, TEST_DATES), name)()) == expected


def test_unnamed_and_unknown_relations(spark):
    tables = NamedTables(spark, {})
    with pytest.raises(KeyError):
        tables.dim_product
    with pytest.raises(AttributeError):
        tables.no_such_relation


def test_conform_selects_and_casts(spark):
    raw = spark.sql(
        "SELECT 'x' AS extra, 3 AS item_no, 1.005D AS remaining_quantity, 'D' AS document_no,"
        " 'MARK_WE' AS location_code, false AS delete_flag, 0 AS entry_type"
    )
    [row] = conform(raw, "item_ledger").collect()
    assert row.asDict() == {
        "item_no": "3",
        "remaining_quantity": row["remaining_quantity"],
        "document_no": "D",
        "location_code": "MARK_WE",
        "delete_flag": "false",
        "entry_type": "0",
    }
    assert str(row["remaining_quantity"]) == "1.0050000000"


def test_decimals_with_more_digits_and_extra_columns_stay(spark):
    raw = spark.sql(
        "SELECT 'p' AS product_id, TIMESTAMP_NTZ '2018-06-15 12:00:00' AS calendar_date,"
        " CAST(0.000000000001 AS decimal(20,12)) AS snop_daily_forecast, 'x' AS brand"
    )
    [row] = conform(raw, "daily_forecast", ["brand"]).collect()
    assert row["brand"] == "x" and row["calendar_date"].hour == 12
    assert row["snop_daily_forecast"] == Decimal("0.000000000001")
    raw.createOrReplaceTempView("wh_extra")
    names = {"daily_forecast": "wh_extra"}
    assert "brand" not in NamedTables(spark, names).daily_forecast.columns
    assert "brand" in NamedTables(spark, names, {"daily_forecast": ["brand"]}).daily_forecast.columns


def test_date_windows_of_named_tables_reach_the_scan(spark, tmp_path):
    spark.sql(
        "SELECT 'p' AS product_id, TIMESTAMP_NTZ '2018-06-15 12:00:00' AS calendar_date, 1.5D AS snop_daily_forecast"
    ).write.parquet(f"{tmp_path}/f")
    spark.read.parquet(f"{tmp_path}/f").createOrReplaceTempView("wh_forecast")
    tables = NamedTables(spark, {"daily_forecast": "wh_forecast"})
    for mode in (timewin.FAITHFUL, timewin.CALENDAR):
        df = demand.forecast_next_days(tables.daily_forecast, dt.datetime(2018, 6, 15, 10), mode=mode)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(calendar_date", text)


def test_tune_keeps_what_the_session_sets(spark):
    key = next(iter(ADAPTIVE))
    spark.conf.set(key, "false")
    try:
        assert tune(spark).conf.get(key) == "false"
    finally:
        spark.conf.set(key, "true")
