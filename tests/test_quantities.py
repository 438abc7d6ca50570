"""Sums of decimals of any length, against Python's."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal, localcontext

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stocklens.functions.quantities import Amount, is_positive
from stocklens.operators import assortment, demand, purchasing
from stocklens.sources.schemas import conform

AS_OF = dt.datetime(2018, 6, 15, 10)
KINDS = [(5, 0), (12, 2), (28, 10), (20, 12), (28, 2), (28, 25), (38, 0), (38, 2), (38, 18), (38, 25), (31, 10)]


def drawn(rng, precision, scale):
    digits = rng.choice([1, precision // 2, precision - 3])
    number = rng.randrange(10 ** max(1, digits)) * rng.choice([1, -1])
    return Decimal(number).scaleb(-scale)


def plain(values):
    with localcontext() as context:
        context.prec = 200
        return sum(values, Decimal(0))


def frame(spark, values, precision, scale):
    rows = [(i % 3, None if v is None else str(v)) for i, v in enumerate(values)]
    text = spark.createDataFrame(rows, "k int, v string")
    return text.select("k", F.col("v").cast(f"decimal({precision},{scale})").alias("v"))


@pytest.mark.parametrize("kind", KINDS)
def test_sums_equal_those_of_python(spark, kind):
    precision, scale = kind
    rng = random.Random(precision * 100 + scale)
    with localcontext() as context:
        context.prec = 200
        values = [drawn(rng, *kind) for _ in range(60)] + [None]
        df = frame(spark, values, *kind)
        amount = Amount.of(df, "v")
        known = defaultdict(list)
        for i, v in enumerate(values):
            if v is not None:
                known[i % 3].append(v)
        got = {r.k: r.t for r in df.groupBy("k").agg(amount.total().alias("t")).collect()}
        assert got == {k: plain(v) for k, v in known.items()}
        parts = df.groupBy("k").agg(amount.summed().alias("s"))
        assert parts.agg(amount.value(amount.again("s")).alias("t")).first().t == plain(v for v in values if v is not None)
        if kind != (28, 10):  # quantities keep 16 digits before the point in products
            small = parts.select("k", amount.value(F.col("s"), F.lit(7)).alias("t"))
            assert {r.k: r.t for r in small.collect()} == {k: 7 * plain(v) for k, v in known.items()}
            each = df.agg(amount.total_times(F.col("k") + 1).alias("t")).first().t
            assert each == plain((i % 3 + 1) * v for i, v in enumerate(values) if v is not None)
        only = df.agg(amount.total(F.col("k") == 1).alias("t")).first().t
        assert only == plain(known[1])


def test_totals_that_run_over_on_the_way(spark):
    big = Decimal("99999999999999999999.999999999999999999")
    minus = big.copy_negate()
    values = [big, big, big, minus, minus, Decimal("0.000000000000000001"), minus]
    df = frame(spark, values, 38, 18)
    amount = Amount.of(df, "v")
    assert df.agg(amount.total().alias("t")).first().t == Decimal("0.000000000000000001")
    for signed, more, less in ((big, "-1", "0.25"), (big.copy_negate(), "1", "-0.25")):
        values = [signed, Decimal(more), Decimal(less)]
        mixed = frame(spark, values, 38, 18)
        assert mixed.agg(amount.total().alias("t")).first().t == plain(values)
    with pytest.raises(PySparkException):  # no decimal has that many digits
        frame(spark, [big, big], 38, 18).agg(amount.total().alias("t")).collect()
    none = frame(spark, [None, None], 38, 18)
    assert none.agg(amount.total().alias("t")).first().t is None


def test_too_many_decimals_are_refused(spark):
    with pytest.raises(ValueError, match="26 decimals"):
        Amount.of(frame(spark, [], 38, 26), "v")


def test_sign_of_a_sum(spark):
    rows = [("0.000000000000000001", "-1", "1"), ("0", "-1", "1"), ("-0.5", "0.25", "0.25"), ("-0.5", "0.25", "0.26"), (None, "1", "1")]
    df = spark.createDataFrame(rows, "a string, b string, c string").select(
        F.col("a").cast("decimal(38,18)"), F.col("b").cast("decimal(18,2)"), F.col("c").cast("decimal(38,10)")
    )
    got = [r[0] for r in df.select(is_positive([F.col(c) for c in "abc"])).collect()]
    assert got == [True, False, False, True, None]


def test_small_amounts_add_up(spark):
    daily = spark.range(100_000).selectExpr(
        "'p' AS product_id", "TIMESTAMP_NTZ '2018-06-15 12:00:00' AS calendar_date",
        "CAST('0.00000000004' AS decimal(20,12)) AS snop_daily_forecast",
    )
    [row] = demand.forecast_next_days(conform(daily, "daily_forecast"), AS_OF).collect()
    assert row.fcst_7days == Decimal("0.000004")


@pytest.mark.parametrize("kind", ["decimal(28,10)", "decimal(38,18)"])
def test_reports_of_long_decimals(spark, make, rows, kind):
    """Every total of a column with this type, over amounts that cancel and leave little."""

    def wide(df, column, *amounts):
        base = df.drop(column).crossJoin(spark.createDataFrame([(a,) for a in amounts], "a string"))
        return base.withColumn(column, F.col("a").cast(kind)).drop("a")

    little = "0.0000000004" if kind == "decimal(28,10)" else "0.000000000000000004"
    amounts = ("900000000000000.5", "-900000000000000.5", little)
    exact = Decimal(little)
    dim = make("dim_product", {"product_skey": 1, "product_id": "p"})
    sales = wide(make("fact_sales", {"product_skey": 1, "order_date": "2018-06-14"}), "quantity", *amounts, "2.5")
    assert rows(demand.units_ytd(sales, dim, AS_OF, dt.date(2018, 1, 1))) == [("p", 3)]
    assert rows(demand.units_last_days(sales, dim, AS_OF)) == [("p", 3)]
    lines = wide(
        make("fact_purchase", {"product_skey": 1, "purchase_id": "E", "purchase_receipt_id": "D", "order_type": "S", "purchase_status": "1"}),
        "outstanding_quantity", *amounts,
    )
    [row] = purchasing.purchase_open_qty(lines, dim).collect()
    assert row.outstanding_quantity_external == exact
    oldest = purchasing.oldest_po_min(lines, dim)
    [row] = purchasing.oldest_po_result(lines, dim, oldest).collect()
    assert row.open_qty_oldest_po == plain([Decimal("900000000000000.5"), exact])
    groups = purchasing.purchase_groups(lines, dim)
    [row] = purchasing.largest_purchase_group(groups, lines).collect()
    assert row.best_external == exact
    ledger = make(
        "item_ledger",
        {"item_no": "p", "document_no": "D", "location_code": "MARK_WE", "delete_flag": "false", "entry_type": "0"},
    )
    received = purchasing.inbound_open_internal(wide(ledger, "remaining_quantity", "0.0015", "0.0015"), lines)
    assert received.first().outstanding_quantity_internal == Decimal("0.01")  # 3 lines x 0.003, rounded once
    visits = wide(make("visits_per_sku", {"product_id": "p", "visit_date": "2018-06-14"}), "oos_visits", *amounts)
    assert demand.oos_visits(visits, AS_OF).first().oos_visits == exact
    report = make(
        "management_report_daily",
        {"productname": "n", "productbusinessid": "p", "snapshot_day": "2018-06-14", "invoiced_sales_ad": 2, "invoiced_db3_ad": 1},
    )
    [row] = demand.sold_units_per_sku(wide(report, "ordered_qty", *amounts)).collect()
    assert (row.sold_units, row.revenue, row.profit, row.db3_marge) == (exact, 6, 3, 0.5)
    daily = wide(
        make("daily_forecast_by_business_id", {"productbusinessid": "p", "calendar_date": "2018-06-16"}),
        "daily_married_forecast", *amounts, "1.25",
    )
    product = make("product", *[{"productbusinessid": "p", "unitcost": 2}] * 2)
    [row] = demand.forecast_horizons(daily, product, AS_OF).collect()
    assert row[1] == 3  # 2 x 1.25 and a little, rounded once


@pytest.mark.parametrize("kind", ["decimal(28,10)", "decimal(38,18)"])
def test_a_little_on_hand_is_enough(spark, make, table, rows, kind):
    dim = make(
        "dim_product",
        *[{"product_id": p, "product_status": "Basis", "release_date": "2018-01-01"} for p in "abc"],
    )
    little = "0.0000000001" if kind == "decimal(28,10)" else "0.000000000000000001"
    stock = F.when(F.col("product_id") == "a", little).when(F.col("product_id") == "b", "0").otherwise("-" + little)
    dim = dim.withColumn("quantity_instock", stock.cast(kind))
    on_order = table("product_id string, purchase_id string, outstanding_quantity_external decimal(38,10)", ("a", "E", "-1"), ("c", "E", "-1"))
    inbound = table("item_no string, outstanding_quantity_internal decimal(18,2)", ("a", "1"), ("c", "1"))
    units = table("product_id string, sold_qty_ytd bigint")
    assert rows(assortment.assortment_base(dim, on_order, inbound, units, AS_OF), "product_id") == [("a",)]
    assert rows(assortment.assortment_members(dim, on_order, inbound, units, AS_OF), "product_id") == [("a",)]
