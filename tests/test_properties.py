"""Reshaped plans against direct ones, on random rows with hot keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stocklens.constants import TURNOVER_CUTS
from stocklens.functions import forecast_checks
from stocklens.operators import archive, assortment, demand, monitor, purchasing

AS_OF = dt.datetime(2018, 6, 15, 10)
SEEDS = [1, 2, 3]
FEW = settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def hot(rng, n):
    """Index below ``n``; the first takes a third of all draws."""
    return 0 if rng.random() < 1 / 3 else rng.randrange(n)


# ---------------------------------------------------------------- clusters
def plain_clusters(base):
    """Running total in one unpartitioned window."""
    skus = base.distinct()
    down = Window.orderBy(F.desc("sold_qty_ytd"))
    running = F.sum("sold_qty_ytd").over(down).cast("double")
    total = F.sum("sold_qty_ytd").over(Window.partitionBy()).cast("double")
    share = F.try_divide(running, total)
    letter = F.lit("D")
    for cut, name in reversed(list(zip(TURNOVER_CUTS, "ABC"))):
        letter = F.when(share <= cut, name).otherwise(letter)
    return skus.select("product_id", "product_status", share, letter)


@FEW
@given(
    quantities=st.lists(
        st.one_of(
            st.sampled_from([0, 0, 1, 2**20 - 1, 2**20, 2**20 + 1]),
            st.integers(0, 50),
            st.integers(0, 2**44),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_bucketed_total_equals_plain_window(table, rows, quantities):
    base = table(
        "product_id string, product_status string, sold_qty_ytd bigint",
        *[(f"p{i % 50}", "Basis", q) for i, q in enumerate(quantities)],
    )
    result = assortment.abc_clustering(base).cache()
    columns = ("product_id", "product_status", "cumulative_percentage_ytd", "turnover_rate_cluster")
    assert rows(result, *columns) == rows(plain_clusters(base))

    ordered = sorted(
        rows(
            result, "sold_qty_ytd", "cumulative_sales_ytd", "total_sales_ytd",
            "turnover_rate_cluster",
        ),
        key=lambda r: -r[0],
    )
    totals = [r[1] for r in ordered]
    assert totals == sorted(totals)
    assert totals[-1] == ordered[0][2]
    letters = defaultdict(set)
    for quantity, _, _, letter in ordered:
        letters[quantity].add(letter)
    assert all(len(found) == 1 for found in letters.values())
    result.unpersist()


# -------------------------------------------------------------- purchasing
@pytest.mark.parametrize("seed", SEEDS)
def test_inbound_equals_all_pairs(make, rows, seed):
    rng = random.Random(seed)
    types = ["STD", "PRE", "AKT-1", "GWP", None]
    ledger = [
        (f"i{hot(rng, 9)}", Decimal(rng.randrange(-200, 900)) / 100, f"D{hot(rng, 30)}")
        for _ in range(400)
    ]
    lines = [(f"D{hot(rng, 40)}", rng.choice(types)) for _ in range(400)]
    expected = defaultdict(Decimal)
    for item, amount, document in ledger:
        for receipt, kind in lines:
            if document == receipt and amount > 0 and kind in ("STD", "PRE"):
                expected[item] += amount
    result = purchasing.inbound_open_internal(
        make(
            "item_ledger",
            *[{"item_no": i, "remaining_quantity": a, "document_no": d} for i, a, d in ledger],
            location_code="MARK_WE",
            delete_flag="false",
            entry_type="0",
        ),
        make(
            "fact_purchase",
            *[{"purchase_receipt_id": r, "order_type": k} for r, k in lines],
        ),
    )
    assert dict(tuple(r) for r in result.collect()) == dict(expected)


def random_purchases(make, seed):
    rng = random.Random(seed)
    dim = [(k, f"p{k % 7}") for k in range(10)]
    lines = [
        {
            "purchase_id": f"E{hot(rng, 12)}",
            "product_skey": hot(rng, 12),
            "order_type": rng.choice(["STD", "AKT", "GWP", None]),
            "purchase_status": rng.choice(["1", "5", "6", None]),
            "outstanding_quantity": rng.randrange(-1, 4),
            "purchase_order_date": dt.datetime(2018, 1, 1 + rng.randrange(3)),
            "expected_receipt_date": dt.datetime(2018, 2, 1 + rng.randrange(3)),
        }
        for _ in range(300)
    ]
    return (
        dim,
        lines,
        make("dim_product", *[{"product_skey": k, "product_id": p} for k, p in dim]),
        make("fact_purchase", *lines),
    )


@pytest.mark.parametrize("seed", SEEDS)
def test_oldest_purchases_equal_a_row_by_row_search(make, rows, seed):
    dim, lines, dim_df, lines_df = random_purchases(make, seed)
    name = dict(dim)
    open_lines = [r for r in lines if r["outstanding_quantity"] > 0]
    smallest = {}
    for r in open_lines:
        if r["order_type"] in ("STD", "GWP") and r["purchase_status"] == "1":
            sku = name.get(r["product_skey"])
            smallest[sku] = min(smallest.get(sku, r["purchase_id"]), r["purchase_id"])
    oldest = purchasing.oldest_po_min(lines_df, dim_df)
    assert dict(rows(oldest)) == smallest

    groups = Counter()
    for r in open_lines:
        sku = name.get(r["product_skey"])
        if sku and r["order_type"] in ("STD", "AKT") and smallest.get(sku) == r["purchase_id"]:
            key = (
                sku,
                r["purchase_id"],
                r["order_type"],
                r["purchase_status"],
                r["purchase_order_date"].date(),
            )
            groups[key] += r["outstanding_quantity"]
    result = purchasing.oldest_po_result(lines_df, dim_df, oldest)
    columns = ("product_id", "ebe", "order_type", "delivery_status", "order_date_oldest_po")
    assert {r[:5]: r[5] for r in rows(result, *columns, "open_qty_oldest_po")} == dict(groups)


@pytest.mark.parametrize("seed", SEEDS)
def test_both_oldest_equal_the_two_lists(make, rows, seed):
    _, _, dim, lines = random_purchases(make, seed)
    external = purchasing.oldest_po_result(lines, dim, purchasing.oldest_po_min(lines, dim))
    internal = purchasing.oldest_po_result_internal(
        lines,
        dim,
        purchasing.oldest_po_min_internal(lines, dim),
        make("dim_division"),
        make("supplier_leadtime").select("division_id", "booking_lt_avg"),
    )
    columns = ("product_id", "x", "order_date_oldest_po", "n")
    expected = (
        external.withColumnRenamed("ebe", "x")
        .select("product_id", "x", "order_date_oldest_po")
        .distinct()
        .join(
            internal.withColumnRenamed("ebe", "n").select("product_id", "n").distinct(),
            "product_id",
            "full",
        )
    )
    result = purchasing.oldest_po_both(lines, dim).select(
        "product_id", "oldest_ebe_external", "order_date_oldest_po", "oldest_ebe_internal"
    )
    assert rows(result) == rows(expected, *columns)


# -------------------------------------------------------------- assortment
@pytest.mark.parametrize("seed", SEEDS)
def test_assortment_equals_the_fan_out_form(make, table, rows, seed):
    rng = random.Random(seed)
    maybe = [None, -5, -1, 0, 1, 5]
    dim = make(
        "dim_product",
        *[
            {
                "product_id": f"p{i}",
                "quantity_instock": rng.choice(maybe),
                "shop_visibility": rng.choice(["Einzeln nicht sichtbar", "x", None]),
            }
            for i in range(60)
        ],
        product_status="Limitiert",
        release_date="2018-01-01",
        shop_activity_status="activated",
        shop_activity_status_config="activated",
        shop_visibility_config="Katalog, Suche",
    )
    on_order = table(
        "product_id string, outstanding_quantity_external decimal(28,4)",
        *[(f"p{hot(rng, 50)}", rng.choice(maybe)) for _ in range(120)],
    )
    internal = table(
        "item_no string, outstanding_quantity_internal decimal(18,2)",
        *[(f"p{i}", rng.choice(maybe)) for i in range(0, 60, 3)],
    )
    units = table(
        "product_id string, sold_qty_ytd bigint", *[(f"p{i}", i) for i in range(0, 60, 2)]
    )
    fan_out = (
        dim.join(on_order, "product_id", "left")
        .join(internal, dim.product_id == internal.item_no, "left")
        .join(units, "product_id", "left")
        .where(
            "shop_visibility = 'Einzeln nicht sichtbar' OR coalesce(quantity_instock, 0)"
            " + coalesce(outstanding_quantity_external, 0)"
            " + coalesce(outstanding_quantity_internal, 0) > 0"
        )
        .selectExpr("product_id", "product_status", "coalesce(sold_qty_ytd, 0)")
    )
    inputs = (dim, on_order, internal, units, AS_OF)
    assert rows(assortment.assortment_base(*inputs)) == rows(fan_out)
    assert rows(assortment.assortment_members(*inputs)) == rows(fan_out.distinct())


# ----------------------------------------------------------------- archive
@pytest.mark.parametrize("seed", SEEDS)
def test_one_more_zero_line_counts_one_more(make, rows, seed):
    rng = random.Random(seed)
    lines = make(
        "purchase_line_archive",
        *[
            {
                "no_": f"p{hot(rng, 5)}",
                "document_no": f"D{hot(rng, 6)}",
                "version_no": rng.randrange(3),
                "quantity": rng.randrange(-1, 4),
                "delete_flag": rng.random() < 0.3,
            }
            for _ in range(80)
        ],
    )
    headers = make(
        "purchase_header_archive",
        *[
            {"no": f"D{i}", "order_date": dt.datetime(2018, 4, 1 + 8 * i % 28), "delete_flag": i == 2}
            for i in (0, 0, 1, 2, 3, 4)
        ],
        {"no": "new", "order_date": "2018-06-01", "delete_flag": False},
    )
    dim = make("dim_product", *[{"product_id": f"p{i}"} for i in range(7)])

    def counts(line_archive):
        latest = archive.latest_line_version(line_archive, headers, AS_OF)
        zero = archive.zero_qty_lines(line_archive, headers, AS_OF)
        # the lines at the latest version, looked up in a second pass
        again = line_archive.where("quantity <= 0").join(
            latest.withColumnsRenamed({"sku": "no_", "ebe": "document_no", "aktuelle_version": "version_no"}),
            ["no_", "document_no", "version_no"],
        )
        assert rows(zero) == rows(again.select("no_", "document_no", "quantity"))
        return dict(rows(archive.zero_order_count(dim, zero)))

    before = counts(lines)
    extra = {"document_no": "new", "version_no": 9, "quantity": 0, "delete_flag": False}
    after = counts(lines.unionAll(make("purchase_line_archive", {"no_": "p0", **extra})))
    assert after == {**before, "p0": before["p0"] + 1}


# ------------------------------------------------------- demand and monitor
@pytest.mark.parametrize("seed", SEEDS)
def test_longer_horizons_hold_shorter_ones(make, seed):
    rng = random.Random(seed)
    forecast = make(
        "daily_forecast_by_business_id",
        *[
            {
                "productbusinessid": f"p{hot(rng, 20)}",
                "calendar_date": AS_OF.date() + dt.timedelta(days=rng.randrange(-10, 70)),
                "daily_married_forecast": Decimal(rng.randrange(0, 1000)) / 100,
            }
            for _ in range(500)
        ],
    )
    product = make("product", *[{"productbusinessid": f"p{i}", "unitcost": 1} for i in range(20)])
    result = demand.forecast_horizons(forecast, product, AS_OF).collect()
    assert len(result) == 20
    assert all(0 <= r[1] <= r[2] <= r[3] <= r[4] for r in result)


@pytest.mark.parametrize("seed", SEEDS)
def test_deviation_is_never_negative(table, seed):
    rng = random.Random(seed)
    pick = [None, -3, 0, 0.004, 0.1, 5, 7.25]
    pairs = table(
        "n decimal(18,4), f decimal(18,4)", *[(rng.choice(pick), rng.choice(pick)) for _ in range(80)]
    )
    n, f = F.col("n"), F.col("f")
    mad, mape, above = (
        forecast_checks.forecast_mad(n, f),
        forecast_checks.forecast_mape(n, f),
        forecast_checks.mape_above(n, f),
    )
    for r in pairs.select(mad.alias("mad"), mape.alias("mape"), above.alias("above")).collect():
        assert r["mad"] is None or r["mad"] >= 0
        assert r["above"] == (None if r["mape"] is None else r["mape"] > 0.1)


@pytest.mark.parametrize("mode", [monitor.ISO_YEAR, monitor.CALENDAR])
@pytest.mark.parametrize("seed", SEEDS)
def test_one_pass_over_unique_weeks_equals_the_lookups(make, rows, mode, seed):
    """With gaps, the 53rd week of 2020, and turns of the year."""
    rng = random.Random(seed)
    first = dt.date(2019, 11, 25)
    weeks = {(f"p{hot(rng, 3)}", first + dt.timedelta(days=7 * rng.randrange(70))) for _ in range(120)}
    history = make(
        "weekly_history",
        *[
            {
                "product_id": p, "week_start_date": d, "net_qty": rng.randrange(9), "bulk_order_qty": i,
                "outlier_correction_qty": None if i % 7 == 0 else i, "oos_correction_qty": -i,
            }
            for i, (p, d) in enumerate(sorted(weeks))
        ],
    )
    for lookup in (monitor.prior_week_bulk, monitor.prior_week_outlier, monitor.prior_week_oos):
        assert rows(lookup(history, mode, True)) == rows(lookup(history, mode, False))
    base = history.selectExpr(
        "product_id", "week_start_date", "week_start_date AS as_of_date", "net_qty AS forecast_quantity",
        "net_qty AS sku_uplift", "net_qty AS forecast_quantity_after_uplifts_before_adjustment",
        "net_qty AS top_down_adjustment", "net_qty + bulk_order_qty AS married_forecast_quantity",
    )
    one = monitor.forecast_monitor(history, base, mode=mode, one_row_per_week=True)
    assert rows(one) == rows(monitor.forecast_monitor(history, base, mode=mode))


@pytest.mark.parametrize("mode", [monitor.WEEK_NUMBER, monitor.ISO_YEAR, monitor.CALENDAR])
def test_prior_weeks_equal_a_search(make, rows, mode):
    rng = random.Random(7)
    weeks = [
        (f"p{hot(rng, 3)}", dt.date.fromisocalendar(2018 + rng.randrange(3), 1 + rng.randrange(52), 1))
        for _ in range(60)
    ]
    history = make(
        "weekly_history",
        *[
            {"product_id": p, "week_start_date": d, "outlier_correction_qty": i}
            for i, (p, d) in enumerate(weeks)
        ],
    )

    def follows(day, before):
        (year, number, _), (prior_year, prior_number, _) = day.isocalendar(), before.isocalendar()
        if mode == monitor.CALENDAR:
            return day - before == dt.timedelta(days=7)
        return number == prior_number + 1 and (mode == monitor.WEEK_NUMBER or year == prior_year)

    expected = []
    for own, (product, day) in enumerate(weeks):
        found = [i for i, (p, d) in enumerate(weeks) if p == product and follows(day, d)]
        expected += [(product, day, own, i) for i in found or [None]]
    result = monitor.prior_week_outlier(history, mode)
    columns = ("sku", "week_start_date", "outlier_correction_qty", "outlier_correction_qty_last_kw")
    assert rows(result, *columns) == sorted(expected, key=repr)
