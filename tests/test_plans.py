"""What the physical plans must and must not contain."""

from __future__ import annotations

import datetime as dt
import itertools
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stocklens.operators import archive, assortment, demand
from stocklens.plans import catalog
from stocklens.plans.reports import Reports
from stocklens.sources.named import NamedTables
from stocklens.sources.schemas import RELATIONS
from stocklens.sources.startables import StarTables

PATH = "/root/testdata/sf0.001"
QUERIES = catalog.queries()

# Queries that contain the running total over quantity buckets.
WITH_RUNNING_TOTAL = {"abc_clustering", "ordering_master"}


def plan(df, mode="simple"):
    query = df._jdf.queryExecution()
    return df.sparkSession._jvm.PythonSQLUtils.explainString(query, mode)


@pytest.fixture
def without_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_scales(without_broadcast, name):
    text = plan(QUERIES[name](without_broadcast, PATH))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Broadcast"):
        assert banned not in text
    single = re.findall(r"Exchange SinglePartition.*\n(.*)", text)
    if name in WITH_RUNNING_TOTAL:
        # only the sums per bucket reach one task
        assert single and all(re.search(r"HashAggregate\(keys=\[bucket#", s) for s in single)
    else:
        assert not single


def scans(df):
    """Details of each table scan."""
    return re.findall(r"\(\d+\) Scan parquet.*?\n\n", plan(df, "formatted"), re.S)


def test_date_windows_reach_the_scan(spark):
    for name in ("units_ytd", "units_last_days"):
        [orders] = [s for s in scans(QUERIES[name](spark, PATH)) if "o_orderdate" in s]
        assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(o_orderdate", orders)
        assert re.search(r"PushedFilters: .*LessThanOrEqual\(o_orderdate", orders)


def test_scans_read_only_what_is_used(spark):
    [lines] = scans(QUERIES["forecast_next_days"](spark, PATH))
    assert (
        "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_discount:double,"
        "l_shipdate:timestamp_ntz>" in lines
    )
    for lines in scans(QUERIES["order_type_base"](spark, PATH)):
        assert "l_quantity" not in lines and "o_totalprice" not in lines


def test_assortment_is_built_once_for_the_clusters(without_broadcast):
    df = QUERIES["abc_clustering"](without_broadcast, PATH)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


HOT = {
    # query -> rows of hot-key joins are split in at least this many joins
    "purchase_open_qty": 1,
    "inbound_open_internal": 1,
    "assortment_base": 2,
    "abc_clustering": 2,
    "sold_units_per_sku": 1,
}


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """Test tables where one order, part and supplier each hold a third of the lines."""
    target = tmp_path_factory.mktemp("hot")
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "events"):
        spark.read.parquet(f"{PATH}/{table}.parquet").write.parquet(f"{target}/{table}.parquet")
    lines = spark.read.parquet(f"{PATH}/lineitem.parquet")
    # a few files, since a hot partition is split along the tasks that wrote it
    lines = lines.unionAll(lines).unionAll(lines).repartition(12)
    keyed = lines.withColumns(
        {
            "l_orderkey": _third("l_orderkey", 186, 1),
            "l_partkey": _third("l_partkey", 8, 2),
            "l_suppkey": _third("l_suppkey", 3, 3),
        }
    )
    keyed.write.parquet(f"{target}/lineitem.parquet")
    return str(target)


def _third(column, hot, seed):
    return F.when(F.rand(seed) < 1 / 3, F.lit(hot).cast("bigint")).otherwise(F.col(column))


@pytest.fixture
def eager_split(without_broadcast):
    spark = without_broadcast
    values = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_purchase_groups_are_dealt_into_parts(without_broadcast):
    text = plan(QUERIES["assortment_base"](without_broadcast, PATH))
    [join] = re.findall(r"SortMergeJoin \[product_id#\d+, part#.*?\n(.*?)\n(.*?)\n", text)
    assert "Sort" in join[0] and "Exchange hashpartitioning(product_id#" in join[1]


def test_only_large_products_are_repeated(spark):
    tables = Reports(StarTables(spark, PATH), catalog.TEST_DATES)
    whole = sorted(map(tuple, tables.assortment_base().collect()))
    inputs = tables._assortment_inputs()
    for size in (1, 7):
        dealt = assortment.assortment_base(*inputs, groups_in_part=size)
        assert sorted(map(tuple, dealt.collect())) == whole


def executed_scans(df, name):
    """How often the final plan reads a table; what it reuses is not read again."""
    key = "spark.sql.maxMetadataStringLength"
    before = df.sparkSession.conf.get(key)
    df.sparkSession.conf.set(key, "1000")
    try:
        df.collect()
        final = plan(df).split("== Initial Plan ==")[0]
    finally:
        df.sparkSession.conf.set(key, before)
    return len(re.findall(rf"FileScan parquet .*/{name}\.parquet\]", final))


def below(text, node):
    """What stands under each such node of a plan."""
    found, lines = [], text.splitlines()
    for i, line in enumerate(lines):
        if node in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            rest = itertools.takewhile(lambda x: len(x) - len(x.lstrip(" :+-")) > depth, lines[i + 1 :])
            found.append("\n".join(rest))
    return found


def test_archive_is_read_once_and_recent_documents_come_first(without_broadcast):
    assert executed_scans(QUERIES["zero_qty_lines"](without_broadcast, PATH), "lineitem") == 1
    for name in ("latest_line_version", "zero_qty_lines"):
        found = below(plan(QUERIES[name](without_broadcast, PATH)), "LeftSemi")
        assert found and not any("Aggregate" in x or "Window" in x for x in found)


def test_latest_version_of_a_hot_document_is_split(eager_split):
    spark = eager_split
    # one item in one document holds most lines, at many versions and at one of them
    lines = spark.range(0, 60_000, 1, 12).selectExpr(
        "IF(id % 3 = 0, concat('i', id % 500), 'hot') AS no_", "IF(id % 3 = 0, concat('d', id % 90), 'D') AS document_no",
        "CAST(IF(id % 3 = 1, 7, id % 900) AS int) AS version_no", "CAST(id % 4000 - 3999 AS decimal(28,10)) AS quantity",
        "id % 900 > 800 AS delete_flag",
    )
    headers = spark.sql(
        "SELECT explode(transform(sequence(0, 90), i -> IF(i = 90, 'D', concat('d', i)))) AS no,"
        " TIMESTAMP_NTZ '2018-06-01 00:00:00' AS order_date, false AS delete_flag"
    )
    lines = lines.unionAll(spark.sql("SELECT 'hot', 'D', 7000, CAST(0 AS decimal(28,10)), true"))
    hot = lines.unionAll(lines.where("no_ = 'hot' AND version_no = 7").withColumn("version_no", F.lit(5000)))
    df = archive.zero_qty_lines(hot, headers, dt.datetime(2018, 6, 15, 10))
    got = sorted(map(tuple, df.collect()))
    final = plan(df).split("== Initial Plan ==")[0]
    assert "Window" not in final and "skew=true" in final
    by = Window.partitionBy("no_", "document_no")
    latest = F.max(F.when(~F.col("delete_flag"), F.col("version_no"))).over(by)
    direct = hot.withColumn("latest", latest).where("version_no = latest AND quantity <= 0")
    assert got == sorted(map(tuple, direct.select("no_", "document_no", "quantity").collect()))
    assert sum(r[0] == "hot" for r in got) > 10_000


def test_purchase_groups_are_counted_once(without_broadcast):
    df = QUERIES["assortment_base"](without_broadcast, PATH)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"HashAggregate\(keys=\[product_id#\d+\], functions=\[partial_max", final)) == 1
    assert not re.search(r"keys=\[product_id#\d+\], functions=\[partial_count", final)


@pytest.fixture
def named_purchases(spark, tmp_path):
    star = StarTables(spark, PATH)
    for relation in RELATIONS:
        getattr(star, relation).write.parquet(f"{tmp_path}/{relation}.parquet")
        spark.read.parquet(f"{tmp_path}/{relation}.parquet").createOrReplaceTempView(f"f_{relation}")
    yield NamedTables(spark, {relation: f"f_{relation}" for relation in RELATIONS})
    for relation in RELATIONS:
        spark.catalog.dropTempView(f"f_{relation}")


def test_ordering_list_reads_purchases_twice(without_broadcast, named_purchases):
    df = Reports(named_purchases, catalog.TEST_DATES).ordering_master()
    # once for groups, oldest purchases and their details, once for order types
    assert executed_scans(df, "fact_purchase") == 2


def test_history_is_read_once_for_the_week_before(without_broadcast):
    for name in ("prior_week_bulk", "prior_week_oos_calendar"):
        assert executed_scans(QUERIES[name](without_broadcast, PATH), "lineitem") == 1


def test_ordering_list_gathers_no_arrays(without_broadcast):
    df = QUERIES["ordering_master"](without_broadcast, PATH)
    df.collect()
    assert "ObjectHashAggregate" not in plan(df)
    assert "collect_" not in plan(df)


def test_equal_units_spread_over_tasks(spark):
    report = spark.range(20_000).selectExpr(
        "CAST(id AS string) AS productbusinessid", "'n' AS productname", "TIMESTAMP_NTZ '2018-06-01' AS snapshot_day",
        "1.0D AS ordered_qty", "2.0D AS invoiced_sales_ad", "1.0D AS invoiced_db3_ad",
    )
    df = demand.sold_units_per_sku(report)
    keys = ("spark.sql.adaptive.enabled",)
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "false")
    try:
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(sizes) < 10_000


@pytest.mark.parametrize("name", list(HOT))
def test_hot_keys_are_split(eager_split, hot_tables, name):
    df = QUERIES[name](eager_split, hot_tables)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("skew=true") >= HOT[name]
