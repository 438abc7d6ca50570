"""Every query against its SQL, value by value and type by type."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as spark_entry
from stocklens.plans import catalog, oracle
from stocklens.sources.schemas import RELATIONS, schema
from stocklens.sources.startables import StarTables

PATH = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()

# Rows at the smallest scale, counted independently when the inputs were laid out.
KNOWN_COUNTS = {
    "stockout_products": 19,
    "purchase_open_qty": 5996,
    "inbound_open_internal": 168,
    "vendor_division_current": 93,
    "units_ytd": 174,
    "assortment_base": 3484,
    "abc_clustering": 118,
    "oldest_po_min": 189,
    "oldest_po_result": 131,
    "oldest_po_min_internal": 184,
    "leadtime": 10,
    "latest_line_version": 96,
    "zero_qty_lines": 22,
    "zero_order_count": 200,
    "units_last_days": 23,
    "forecast_next_days": 11,
    "oos_visits": 3,
    "ordering_master": 12,
    "prior_week_bulk": 2898,
    "sold_units_per_sku": 197,
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{PATH}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert ORACLE.items() <= spark_entry.oracle_sql().items()


def test_entry_works_without_the_training_data_operators():
    code = """
import sys
sys.modules["stocklens.llm"] = None
import __spark_entry__ as entry
from stocklens.plans import catalog
assert set(entry.queries()) == set(catalog.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(spark_entry.__file__))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, PATH)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(map(repr, result.fetchall()))
    actual = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert actual == expected
    if PATH.endswith("sf0.001") and name in KNOWN_COUNTS:
        assert len(actual) == KNOWN_COUNTS[name]


@pytest.mark.parametrize("relation", RELATIONS)
def test_relation_has_its_schema(spark, relation):
    df = getattr(StarTables(spark, PATH), relation)
    declared = [(f.name, f.dataType) for f in schema(relation)]
    assert [(f.name, f.dataType) for f in df.schema] == declared


def test_flagship(spark):
    assert spark_entry.entry(spark).count() == 12
