from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stocklens.session import local_session  # noqa: E402
from stocklens.sources.schemas import schema  # noqa: E402


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = local_session(os.environ.get("TEST_CPUS", "8"), memory="8g", name="tests")
    yield session
    session.stop()


def _value(value, kind: T.DataType):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(value) if isinstance(value, str) else value
    if isinstance(kind, T.TimestampNTZType):
        if isinstance(value, str):
            return dt.datetime.fromisoformat(value)
        return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())
    if isinstance(kind, T.DoubleType):
        return float(value)
    return value


@pytest.fixture
def make(spark):
    """Build a relation from dicts; columns left out are null."""

    def build(relation: str, *rows: dict, **common) -> DataFrame:
        fields = schema(relation)
        unknown = {k for row in rows for k in {**common, **row}} - set(fields.names)
        assert not unknown, unknown
        return spark.createDataFrame(
            [
                tuple(_value({**common, **row}.get(f.name), f.dataType) for f in fields)
                for row in rows
            ],
            fields,
        )

    return build


@pytest.fixture
def table(spark):
    """Build a DataFrame from a column list as DDL and tuples."""

    def build(ddl: str, *tuples: tuple) -> DataFrame:
        fields = T.StructType.fromDDL(ddl)
        return spark.createDataFrame(
            [tuple(_value(v, f.dataType) for v, f in zip(row, fields)) for row in tuples], fields
        )

    return build


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, whole decimals as plain numbers."""

    def plain(value):
        if isinstance(value, Decimal):
            return int(value) if value == value.to_integral_value() else float(value)
        return value

    def collect(df: DataFrame, *columns: str) -> list[tuple]:
        picked = df.select(*columns) if columns else df
        return sorted((tuple(plain(v) for v in r) for r in picked.collect()), key=repr)

    return collect
