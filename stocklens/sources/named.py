"""The input relations, read from tables of the session catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stocklens.sources.schemas import RELATIONS, conform


@dataclass(frozen=True)
class NamedTables:
    """Relations by table name, such as ``{"dim_product": "sales.dim_product"}``.

    Only relations a report reads need a name. Columns are selected by name
    and cast to the declared types. Of further columns only those asked for in
    ``extra``, such as ``{"management_report_daily": ["brand"]}``, are read.
    A timestamp with a zone is taken in the time zone of the session.
    """

    spark: SparkSession
    names: Mapping[str, str]
    extra: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def __getattr__(self, relation: str) -> DataFrame:
        if relation not in RELATIONS:
            raise AttributeError(relation)
        if relation not in self.names:
            raise KeyError(f"no table named for relation {relation!r}")
        df = self.spark.table(self.names[relation])
        return conform(df, relation, self.extra.get(relation, ()))
