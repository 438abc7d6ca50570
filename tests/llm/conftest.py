from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark: SparkSession):
    """Documents from (doc_id, text) pairs, with columns whose names the operators use inside."""

    def build(*rows: tuple, extra: bool = True) -> DataFrame:
        made = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(made, DOCS)
        if extra:
            for name in ("data", "fp", "bucket", "words", "score", "id", "kept", "tokens", "grade", "fragment"):
                df = df.withColumn(name, F.lit(name))
        return df

    return build


@pytest.fixture
def prose():
    """Texts of words drawn at random, the same for each seed."""

    def text(seed: int, n: int = 60, words: int = 400) -> str:
        rng = random.Random(seed)
        return " ".join("w" + "abcdefghij"[k % 10] * (k % 3) + str(k) for k in (rng.randrange(words) for _ in range(n)))

    return text
