"""Session settings the plans in this package are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins here leave hot keys to Spark's runtime skew split. Forcing it lets the
# split happen also where an aggregation on the join key follows.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings the caller has not set on the session."""
    given = spark.conf.getAll
    for key, value in ADAPTIVE.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, memory: str = "16g", name: str = "stocklens") -> SparkSession:
    """A local session for tests and measurements."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
