"""Helpers the operators share: inputs, lineage cuts, text as bytes, label folds."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Rows and bytes of a batch between Spark and a Python worker. Both hold a batch whole, and Spark
#: doubles its buffers as they fill; the defaults are 10,000 rows and 64 MB.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per context, wherever they run.

    Batches sent to them are kept small where the session does not say otherwise.
    """
    given = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in given:
            spark.conf.set(key, value)
    context = spark.sparkContext
    if getattr(context, "stocklens_sent", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/stocklens", "zip", root, "stocklens")
    context.addPyFile(archive)
    context.stocklens_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where they are all on this machine."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    context = spark.sparkContext
    if not hasattr(context, "stocklens_folder"):
        context.stocklens_folder = tempfile.mkdtemp(prefix="stocklens-")
        atexit.register(shutil.rmtree, context.stocklens_folder, ignore_errors=True)
    return "file://" + context.stocklens_folder


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage: whatever is lost later is read again from there, and
    what was drawn or computed once is not computed differently a second time.
    The folder stays until ``dropped``, or until whoever owns the shared folder
    clears it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stocklens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    found = spark.read.schema(df.schema).parquet(path)
    found.stocklens_path = path
    return found


def stored_by(df: DataFrame, name: str, key: str, buckets: int, compression: str = "snappy") -> DataFrame:
    """As ``stored``, in buckets by ``key``: grouping and joining by it need no shuffle of these rows.

    Only a table of the catalog can have buckets; it is taken out again at once, and its files stay.
    """
    spark = df.sparkSession
    label = f"stocklens_{name}_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    writer = df.write.format("parquet").option("path", f"{shared_folder(spark)}/{label}")
    writer.option("compression", compression).bucketBy(max(1, min(buckets, most)), key).saveAsTable(label)
    found = spark.table(label)
    spark.sql(f"DROP TABLE {label}")
    return found


def dropped(found: DataFrame) -> None:
    """Deletes what ``stored`` wrote; for what nothing reads any more, such as an earlier round."""
    spark = found.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(found.stocklens_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def set_apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with only doc_id and text under their names, and what gives all names back.

    Nothing an operator adds can clash with other columns then, whatever they are called.
    """
    names = [c if c in ("doc_id", "text") else f"other{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*names).toDF(*docs.columns)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def texts_of(docs: DataFrame, *others: str) -> DataFrame:
    """The id and the whole text as UTF-8 bytes (null: empty), with ``others``.

    Whatever else the documents carry, under whatever name, is left out.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"),
        *others,
    )


def rows_of(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of few rows, so that few texts are held at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
