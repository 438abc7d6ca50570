"""Latest versions of archived purchase documents and their zero lines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.constants import ARCHIVE_DAYS
from stocklens.functions import timewin


def _recent_lines(
    line_archive: DataFrame, header_archive: DataFrame, as_of: dt.datetime, days: int
) -> DataFrame:
    """Archive lines of undeleted documents ordered in the ``days`` up to ``as_of``.

    Documents are looked up first, as they drop most of the archive. The semi
    join keeps several header versions from multiplying lines.
    """
    recent = header_archive.where(
        timewin.between(F.col("order_date"), as_of - timewin.days(days), as_of)
        & ~F.col("delete_flag")
    ).select(F.col("no").alias("document_no"))
    return line_archive.join(recent, "document_no", "left_semi")


def latest_line_version(
    line_archive: DataFrame,
    header_archive: DataFrame,
    as_of: dt.datetime,
    days: int = ARCHIVE_DAYS,
) -> DataFrame:
    """Highest undeleted version per document and item, for documents of the last ``days``."""
    lines = _recent_lines(
        line_archive.where(~F.col("delete_flag")), header_archive, as_of, days
    )
    return lines.groupBy(F.col("no_").alias("sku"), F.col("document_no").alias("ebe")).agg(
        F.max("version_no").alias("aktuelle_version")
    )


def zero_qty_lines(
    line_archive: DataFrame,
    header_archive: DataFrame,
    as_of: dt.datetime,
    days: int = ARCHIVE_DAYS,
) -> DataFrame:
    """Lines at the latest version with nothing ordered; equal lines all stay.

    Deleted lines take part here, although they do not decide the version.
    Equal lines are counted first, in every task before they meet. The latest
    version is the maximum of what is left and joined back on the version too,
    so the lines of one item in one document are never gathered in one place.
    Both uses need the whole count, so the archive is read once.
    """
    lines = _recent_lines(
        line_archive.where(F.col("no_").isNotNull() & F.col("version_no").isNotNull()),
        header_archive,
        as_of,
        days,
    )
    quantity = F.col("quantity")
    counted = lines.groupBy(
        F.col("no_").alias("sku"),
        F.col("document_no").alias("ebe"),
        "version_no",
        "delete_flag",
        F.when(quantity <= 0, quantity).alias("quantity"),
    ).agg(F.count(F.lit(1)).alias("n_lines"))
    counts = F.when((F.col("n_lines") > 0) & ~F.col("delete_flag"), F.col("version_no"))
    latest = counted.groupBy("sku", "ebe").agg(F.max(counts).alias("version_no"))
    empty = F.when(F.col("quantity").isNotNull(), F.sequence(F.lit(1), F.col("n_lines")))
    return counted.join(latest, ["sku", "ebe", "version_no"]).select(
        "sku", "ebe", "quantity", F.explode(empty).alias("copy")
    ).drop("copy")


def zero_order_count(dim_product: DataFrame, zero_lines: DataFrame) -> DataFrame:
    """Number of zero lines per product; products without any get 0."""
    counts = zero_lines.groupBy(F.col("sku").alias("product_id")).agg(
        F.count("ebe").alias("n_zero")
    )
    return (
        dim_product.select("product_id")
        .join(counts, "product_id", "left")
        .groupBy("product_id")
        .agg(F.sum(F.coalesce("n_zero", F.lit(0))).alias("zero_order_delivery"))
    )
