"""Sinks. Every write replaces what was there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.sources.readers import CSV, FILE_ORDER


def save_catalog_table(
    df: DataFrame, table: str, bucket_by: str | None = None, buckets: int = 0
) -> None:
    """Replace a catalog table.

    Orders and items bucketed alike on ``order_id`` join without a shuffle. One bucket is read by one
    task, so do not bucket on a key that a single value dominates.
    """
    writer = df.drop(FILE_ORDER).write.mode("overwrite").format("parquet")
    if bucket_by is not None and buckets > 0:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)


def save_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line and doubled quotes. Blanks around a value are part of it and stay."""
    writer = df.write.mode("overwrite").options(**CSV)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_report(lines: DataFrame, path: str) -> None:
    """Report lines (``line_no``, ``line``) as one text file. A report has tens of lines."""
    one_file = lines.coalesce(1).sortWithinPartitions("line_no")
    one_file.select(F.col("line").alias("value")).write.mode("overwrite").text(path)
