"""Appending batches to a table of files, each once however often it is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import path_exists

BATCH = "append_batch"


def append_batch(df: DataFrame, path: str, batch: int) -> None:
    """Add ``df`` as batch ``batch`` of the table below ``path``.

    A batch has a folder of its own named after it, so writing it again after a failure replaces what the first
    attempt left and touches no other batch.  Different batches may be written at the same time.
    """
    if batch < 0:
        raise ValueError(f"batch {batch}")
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the complete batches; a batch whose writing was broken off has none."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path).drop(BATCH)
