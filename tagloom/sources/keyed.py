"""Keyed tables as numbered Parquet versions, and long cell tables.

A version is never changed once written; readers of version ``n`` are not disturbed while
``n + 1`` is written, and a failed write leaves no visible version behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import path_exists


def latest_per_key(changes: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last change of every key.  Aggregated map-side, so a much-changed key stays cheap."""
    rest = [c for c in changes.columns if c != key]
    last = changes.groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return last.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Non-null cells of ``changes`` replace those of the same key; other keys and cells stay."""
    new = changes.select(*[F.col(c).alias(f"_new_{c}") for c in changes.columns])
    joined = current.join(new, F.col(key) == F.col(f"_new_{key}"), "full")
    out = [
        F.coalesce(f"_new_{c}", c).alias(c) if c in changes.columns else F.col(c)
        for c in current.columns
    ]
    return joined.select(*out)


def delete_keys(current: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return current.join(keys.select(key), key, "left_anti")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions below ``root``, ascending."""
    if not path_exists(spark, root):
        return []
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    found = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
    return sorted(v for v in found if path_exists(spark, f"{root}/v={v}/_SUCCESS"))


def write_version(df: DataFrame, root: str) -> int:
    """Write the next version and return its number.  One writer at a time."""
    spark = df.sparkSession
    known = versions(spark, root)
    number = known[-1] + 1 if known else 1
    df.write.mode("overwrite").parquet(f"{root}/v={number}")
    return number


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no complete version below {root}")
    return spark.read.parquet(f"{root}/v={known[-1] if number is None else number}")


def to_cells(df: DataFrame, key: str, columns: Sequence[str] | None = None, family: str | None = None) -> DataFrame:
    """Wide rows -> ``(row_key, [family,] qualifier, value)`` text cells; blank cells vanish."""
    columns = list(columns) if columns is not None else [c for c in df.columns if c != key]
    texts = df.select(
        F.col(key).cast("string").alias("row_key"),
        *[F.col(c).cast("string").alias(c.lower()) for c in columns],
    )
    cells = texts.unpivot("row_key", [c.lower() for c in columns], "qualifier", "value")
    cells = cells.where(F.trim("value") != "")
    if family is None:
        return cells
    return cells.select("row_key", F.lit(family).alias("family"), "qualifier", "value")


def sorted_by(df: DataFrame, keys: Sequence[str], ascending: bool = True) -> DataFrame:
    """Total order over the whole frame: ranges between partitions, sorted inside them."""
    order: list[Column] = [F.col(k).asc() if ascending else F.col(k).desc() for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_cells(cells: DataFrame, path: str) -> None:
    """Cells as files in global (row key, qualifier) order.

    The value is part of the ranges, so that the many versions of one cell can be split.
    """
    sorted_by(cells, ["row_key", "qualifier", "value"]).write.mode("overwrite").parquet(path)


def export_delimited(df: DataFrame, names: dict[str, str], path: str, separator: str = ",") -> None:
    """Chosen columns under their new names, with a header, as delimited files."""
    chosen = df.select(*[F.col(c).alias(n) for c, n in names.items()])
    chosen.write.mode("overwrite").option("header", True).option("sep", separator).csv(path)
