"""Numbered pages at any depth: a directory of key ranges with exact counts tells where a page starts.

The directory is made by one pass over the keys and is small: one line a range.  Page ``number`` then reads the
range it starts in, and the next ones if it reaches over the end; nothing before it is read, sorted or skipped.  A range
that is still large gets a directory of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of a directory, and the rows of a range up to which a page is looked for inside it.
RANGES = 256
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Range:
    """The rows with keys from ``low`` to ``high``, and how many rows of smaller keys there are."""

    low: object
    high: object
    rows: int
    before: int


def page_directory(df: DataFrame, key: str, ranges: int = RANGES) -> list[Range]:
    """Ranges of about equal size in key order; equal keys are in one range, rows without a key in none.

    Spark samples the keys for the bounds and deals them out; a task counts what it got.
    """
    keys = df.select(F.col(key).alias("key")).where(F.col("key").isNotNull())
    dealt = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id().alias("range"))
    found = dealt.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).collect()
    out, before = [], 0
    for row in sorted(found, key=lambda row: row["low"]):
        out.append(Range(row["low"], row["high"], row["n"], before))
        before += row["n"]
    return out


def numbered_page(df: DataFrame, key: str, number: int, size: int, directory: Sequence[Range]) -> DataFrame:
    """Page ``number`` (from 1; below 1 means the first) in key order, without the pages before it.

    ``directory`` is that of ``df`` and ``key``.  Rows of equal keys have no order among each other.  Pages
    after the last one are empty.
    """
    first = (max(number, 1) - 1) * size
    at = [r for r in directory if r.before < first + size and r.before + r.rows > first]
    if not at or size < 1:
        return df.limit(0)
    low, high, skip = at[0].low, at[-1].high, first - at[0].before
    if skip and at[0].rows > RANGE_ROWS and at[0].low != at[0].high:
        inner = page_directory(df.where(F.col(key).between(F.lit(low), F.lit(at[0].high))), key)
        if len(inner) > 1:
            inside = [Range(r.low, r.high, r.rows, r.before + at[0].before) for r in inner]
            return numbered_page(df, key, number, size, [*inside, *(r for r in directory if r.before > at[0].before)])
    rows = df.where(F.col(key).between(F.lit(low), F.lit(high))).orderBy(key).limit(skip + size)
    if not skip:
        return rows
    place = "_place"
    while place in df.columns:
        place = f"_{place}"
    ranked = rows.withColumn(place, F.row_number().over(Window.orderBy(key)))
    return ranked.where(F.col(place) > skip).drop(place)
