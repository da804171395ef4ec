"""Joins the tag models share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tagloom.bounds import RULE_ROWS, small_copy
from tagloom.small import small_table


def match_values(
    df: DataFrame, value: str, rules: DataFrame, rule: str = "rule", tag: str = "tag_id",
    unmatched: str = "drop",
) -> DataFrame:
    """Add ``tag`` to the rows whose ``value`` equals a rule.

    ``unmatched`` rows are dropped, kept with a NULL tag, or make the job fail.  A rule table that
    is measured to be small is broadcast; any other takes Spark's own choice of join.
    """
    wanted = rules.select(F.col(rule).cast("string").alias("_rule"), F.col(tag).alias("_tag"))
    how = "inner" if unmatched == "drop" else "left"
    wanted = small_copy(wanted) or wanted
    joined = df.join(wanted, df[value].cast("string") == wanted["_rule"], how)
    found = F.col("_tag")
    if unmatched == "fail":
        text = F.concat(F.lit("no rule for value "), F.coalesce(F.col(value).cast("string"), F.lit("NULL")))
        found = F.when(found.isNull(), F.raise_error(text).cast("bigint")).otherwise(found)
    elif unmatched not in ("drop", "null"):
        raise ValueError(f"unmatched must be drop, null or fail, not {unmatched!r}")
    return joined.withColumn(tag, found).drop("_rule", "_tag")


def match_ranges(
    df: DataFrame, value: str, rules: DataFrame, lo: str = "lo", hi: str = "hi",
    tag: str = "tag_id",
) -> DataFrame:
    """Add ``tag`` to the rows whose ``value`` lies in ``[lo, hi]`` of a rule; others are dropped.

    An equi-join on grid cells at any number of rules; a few rules are a local relation, placed on the grid
    without a job, which Spark broadcasts.
    """
    wanted = rules.select(
        F.col(lo).cast("bigint").alias("_lo"), F.col(hi).cast("bigint").alias("_hi"),
        F.col(tag).alias("_tag"),
    )
    small = small_copy(wanted)
    if small is None:
        joined = interval_lookup(df, value, wanted, "_lo", "_hi", how="inner")
    else:
        placed, levels = _placed_locally(small)
        joined = _grid_join(df, value, placed, "_lo", "_hi", levels, salts=1).select(*df.columns, *small.columns)
    return joined.withColumn(tag, F.col("_tag")).drop("_lo", "_hi", "_tag")


def _placed_locally(small: DataFrame) -> tuple[DataFrame, list[int]]:
    """A local relation of ``_lo, _hi, _tag`` on the cells that ``interval_lookup`` would place it on, and the levels in use."""
    placed = []
    for lo, hi, tag in small.collect():  # a local relation is collected without a job
        if lo is not None and hi is not None and lo <= hi:
            level = (hi - lo).bit_length()
            placed += [(lo, hi, tag, level, cell) for cell in sorted({lo >> level, hi >> level})]
    schema = StructType([*small.schema.fields]).add("_level", IntegerType()).add("_cell", LongType())
    return small_table(small.sparkSession, placed, schema), sorted({row[3] for row in placed}) or [0]


def _level(width: Column) -> Column:
    """Smallest ``n`` with ``2**n >= width``."""
    return F.length(F.bin(width - 1)).cast("int") * (width > 1).cast("int")


def interval_lookup(
    points: DataFrame, point: str, intervals: DataFrame, lo: str, hi: str, how: str = "left",
    salts: int = 8,
) -> DataFrame:
    """Join whole-number points with the intervals ``[lo, hi]`` that contain them.

    Both sides may be large.  An interval of width ``w`` belongs to the power-of-two grid whose
    cells are at least ``w`` wide, so it touches at most two cells; a point looks into its cell of
    each grid in use (at most 64).  That gives an equi-join whose size does not depend on how wide
    the intervals are.  ``salts`` spreads a crowded cell over several tasks.  Up to ``RULE_ROWS``
    intervals, counted, are broadcast; more are shuffled, as Spark estimates the placed intervals from
    those it reads, without their cells and salts.  With ``how="left"`` points outside every interval
    are kept with NULLs.
    """
    sized = intervals.where(F.col(lo) <= F.col(hi)).withColumn(
        "_level", _level(F.col(hi) - F.col(lo) + 1)
    )
    counted = {row["_level"]: row["count"] for row in sized.groupBy("_level").count().collect()}
    levels = sorted(counted) or [0]
    few = sum(counted.values()) <= RULE_ROWS
    salts = 1 if few else salts
    cells = [F.expr(f"shiftright(cast(`{end}` as bigint), _level)") for end in (lo, hi)]
    placed = sized.withColumn("_cell", F.explode(F.array_distinct(F.array(*cells))))
    if salts > 1:
        placed = placed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = F.broadcast(placed) if few else placed.hint("merge")
    if how == "left":
        values = points.select(F.col(point).alias("_point")).where(F.col(point).isNotNull()).distinct()
        found = _grid_join(values, "_point", placed, lo, hi, levels, salts)
        found = found.select("_point", *intervals.columns)
        return points.join(found, points[point] == found["_point"], "left").drop("_point")
    return _grid_join(points, point, placed, lo, hi, levels, salts).select(
        *points.columns, *intervals.columns
    )


def _grid_join(
    points: DataFrame, point: str, placed: DataFrame, lo: str, hi: str, levels: list[int], salts: int
) -> DataFrame:
    value = F.col(point).cast("bigint")
    probes = [
        F.struct(F.lit(n).alias("_level"), F.shiftright(value, n).alias("_cell")) for n in levels
    ]
    if salts == 1:
        looked_up = points.select(*points.columns, F.inline(F.array(*probes)))
        return looked_up.join(placed, ["_level", "_cell"]).where(F.col(point).between(F.col(lo), F.col(hi)))
    salt = F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int")
    looked_up = points.withColumn("_salt", salt).select(
        *points.columns, "_salt", F.inline(F.array(*probes))
    )
    joined = looked_up.join(placed, ["_salt", "_level", "_cell"])
    return joined.where(F.col(point).between(F.col(lo), F.col(hi)))


def lookup_default(
    df: DataFrame, name: str, dim: DataFrame, dim_name: str, dim_id: str, out: str, default: int = 0
) -> DataFrame:
    """Dimension name -> id; a name the dimension lacks gets ``default``."""
    side = dim.select(F.col(dim_name).alias("_name"), F.col(dim_id).alias("_id"))
    joined = df.join(side, df[name] == side["_name"], "left")
    return joined.withColumn(out, F.coalesce(F.col("_id"), F.lit(default))).drop("_name", "_id")


def rows_with_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Whole rows of ``df`` whose key is among ``keys``."""
    return df.join(keys.select(on), on, "left_semi")
