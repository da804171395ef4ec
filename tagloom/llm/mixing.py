"""Mixing sources to target weights: Pfair windows for source blocks, earliest deadline first."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that are ranked together, about.
CHUNK_ROWS = 4_096
MOST_SLOTS = 10_000
OTHER = "*"


def schedule(spark: SparkSession, weights: Mapping[str, int]) -> DataFrame:
    """``pool, turn, place``: which slot of a round each block of a pool takes; one row a slot.

    With W the sum of the weights, block j of a pool of weight w is released at slot floor(j W / w)
    and due by slot ceil((j + 1) W / w).  Every slot goes to the released block that is due first,
    ties to the pool named first.  This meets every window, so after any number of slots each pool
    has had less than one block more or less than its share; after W slots all are even and the
    round repeats.  The fold runs over W slots, a parameter, not over data.
    """
    total = sum(weights.values())
    if not weights or min(weights.values()) < 1 or total > MOST_SLOTS:
        raise ValueError(f"weights must be positive whole numbers with a sum of at most {MOST_SLOTS}")
    shares = F.array(*[F.lit(w) for w in weights.values()])
    names = F.array(*[F.lit(p) for p in weights])

    def take(state: Column, slot: Column) -> Column:
        """The pool that slot ``slot`` goes to."""
        windows = F.transform(F.arrays_zip(shares.alias("w"), state["given"].alias("g")), lambda x, i: F.struct(
            F.when((x["g"] < x["w"]) & (F.floor(x["g"] * total / x["w"]) <= slot), F.ceil((x["g"] + 1) * total / x["w"])).alias("due"), i.alias("pool"),
        ))
        return F.array_min(F.filter(windows, lambda x: x["due"].isNotNull()))["pool"]

    def step(state: Column, slot: Column) -> Column:
        pool = take(state, slot)
        return F.struct(
            F.transform(state["given"], lambda g, i: g + F.when(i == pool, 1).otherwise(0)).alias("given"),
            F.concat(state["order"], F.array(pool)).alias("order"),
        )

    empty = F.struct(F.transform(shares, lambda w: w * 0).alias("given"), F.array().cast("array<int>").alias("order"))
    order = F.aggregate(F.sequence(F.lit(0), F.lit(total - 1)), empty, step)["order"]
    slots = spark.range(1).select(F.posexplode(order).alias("place", "at")).select("place", F.element_at(names, F.col("at") + 1).alias("pool"))
    turn = F.row_number().over(Window.partitionBy("pool").orderBy("place")) - 1
    return slots.select("pool", turn.cast("long").alias("turn"), F.col("place").cast("long").alias("place"))


def mixed(
    docs: DataFrame, weights: Mapping[str, int], other: int, block: int, id_column: str = "doc_id", source_column: str = "source",
) -> DataFrame:
    """``row`` (the whole input row), ``pool, block, slot, position`` for each row of ``docs``.

    Sources without a weight, and null sources, share the pool ``OTHER`` of weight ``other``.  A
    pool's rows are put in the order of the MD5 of their id (ties by id, then by a hash of the row)
    and cut into blocks of ``block`` rows; blocks are laid out by ``schedule``.  Sorting by
    ``position`` gives the mix.  While no pool has run out, every prefix of whole slots is within one
    block of the weights; the slots of a pool that has run out stay empty, and the rest keeps its
    proportions.  No row is dropped or repeated; an empty table gives an empty one.

    A hot pool is ranked in chunks of MD5 prefixes, so no task holds a pool.
    """
    if not 1 <= block:
        raise ValueError("a block holds at least one row")
    weights = {**weights, OTHER: other}
    named = [p for p in weights if p != OTHER]
    source = F.col(source_column).cast("string")
    digits = max(0, math.ceil(math.log(max(1, docs.count()) / CHUNK_ROWS, 16)))
    key = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.when(source.isin(named), source).otherwise(F.lit(OTHER)).alias("pool"),
        key.alias("key"), F.col(id_column).alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("tie"),
    ).withColumn("chunk", F.substring("key", 1, digits))
    before = Window.partitionBy("pool").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("pool", "chunk").agg(F.count(F.lit(1)).alias("rows")).select(
        "pool", "chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(Window.partitionBy("pool", "chunk").orderBy("key", "id", "tie")) - 1
    ranked = keyed.withColumn("inside", inside).join(starts, ["pool", "chunk"]).withColumn("rank", F.col("start") + F.col("inside"))
    shares = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    blocks = ranked.withColumn("block", F.floor(F.col("rank") / block)).withColumn("share", shares[F.col("pool")])
    turns = blocks.withColumn("turn", F.col("block") % F.col("share"))
    placed = turns.join(F.broadcast(schedule(docs.sparkSession, weights)), ["pool", "turn"])  # one row a slot of a round
    slot = F.floor(F.col("block") / F.col("share")) * sum(weights.values()) + F.col("place")
    return placed.select("row", "pool", "block", slot.alias("slot"), (slot * block + F.col("rank") % block).alias("position"))


def in_mixed_order(mix: DataFrame) -> DataFrame:
    """The rows themselves, laid out in the order of the mix: partitions by range, sorted inside."""
    return mix.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def windows_in_sql(weights: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """The schedule again, slot by slot in plain Python, for oracles: ``(pool, turn, place)``."""
    total, given, out = sum(weights.values()), dict.fromkeys(weights, 0), []
    for slot in range(total):
        ready = [(-(-(given[p] + 1) * total // w), i, p) for i, (p, w) in enumerate(weights.items()) if given[p] < w and given[p] * total // w <= slot]
        pool = min(ready)[2]
        out.append((pool, given[pool], slot))
        given[pool] += 1
    return out
