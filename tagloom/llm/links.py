"""Connected components of links between ids, and small tools for joins by group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch

#: Links that one task takes at the end: 16 bytes each.
FINISH_LINKS = 1_000_000
#: Ids that may be broadcast: 8 bytes each.  A longer list is joined by shuffle.
BROADCAST_IDS = 1_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the links (a, b) and for each the smallest id of its component."""
    ids, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = where[: len(a)], where[len(a) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return ids, ids[label]
        label = new


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a = b = np.empty(0, dtype=np.int64)
    for batch in batches:
        a = np.concatenate((a, batch.column(0).to_numpy(zero_copy_only=False)))
        b = np.concatenate((b, batch.column(1).to_numpy(zero_copy_only=False)))
        ids, low = roots(a, b)
        a, b = ids[ids != low], low[ids != low]
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def contracted(links: DataFrame) -> DataFrame:
    """Each partition's links as stars: (a, b) with b the smallest id that a reaches in it."""
    return links.select("a", "b").mapInArrow(_contracted, "a long, b long")


def _star_round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step; both keep the components."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("low"))
    small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return small.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(links: DataFrame, scratch: Scratch, name: str, finish: int = FINISH_LINKS) -> DataFrame:
    """``(id, component)`` for every id that is not the smallest of its component.

    Partitions contract their own links first.  While more than ``finish`` stars are left, star steps
    shrink them over the cluster; then one task of bounded size ends it.
    """
    stars = scratch.keep(contracted(links.where("a <> b")), f"{name}-0")
    turn, mark = 0, None
    while True:
        new = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new[0] <= finish:
            stars = contracted(stars.coalesce(1))
            break
        if new == mark:
            break
        mark, turn = new, turn + 1
        stars = scratch.keep(_star_round(stars), f"{name}-{turn}")
    return scratch.keep(stars.select(F.col("a").alias("id"), F.col("b").alias("component")), f"{name}-ends")


def rows_with_ids(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is in the kept, distinct table ``ids``."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, column, "left_semi")


def blocks(members: DataFrame, group: str, member: str, parts: str) -> DataFrame:
    """Members dealt to block pairs: every two members of a group meet in exactly one task.

    ``parts`` holds the number of blocks of the row's group.  Adds ``lo``, ``hi`` (the task's blocks)
    and ``side`` (the row's own); in a task with lo < hi only pairs across the two sides count.
    """
    own = members.withColumn("side", F.pmod(F.xxhash64(member), F.col(parts)).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), (F.col(parts) - 1).cast("int"))))
    return other.select(
        *own.columns, F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi")
    )


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition that is sorted by ``keys``, one whole group at a time."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        rest = batch if rest is None else pd.concat((rest, batch), ignore_index=True)
        values = rest[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        start = 0
        for cut in cuts:
            yield rest.iloc[start:cut]
            start = cut
        rest = rest.iloc[start:]
    if rest is not None and len(rest):
        yield rest
