"""Exact top-k search by inner product over an index of pivots and distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.scratch import Scratch
from tagloom.llm.vectors import matrix, packed, unpacked, usable, width

#: One pivot for so many vectors, within these bounds.
VECTORS_A_PIVOT = 4_000
PIVOTS = (8, 1_024)
#: Annuli of equal width around each pivot; an annulus is held in blocks of so many vectors.
ANNULI = 8
BLOCK = 4_096
#: Queries of one task.
QUERIES = 1_024
#: Annuli that a query visits in its first step, and how many times more in each later one.
FIRST_STEP, GROWTH = 1, 8
#: Numbers of a matrix, and copies of queries, that a task holds at once, however many annuli there are.
CELLS, COPIES = 1 << 20, 32_768
_EXACT = float(1 << 53)
_LONG = (-(1 << 63), (1 << 63) - 1)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in doubles where these hold every sum, else in Python's integers, held within 64 bits."""
    if queries.size and vectors.size and np.abs(queries).max() * np.abs(vectors).max() * queries.shape[1] >= _EXACT:
        whole = lambda rows: np.array([[int(x) for x in row] for row in rows], dtype=object)
        return np.clip(whole(queries) @ whole(vectors).T, *_LONG)
    return queries @ vectors.T


def _parts(batches: Iterator[pa.RecordBatch], wide: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``CELLS`` numbers, ``wide`` for each row."""
    rows = max(1, CELLS // max(1, wide))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _from_pivots(rows: np.ndarray, lift: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    """Distances in the space where a further component gives every vector the same length."""
    squares = (rows * rows).sum(axis=1) + lift**2
    pivot_squares = (pivots * pivots).sum(axis=1) + pivot_lift**2
    inner = rows @ pivots.T + lift[:, None] * pivot_lift[None, :]
    return np.sqrt(np.maximum(0.0, squares[:, None] + pivot_squares[None, :] - 2 * inner))


def _lift(rows: np.ndarray, longest: float) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, longest - (rows * rows).sum(axis=1)))


def _keying(pivots: np.ndarray, longest: float, dims: int):
    """Each vector's nearest pivot and its distance from it."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, len(pivots) + dims):
            rows = matrix(batch.column(1), dims)
            far = _from_pivots(rows, _lift(rows, longest), pivots, _lift(pivots, longest))
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), packed(rows), pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(far)), cell])], ["vec_id", "vector", "cell", "dist"]
            )

    return key


class _Annuli:
    """The annuli in use: pivot, inner and outer distance, vectors, blocks.  At most pivots x ANNULI rows."""

    def __init__(self, rows, pivots: np.ndarray, longest: float):
        self.cell, self.ring, self.parts, self.size = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
        self.low, self.high = (np.array([r[i] for r in rows], dtype=np.float64) for i in (4, 5))
        self.pivots, self.longest = pivots, longest

    def ceilings(self, queries: np.ndarray) -> np.ndarray:
        """The highest score that each annulus can hold for each query, by the triangle inequality."""
        far = _from_pivots(queries, np.zeros(len(queries)), self.pivots, _lift(self.pivots, self.longest))[:, self.cell]
        gap = np.maximum(0.0, np.maximum(self.low[None, :] - far, far - self.high[None, :]))
        best = ((queries * queries).sum(axis=1)[:, None] + self.longest - gap**2) / 2
        return best + 1e-6 * (1.0 + np.abs(best))


def _routing(annuli: _Annuli, dims: int, start: int, stop: int):
    """Sends queries to the blocks of their annuli from place ``start`` to ``stop`` in the order of falling
    ceilings; the first whose ceiling is below the query's floor ends its way."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, len(annuli.cell) + dims):
            ceilings = annuli.ceilings(unpacked(batch.column("vector").to_pylist(), dims))
            floor = _below(batch.column("floor").to_numpy(zero_copy_only=False))  # null: nothing known
            order = np.argsort(-ceilings, axis=1, kind="stable")[:, start:stop]
            go = ~(np.take_along_axis(ceilings, order, axis=1) < floor[:, None])
            query, place = np.nonzero(go)
            annulus = order[query, place]
            stops = np.cumsum(annuli.parts[annulus])
            at = 0
            while at < len(query):
                end = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + COPIES, side="right")))
                times = annuli.parts[annulus[at:end]]
                part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                sent, ring = np.repeat(query[at:end], times), np.repeat(annulus[at:end], times)
                kept = batch.select(["query_id", "vector", "floor"]).take(pa.array(sent))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *(pa.array(x.astype(np.int32)) for x in (annuli.cell[ring], annuli.ring[ring], part))],
                    ["query_id", "vector", "floor", "cell", "ring", "part"],
                )
                at = end

    return route


def _below(floor: np.ndarray) -> np.ndarray:
    """Floors that doubles may have rounded up, a step lower."""
    return np.where(np.abs(floor) >= _EXACT, np.nextafter(floor, -np.inf), floor)


_FOUND = "query_id long, query binary, vec_id long, score long"


def _searching(dims: int, k: int):
    """Per query of a task, the k best of the block that reach the query's floor."""

    def search(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            held = held.sort_values("vec_id", kind="stable")
            ids, vectors = held.vec_id.to_numpy(), unpacked(held.vector, dims)
            for start in range(0, len(queries), 256):
                some = queries.iloc[start : start + 256]
                scores = _scores(unpacked(some.vector, dims), vectors)
                for query, raw, floor, row in zip(some.query_id, some.vector, _below(some.floor.to_numpy(np.float64)), scores):
                    able = ids != query
                    if floor == floor:
                        able &= row >= floor
                    at = np.flatnonzero(able)
                    if len(at) > k:
                        least = np.partition(row[at], len(at) - k)[len(at) - k]
                        at = at[row[at] >= least]
                    at = at[np.argsort(-row[at], kind="stable")][:k]
                    if len(at):
                        out.append(pd.DataFrame({"query_id": query, "query": raw, "vec_id": ids[at], "score": [int(x) for x in row[at]]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})

    return search


def top_inner(df: DataFrame, scratch: Scratch, is_query, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 20, scale: float = 64.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` holds, its ``k`` best others.

    Components become floor(scale * x); scores are inner products of these whole numbers, ties go to
    the smaller id.  A further component that gives all vectors the length of the longest turns the
    highest inner product into the least distance, so the triangle inequality bounds the scores of
    every annulus around a pivot.  A query expands its annuli in the order of falling bounds, in steps that
    grow; after each step its k-th score so far is its floor, and it stops at the first bound below it.

    Vectors that are null or hold null or non-finite components take no part, also after scaling, nor do rows
    without an id.  Scores beyond 64 bits are held at the ends of their range.  Equal rows count once; shorter
    vectors count as padded with zeros.
    """
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    whole = lambda y: F.when(F.abs(y) >= _EXACT, y).otherwise(F.floor(y).cast("double"))
    rows = rows.select("vec_id", F.transform("v", lambda x: whole(x * F.lit(scale))).alias("v")).where(usable(F.col("v"))).distinct()
    rows = scratch.keep(rows, "rows")
    n, dims = rows.count(), width(rows, "v")
    longest = float(rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] or 0.0)
    wanted = min(max(PIVOTS[0], -(-n // VECTORS_A_PIVOT)), PIVOTS[1])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("v").toArrow().column(0).combine_chunks()
    pivots = matrix(sample, dims) if n else np.zeros((1, dims))
    keyed = scratch.keep(rows.mapInArrow(_keying(pivots, longest, dims), "vec_id long, vector binary, cell int, dist double"), "keyed")
    spans = keyed.groupBy("cell").agg(F.min("dist").alias("near"), F.max("dist").alias("far"))
    ring = F.when(F.col("far") > F.col("near"), F.least(F.lit(ANNULI - 1), F.floor((F.col("dist") - F.col("near")) / (F.col("far") - F.col("near")) * ANNULI))).otherwise(0).cast("int")
    ringed = keyed.join(spans, "cell").withColumn("ring", ring).drop("near", "far")
    stats = ringed.groupBy("cell", "ring").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"), F.count(F.lit(1)).alias("size"), F.min("dist").alias("low"), F.max("dist").alias("high")
    )
    annuli = _Annuli(stats.select("cell", "ring", "parts", "size", "low", "high").collect(), pivots, longest)
    index = ringed.join(stats.select("cell", "ring", "parts"), ["cell", "ring"]).select(
        "cell", "ring", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), "vec_id", "vector"
    )
    index = scratch.keep(index, "index")
    queries = scratch.keep(keyed.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), "vector"), "queries")
    deals = max(1, -(-queries.count() // QUERIES))
    routed = "query_id long, vector binary, floor double, cell int, ring int, part int"

    def searched(open_queries: DataFrame, start: int, stop: int) -> DataFrame | None:
        sent = open_queries.mapInArrow(_routing(annuli, dims, start, stop), routed).withColumn("deal", F.pmod(F.xxhash64("query_id"), F.lit(deals)).cast("int"))
        tasks = scratch.keep(sent, f"sent-{start}")
        if tasks.isEmpty():
            return None
        keys = ["cell", "ring", "part", "deal"]
        asked = tasks.groupBy(*[F.col(c).alias(f"asked_{c}") for c in keys]).agg(F.lit(1))
        asked = asked.select(*[F.col(f"asked_{c}").alias(c) for c in keys])
        blocks = index.join(asked, ["cell", "ring", "part"])
        return scratch.keep(tasks.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(_searching(dims, k), _FOUND), f"found-{start}")

    if not len(annuli.cell):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    best, start, step, made = None, 0, FIRST_STEP, []
    while start < len(annuli.cell):
        if best is None:
            waiting = queries.withColumn("floor", F.lit(None).cast("double"))
        else:
            floors = best.where(F.col("rank") == k).select("query_id", "query", F.col("score").cast("double").alias("floor"))
            waiting = queries.withColumnRenamed("vector", "query").join(floors, ["query_id", "query"], "left").withColumnRenamed("query", "vector")
        found = searched(waiting.select("query_id", "vector", "floor"), start, start + step)
        made += [f"sent-{start}", f"found-{start}", f"best-{start}"]
        if found is None:
            break
        if best is not None:
            found = best.drop("rank").unionByName(found)
        best = scratch.keep(found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k), f"best-{start}")
        start, step = start + step, step * GROWTH
    if best is None:
        return queries.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    result = scratch.keep(best.select("query_id", "rank", "vec_id", "score"), "result")
    scratch.drop("rows", "keyed", "index", "queries", *made)
    return result
