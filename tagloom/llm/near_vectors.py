"""Near-duplicate vectors: an exact range join in the metric of the unit sphere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.links import components, roots
from tagloom.llm.scratch import Scratch
from tagloom.llm.vectors import matrix, packed, unpacked, usable, width

#: One pivot for so many vectors, within these bounds; the pivots are all that the driver holds.
VECTORS_A_PIVOT = 2_000
PIVOTS = (8, 2_048)
#: Vectors of a block; a task holds two blocks.
BLOCK = 4_096
#: Copies of vectors that a task writes at once, however many pivots there are.
COPIES = 32_768
_CHUNK = 256
#: Cosines this near to the threshold are computed again from the vectors as given.
_DOUBT = 1e-9
#: Rounding of differences of squared distances; pivots nearer to one another than ``_TWIN`` count as one.
_SLACK = 1e-9
_TWIN = 1e-6


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _tame(rows: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component near 1: exact, and its squares neither over- nor underflow."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0.0))[1][:, None])


def _parts(batches: Iterator[pa.RecordBatch], pivots: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces whose rows have ``COPIES`` copies at most, were each in every cell."""
    rows = max(1, COPIES // pivots)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (units @ pivots.T)))


def _apart(pivots: np.ndarray) -> np.ndarray:
    """Distances between pivots, from their differences: exact also where they are nearly equal."""
    return np.array([np.sqrt(((pivots - pivot) ** 2).sum(axis=1)) for pivot in pivots])


def _distinct(pivots: np.ndarray) -> np.ndarray:
    """The pivots without those that have nearly the direction of an earlier one: multiples of a vector are one direction."""
    twins = np.tril(_apart(pivots) < _TWIN, -1)
    kept = np.ones(len(pivots), dtype=bool)
    for i in range(len(pivots)):
        kept[i] = not (twins[i] & kept).any()
    return pivots[kept]


def _homing(pivots: np.ndarray, dims: int):
    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, len(pivots)):
            rows = _tame(matrix(batch.column(0), dims))
            far = _distances(_unit(rows), pivots)
            cell = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(far)), cell]), *batch.columns[1:], packed(rows)],
                ["cell", "dist", "id", "tag", "weight", "vector"],
            )

    return home


def _replicating(pivots: np.ndarray, radius: np.ndarray, reach: float, dims: int):
    """Every vector in its own cell, and in each later cell that may hold a partner.

    A partner y in cell q is at least as near to q as to x's own pivot p, so x can only be within
    ``reach`` of it if x is within ``reach`` of the plane halfway between p and q, and if x is within
    ``reach`` plus the cell's radius of q (triangle inequality).  ``_SLACK`` covers the rounding of
    the squares, which decides alone where p and q are nearly equal.
    """
    between = _apart(pivots)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, len(pivots)):
            rows = unpacked(batch.column("vector").to_pylist(), dims)
            home = batch.column("cell").to_numpy()
            far = _distances(_unit(rows), pivots)
            own = far[np.arange(len(far)), home][:, None]
            near = (far**2 - own**2 <= 2 * reach * between[home] + _SLACK) & (far <= radius[None, :] + reach)
            near &= np.arange(len(pivots))[None, :] > home[:, None]
            which, cell = np.nonzero(near)
            take = pa.array(np.concatenate((np.arange(len(rows)), which)))
            copy = np.concatenate((np.zeros(len(rows), dtype=bool), np.ones(len(which), dtype=bool)))
            cells = np.concatenate((home, cell)).astype(np.int32)
            dist = np.concatenate((own[:, 0], far[which, cell]))
            kept = batch.select(["id", "tag", "weight", "vector"]).take(take)
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(dist), pa.array(copy), *kept.columns], ["cell", "dist", "copy", "id", "tag", "weight", "vector"])

    return replicate


def _stars(links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a matrix of links: the rows and columns that have any, and the component number of each (rows first)."""
    rows, columns = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
    part = links[np.ix_(rows, columns)]
    label = np.arange(len(rows))
    while True:
        down = np.where(part, label[:, None], len(rows)).min(axis=0)
        back = np.where(part, down[None, :], len(rows)).min(axis=1)
        if (back == label).all():
            return rows, columns, np.concatenate((back, down))
        label = back


def _joining(threshold: float, reach: float, dims: int):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("dist", kind="stable")
        raw, ids = unpacked(rows.vector, dims), rows.id.to_numpy()
        units, dist, weight, side = _unit(raw), rows.dist.to_numpy(), rows.weight.to_numpy(), rows.side.to_numpy()
        across = bool((rows.lo != rows.hi).iloc[0])
        lo = rows.lo.iloc[0]
        left = np.flatnonzero(side == lo) if across else np.arange(len(rows))
        right = np.flatnonzero(side != lo) if across else left
        counts, tied_a, tied_b = np.zeros(len(rows), dtype=np.int64), [], []
        for start in range(0, len(left), _CHUNK):
            mine = left[start : start + _CHUNK]
            low, high = np.searchsorted(dist[right], (dist[mine[0]] - reach, dist[mine[-1]] + reach + _DOUBT))
            other = right[low if across else max(low, start) : high]
            if not len(other):
                continue
            cosine = units[mine] @ units[other].T
            links = cosine >= threshold
            for i, j in zip(*np.nonzero(np.abs(cosine - threshold) < _DOUBT)):
                a, b = raw[mine[i]], raw[other[j]]
                links[i, j] = np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold
            if not across:
                links &= other[None, :] > mine[:, None]
            if links.any():
                counts[mine] += links @ weight[other]
                counts[other] += weight[mine] @ links
                some, more, label = _stars(links)
                nodes = np.concatenate((mine[some], other[more]))
                tied_a.append(nodes)
                tied_b.append(mine[some][label])
        found = counts > 0
        out = pd.DataFrame({"id": ids[found], "tag": rows.tag.to_numpy()[found], "links": counts[found], "low": ids[found]})
        if tied_a:
            nodes, low = roots(ids[np.concatenate(tied_a)], ids[np.concatenate(tied_b)])
            out["low"] = low[np.searchsorted(nodes, out["id"].to_numpy())]
        return out

    return join


def near_vectors(df: DataFrame, scratch: Scratch, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row; links are cosines of at least ``threshold``.

    Equal vectors form a class that is compared once.  Pivots, the directions of a hashed sample of bounded size, cut
    the unit sphere into cells; boundary vectors are copied into the cells that may hold a partner,
    so that cells join independently and each pair is met once.  Cells are worked as pairs of blocks,
    which bounds every task; a task returns counts and the ends of its links' components, not pairs.

    Vectors that are null, zero, or hold null or non-finite components have no links.  Shorter
    vectors count as padded with zeros.  Rows that repeat an id are vectors of their own with a
    common component; a row without an id takes no part: null component, kept.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    ready = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.when(ready, F.col("v")).alias("v"))
    tags = [F.xxhash64("v").alias("tag"), F.hash("v").alias("tag2")]
    classes = scratch.keep(
        rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")).select("v", "id", "weight", *tags), "classes"
    )
    n, dims = classes.count(), width(classes, "v")
    reach = float(np.sqrt(2.0 - 2.0 * threshold)) + 1e-7
    wanted = min(max(PIVOTS[0], -(-n // VECTORS_A_PIVOT)), PIVOTS[1])
    sample = classes.orderBy("tag", "id").limit(wanted).select("v").toArrow().column(0).combine_chunks()
    pivots = _distinct(_unit(_tame(matrix(sample, dims)))) if n else np.zeros((1, dims))
    homes = scratch.keep(
        classes.select("v", "id", "tag", "weight").mapInArrow(_homing(pivots, dims), "cell int, dist double, id long, tag long, weight long, vector binary"), "homes"
    )
    radius = np.full(len(pivots), -np.inf)
    for cell, far in homes.groupBy("cell").agg(F.max("dist")).collect():  # one row a pivot
        radius[cell] = far
    members = scratch.keep(
        homes.mapInArrow(_replicating(pivots, radius, reach, dims), "cell int, dist double, copy boolean, id long, tag long, weight long, vector binary"), "members"
    )
    parts = members.groupBy("cell").agg(
        F.greatest(F.lit(1), F.ceil(F.count_if(~F.col("copy")) / BLOCK)).alias("homes"), F.ceil(F.count_if("copy") / BLOCK).alias("copies")
    )
    side = F.when(F.col("copy"), F.col("homes") + F.pmod(F.xxhash64("id", "tag"), F.greatest("copies", F.lit(1)))).otherwise(F.pmod(F.xxhash64("id", "tag"), "homes"))
    other = F.sequence(F.lit(0).cast("long"), F.col("homes") + F.when(F.col("copy"), 0).otherwise(F.col("copies")) - 1)
    dealt = members.join(parts, "cell").withColumn("side", side).withColumn("other", F.explode(other))
    dealt = dealt.select(
        "cell", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side", "dist", "id", "tag", "weight", "vector"
    )
    found = scratch.keep(
        dealt.groupBy("cell", "lo", "hi").applyInPandas(_joining(threshold, reach, dims), "id long, tag long, links long, low long"), "found"
    )
    ends = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")), scratch, "ends")
    counted = found.groupBy("id", "tag").agg(F.sum("links").alias("links"))
    named = (
        classes.select("id", "tag", "tag2", "weight").join(counted, ["id", "tag"], "left").join(ends, "id", "left")
        .select("tag", "tag2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    )
    marked = rows.select("vec_id", *[F.when(F.col("v").isNotNull(), t).alias(name) for t, name in zip(tags, ("tag", "tag2"))])
    out = marked.join(named, ["tag", "tag2"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )
    result = scratch.keep(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))), "result")
    scratch.drop("classes", "homes", "members", "found")
    return result
