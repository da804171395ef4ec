"""Near-duplicate documents: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.links import blocks, components, roots, rows_with_ids, runs
from tagloom.llm.scratch import Scratch
from tagloom.llm.shingles import shingle_set, sketch
from tagloom.llm.vectors import slices, small_batches

#: Members and shingles of a block: what one task holds of a bucket, twice.
BLOCK_MEMBERS = 1_024
BLOCK_SHINGLES = 1 << 21
#: Pairs a block may hand on, per member; a denser block verifies its pairs itself.
HANDED_ON = 8
#: Standard deviations by which an estimate may fall short of the threshold.
SLACK = 4.5


def _marking(size: int, bins: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, digests, sketches = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, size)
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                sketches.append(sketch(found, bins).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "digest", "sketch"],
            )

    return mark


def _sets(size: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(text, size).tobytes() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.large_binary()).cast(pa.binary())], ["id", "elements"])

    return build


def _linked(common, one, other, percent: int):
    return 100 * common >= percent * (one + other - common)


def _confirming(percent: int):
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            holds = np.zeros(len(batch), dtype=bool)
            for i, (one, other) in enumerate(zip(batch.one, batch.other)):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                both = np.sort(np.concatenate((x, y)))
                holds[i] = _linked(int((both[1:] == both[:-1]).sum()), x.size, y.size, percent)
            yield batch.loc[holds, ["a", "b"]]

    return confirm


class _Task:
    """One block pair of a bucket: which of its pairs are candidates that no earlier band has."""

    def __init__(self, rows: pd.DataFrame, bins: int, band_rows: int, percent: int):
        self.ids = rows.id.to_numpy()
        self.counts = rows.n_shingles.to_numpy()
        self.part = rows.component.to_numpy()
        self.side = rows.side.to_numpy()
        self.band = int(rows.band.iloc[0])
        self.across = bool((rows.lo != rows.hi).iloc[0])
        self.sketches = np.frombuffer(b"".join(rows.sketch), np.uint32).reshape(len(rows), bins)
        self.band_rows, self.percent = band_rows, percent
        share = percent / 100
        self.agree = bins * share - SLACK * (bins * share * (1 - share)) ** 0.5

    def allowed(self, i: int, later: np.ndarray) -> np.ndarray:
        """Of the rows ``later``, those in another component, of a size that allows a link, seen here first by side."""
        low, high = np.minimum(self.counts[later], self.counts[i]), np.maximum(self.counts[later], self.counts[i])
        fits = (self.part[later] != self.part[i]) & (100 * low >= self.percent * high)
        return later[fits & (self.side[later] != self.side[i])] if self.across else later[fits]

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        first, second = [], []
        for i in range(len(self.ids) - 1):
            later = self.allowed(i, np.arange(i + 1, len(self.ids)))
            if later.size:
                same = self.sketches[later] == self.sketches[i]
                near = same.sum(axis=1) >= self.agree
                later, same = later[near], same[near]
                earlier = same[:, : self.band * self.band_rows].reshape(len(later), self.band, self.band_rows)
                later = later[~earlier.all(axis=2).any(axis=1)]
                first.append(np.full(later.size, i))
                second.append(later)
        none = np.empty(0, dtype=np.int64)
        return np.concatenate(first or [none]), np.concatenate(second or [none])


_TASK_KEYS = ["key", "lo", "hi"]


def _screening(bins: int, band_rows: int, percent: int):
    """Pairs of sparse blocks; the members of dense ones, with no partner."""

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs(batches, _TASK_KEYS):
            task = _Task(rows, bins, band_rows, percent)
            first, second = task.candidates()
            if first.size > HANDED_ON * len(rows):
                yield rows[["key", "band", "lo", "hi", "side", "component"]].assign(a=task.ids, b=-1, dense=True)
            elif first.size:
                yield pd.DataFrame({
                    "key": rows.key.iloc[0], "band": task.band, "lo": rows.lo.iloc[0], "hi": rows.hi.iloc[0], "side": 0,
                    "component": 0, "a": task.ids[first], "b": task.ids[second], "dense": False,
                })

    return screen


def _shared(rows: pd.DataFrame) -> np.ndarray:
    """The sizes of all intersections between the rows' sets, by products of incidence columns."""
    sets = [np.frombuffer(x, np.uint64) for x in rows.elements]
    owner = np.repeat(np.arange(len(sets)), [x.size for x in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    order = order[times[column[order]] > 1]
    owner, column = owner[order], column[order]
    _, column = np.unique(column, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for start in range(0, int(column.max(initial=-1)) + 1, 2_048):
        low, high = np.searchsorted(column, (start, start + 2_048))
        held = np.zeros((len(sets), 2_048), dtype=np.float32)
        held[owner[low:high], column[low:high] - start] = 1
        out += held @ held.T
    return out


def _settling(bins: int, band_rows: int, percent: int):
    """Links inside dense blocks, as the stars that connect the same members."""

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs(batches, _TASK_KEYS):
            common, counts, ids = _shared(rows), rows.n_shingles.to_numpy(), rows.id.to_numpy()
            links = np.triu(_linked(common, counts[:, None], counts[None, :], percent), 1)
            first, second = np.nonzero(links)
            if first.size:
                nodes, low = roots(ids[first], ids[second])
                yield pd.DataFrame({"a": nodes[nodes != low], "b": low[nodes != low]})

    return settle


def near_duplicates(
    docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", size: int = 5,
    percent: int = 80, bins: int = 128, band_rows: int = 4,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Two documents are linked if their shingle sets share at least ``percent`` % of their union.
    Documents with equal sets form a class, represented by its smallest id.  Sketches of the classes
    are cut into bands; a bucket's members are first verified against one leader each, which joins
    most copies, and then every pair of a bucket that is still in two components is verified, unless
    the sketches put it ``SLACK`` standard deviations below the threshold.  Buckets are worked in
    blocks of bounded size, and nothing lists the pairs of a large group.

    Null and empty texts and texts without words have no shingles and are linked with nothing.  Rows
    that repeat an id count as one document: they share a component.  A row without an id takes no
    part: its component is null and it is kept.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    bands = bins // band_rows
    marked = scratch.keep(
        source.mapInArrow(_marking(size, bins), "doc_id long, n_shingles long, digest binary, sketch binary"), "marked"
    )
    some = marked.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = scratch.keep(
        some.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")),
        "classes",
    )
    # two different sets can only be linked if they share at least percent / (100 - percent) shingles
    able = classes.where(F.col("n_shingles") * (100 - percent) >= percent)
    keyed = able.select(
        "id", "n_shingles",
        F.posexplode(F.expr(f"transform(sequence(0, {bands - 1}), j -> xxhash64(j, substring(sketch, j * {4 * band_rows} + 1, {4 * band_rows})))")).alias("band", "key"),
    )
    leads = keyed.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("lead"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = scratch.keep(keyed.join(leads, "key").select("key", "band", "id", "n_shingles", "lead", "members"), "shared")

    star = (
        shared.where((F.col("id") > F.col("lead.id")) & (100 * F.least("n_shingles", "lead.n_shingles") >= percent * F.greatest("n_shingles", "lead.n_shingles")))
        .groupBy("id").agg(F.min("lead.id").alias("b")).select(F.col("id").alias("a"), "b")
    )
    star = scratch.keep(star, "star")

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        ids = scratch.keep(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), f"{name}-ids")
        found = rows_with_ids(source, ids, "doc_id").mapInArrow(_sets(size), "id long, elements binary")
        return scratch.keep(found.dropDuplicates(["id", "elements"]), f"{name}-sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        sets = sets_of(pairs, name)
        both = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("one")), "a").join(
            sets.select(F.col("id").alias("b"), F.col("elements").alias("other")), "b"
        )
        return scratch.keep(both.select("a", "b", "one", "other").mapInPandas(_confirming(percent), "a long, b long"), f"{name}-links")

    links = confirmed(star, "star")
    first = components(links, scratch, "first")
    scratch.drop("star-sets")

    placed = shared.join(first, "id", "left").select(
        "key", "band", "id", "n_shingles", F.coalesce("component", "id").alias("component")
    )
    open_keys = placed.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("parts"),
    ).where("low <> high").select("key", "parts")
    dealt = blocks(placed.join(open_keys, "key"), "key", "id", "parts").join(classes.select("id", "sketch"), "id")
    columns = ["key", "band", "lo", "hi", "side", "id", "n_shingles", "component", "sketch"]
    screened = scratch.keep(
        dealt.select(*columns).repartition(*_TASK_KEYS).sortWithinPartitions(*_TASK_KEYS, "id").mapInPandas(
            _screening(bins, band_rows, percent),
            "key long, band int, lo int, hi int, side int, component long, a long, b long, dense boolean",
        ),
        "screened",
    )
    handed = confirmed(screened.where("NOT dense").select("a", "b").distinct(), "handed")
    scratch.drop("handed-sets")
    dense = screened.where("dense")
    members = dense.select("a", F.col("a").alias("b"))
    packed = dense.withColumnRenamed("a", "id").drop("b", "dense").join(classes.select("id", "n_shingles"), "id").join(sets_of(members, "dense"), "id")
    settled = scratch.keep(
        packed.repartition(*_TASK_KEYS).sortWithinPartitions(*_TASK_KEYS, "id").mapInPandas(_settling(bins, band_rows, percent), "a long, b long"),
        "settled",
    )
    ends = components(links.union(handed).union(settled), scratch, "last")
    named = classes.join(ends, "id", "left").select("digest", F.coalesce("component", "id").alias("found"))
    out = marked.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("found")))
    result = out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
    result = scratch.keep(result, "result")
    scratch.drop("marked", "classes", "shared", "star", "star-ids", "screened", "handed-ids", "dense-ids", "dense-sets")
    return result
