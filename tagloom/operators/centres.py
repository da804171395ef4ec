"""KMeans from a fixed start.

The library's KMeans draws its first centres from samples, so a cluster index, and now and then a
cluster, depends on how the rows lie in partitions.  Here the first centres lie evenly on the
diagonal of the box around the vectors and every step is one weighted aggregation with map-side
combine: a task hands on one row a cluster, so a cluster that holds most users is no hot key.  New
centres are rounded to ``PLACES``, which hides the order in which partitions were summed.  A task
that runs again, or another cluster, gives the same clusters.  Several numbers of clusters are
trained together, a step of all of them in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Decimal places of a centre's coordinates.
PLACES = 9

#: Up to so many vectors a step is one task without an exchange; the centres are the same.
FEW_ROWS = 50_000


@dataclass(frozen=True)
class Centres:
    """Trained centres, in cluster order, and the cost of the start and after each step."""

    columns: tuple[str, ...]
    centres: list[tuple[float, ...]]
    costs: list[float]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the nearest centre's index, the lowest of equally near ones; NULL if a value is."""
        if not self.centres:
            return df.withColumn(out, F.lit(None).cast("int"))
        return df.withColumn(out, nearest(self.columns, self.centres)[0])

    def clusterCenters(self) -> list[tuple[float, ...]]:  # the name that models of the library have
        return self.centres


def nearest(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> tuple[Column, Column]:
    """Index of the nearest centre, and the squared distance to it, in generated code."""
    distances = []
    for centre in centres:
        gaps = [F.col(c) - F.lit(float(x)) for c, x in zip(columns, centre)]
        squares = [gap * gap for gap in gaps]
        distances.append(sum(squares[1:], squares[0]))
    least = F.least(*distances) if len(distances) > 1 else distances[0]
    index = F.coalesce(*[F.when(d == least, F.lit(i)) for i, d in enumerate(distances)])
    return index, least


def _nearest_of_each(columns: Sequence[str], trials: Sequence[Sequence[Sequence[float]]]) -> Column:
    """``nearest`` for every trial: an array of ``(least, cluster, trial)``.

    The centres are one array literal, so the code Spark compiles is the same in every step.
    """
    points = [["array(" + ", ".join(f"{x!r}D" for x in centre) + ")" for centre in centres] for centres in trials]
    literal = F.expr("array(" + ", ".join("array(" + ", ".join(p) + ")" for p in points) + ")")
    here = F.array(*columns)

    def distance(centre: Column) -> Column:
        squares = F.zip_with(here, centre, lambda x, y: (x - y) * (x - y))
        return F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)

    def of_trial(centres: Column, trial: Column) -> Column:
        return F.array_min(F.transform(centres, lambda c, i: F.struct(distance(c).alias("least"), i.alias("cluster"), trial.alias("trial"))))

    return F.transform(literal, of_trial)


def box(vectors: DataFrame, columns: Sequence[str]) -> tuple[int, list[tuple[float, float]]]:
    """The rows, and the least and greatest value of each column; none of no rows."""
    rows, *ends = vectors.agg(F.count("*"), *[f(c).cast("double") for c in columns for f in (F.min, F.max)]).first()
    return rows, list(zip(ends[::2], ends[1::2])) if rows else []


def diagonal(corners: Sequence[tuple[float, float]], k: int) -> list[tuple[float, ...]]:
    """``k`` points from the least to the greatest corner of a box; a single one is the least corner."""
    if not corners:
        return []
    return [tuple(low + (high - low) * i / max(k - 1, 1) for low, high in corners) for i in range(k)]


def _step(
    vectors: DataFrame, columns: Sequence[str], weight: str, trials: list[list[tuple[float, ...]]],
) -> list[tuple[list[tuple[float, ...]], float]]:
    """For each trial the centres one step on, and the cost of the given ones.  An empty cluster keeps its centre."""
    dealt = vectors.select(*columns, weight, F.inline(_nearest_of_each(columns, trials)))
    w = F.col(weight)
    means = [F.round(F.sum(w * F.col(c)) / F.sum(w), PLACES) for c in columns]
    found = dealt.groupBy("trial", "cluster").agg(F.sum(w * F.col("least")), *means).collect()  # a row a cluster
    out = [(list(centres), 0.0) for centres in trials]
    for trial, cluster, cost, *mean in sorted(found):
        moved, total = out[trial]
        moved[cluster] = tuple(mean)
        out[trial] = (moved, total + cost)
    return out


def train_each(vectors: DataFrame, columns: Sequence[str], ks: Sequence[int], steps: int, weight: str = "weight") -> list[Centres]:
    """``train_centres`` for every number of clusters in ``ks``, a step of all of them in one pass."""
    known = vectors.select(*[F.col(c).cast("double").alias(c) for c in columns], F.col(weight).cast("double").alias(weight))
    kept = known.dropna(subset=list(columns)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, corners = box(kept, columns)
        if not all(isfinite(end) for ends in corners for end in ends):
            raise ValueError(f"values that are not finite in {', '.join(columns)}")
        near = kept.coalesce(1) if rows <= FEW_ROWS else kept
        trials = [diagonal(corners, k) for k in ks]
        costs: list[list[float]] = [[] for _ in ks]
        moving = [n for n, centres in enumerate(trials) if centres]
        for step in range(steps + 1):
            still = []
            for n, (moved, cost) in zip(moving, _step(near, columns, weight, [trials[n] for n in moving]) if moving else []):
                costs[n].append(cost)
                if moved == trials[n]:
                    costs[n] += [cost] * (steps - step)
                elif step < steps:
                    trials[n] = moved
                    still.append(n)
            moving = still
        return [Centres(tuple(columns), centres, cost) for centres, cost in zip(trials, costs)]
    finally:
        kept.unpersist()


def train_centres(vectors: DataFrame, columns: Sequence[str], k: int, steps: int, weight: str = "weight") -> Centres:
    """At most ``steps`` steps from the diagonal; ends early once no centre moves.

    Rows with a NULL among ``columns`` do not train.  ``costs`` always has ``steps + 1`` entries: that of
    the start first, and that of the returned centres last.  No rows give no centres and no costs; a value that
    is not finite ends the job, as no mean holds it.
    """
    return train_each(vectors, columns, [k], steps, weight)[0]
