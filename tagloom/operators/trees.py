"""Decision trees by exhaustive search over split histograms.

A level of every tree in training is one aggregation: a task hands on one row for each trial, open
node, column and value (or bin) with the weight of each class, so nothing it sends grows with the rows
and a value that most rows share is no hot key.  The ordered histogram gives the impurity after every
cut; the driver hears one row an open node, its best cut.  Grid points and left-out folds are trials of
the same passes, and a shallower tree is the top of a deeper one, so depths cost nothing extra.

Nothing is sampled: bins are equally wide between the ends of a column, gains are rounded to ``PLACES``
and equal ones go to the earlier column, then to the earlier cut.  The same rows give the same tree
under any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from math import isfinite

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Decimal places of an information gain and of an accuracy.
PLACES = 9

#: More classes, more values of a categorical column or a deeper tree end the job: a histogram holds
#: a row for each value of each open node.
MOST_CLASSES = 32
MOST_CATEGORIES = 1_000
MOST_DEPTH = 12

#: Up to so many values, of all rows, columns and trials, a level is one task without an exchange; the tree is the same.
FEW_VALUES = 50_000

#: What stands for a missing value: before every bin, and before every category.
NO_BIN, NO_CATEGORY = -1.0, float("-inf")


@dataclass(frozen=True)
class Trial:
    """One tree to train: ``left_out`` is the fold whose rows do not train it."""

    impurity: str = "gini"
    bins: int = 32
    left_out: int | None = None

    def __post_init__(self):
        if self.impurity not in ("gini", "entropy") or self.bins < 2:
            raise ValueError(f"no tree with impurity {self.impurity} and {self.bins} bins")


@dataclass
class Node:
    counts: list[float]  # weight of each class
    column: int = -1  # none: a leaf
    threshold: float | None = None  # the last bin that goes left
    left: list[float] = field(default_factory=list)  # the categories that go left
    child: int = 0  # the left one; the right one follows it


@dataclass(frozen=True)
class Frame:
    """How rows become values: the ends of numeric columns, none for a categorical one."""

    columns: tuple[str, ...]
    ends: tuple[tuple[float, float] | None, ...]
    classes: tuple[float, ...]

    def values(self) -> Column:
        """Categories as they are, numbers as their place between the ends, from 0 to 1."""
        out = []
        for name, ends in zip(self.columns, self.ends):
            x = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
            if ends is None:
                out.append(F.coalesce(x, F.lit(NO_CATEGORY)))
            else:
                low, high = ends
                place = (x - F.lit(low)) / F.lit(high - low) if high > low else x * 0.0
                inside = F.least(F.greatest(place, F.lit(0.0)), F.lit(1.0))  # these two pass over NULL
                out.append(F.when(place.isNull(), F.lit(NO_BIN)).otherwise(inside))
        return F.array(*out)

    def binned(self, values: Column, bins: int) -> Column:
        categorical = [i for i, ends in enumerate(self.ends) if ends is None]

        def one(x: Column, i: Column) -> Column:
            bin_of = F.when(x < 0, F.lit(NO_BIN)).otherwise(F.least(F.floor(x * F.lit(float(bins))).cast("double"), F.lit(bins - 1.0)))
            return F.when(i.isin(categorical), x).otherwise(bin_of) if categorical else bin_of

        return F.transform(values, one)


@dataclass(frozen=True)
class Tree:
    frame: Frame
    trial: Trial
    nodes: list[Node]

    def node(self, values: Column, depth: int = MOST_DEPTH) -> Column:
        """The node that binned ``values`` reach after at most ``depth`` steps."""
        column = _array("int", [n.column for n in self.nodes])
        child = _array("int", [n.child for n in self.nodes])
        threshold = _array("double", [n.threshold for n in self.nodes])
        left = _array("array<double>", [n.left for n in self.nodes])

        def step(at: Column, _: Column) -> Column:
            x = F.get(values, F.get(column, at))
            goes_left = F.coalesce(x <= F.get(threshold, at), F.array_contains(F.get(left, at), x))
            down = F.get(child, at) + F.when(goes_left, 0).otherwise(1)
            return F.when(F.get(column, at) < 0, at).otherwise(down)

        steps = min(depth, self.height())
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0), step) if steps else F.lit(0)

    def height(self) -> int:
        """Steps to the deepest node; a child comes after its parent."""
        heights = [0] * len(self.nodes)
        for at, node in enumerate(self.nodes):
            if node.column >= 0:
                heights[node.child] = heights[node.child + 1] = heights[at] + 1
        return max(heights, default=0)

    def guess(self, values: Column, depth: int = MOST_DEPTH) -> Column:
        """The heaviest class of the node, the least of equally heavy ones; NULL of a tree without rows."""
        if not self.nodes:
            return F.lit(None).cast("double")
        heaviest = [self.frame.classes[n.counts.index(max(n.counts))] for n in self.nodes]
        return F.get(_array("double", heaviest), self.node(values, depth))

    def transform(self, df: DataFrame, out: str = "prediction", depth: int = MOST_DEPTH) -> DataFrame:
        binned = F.array(self.frame.binned(self.frame.values(), self.trial.bins))
        return df.withColumn(out, F.transform(binned, lambda values: self.guess(values, depth))[0])  # binds the values once


def _text(value, kind: str) -> str:
    if kind.startswith("array<"):
        return f"cast(array({', '.join(_text(v, kind[6:-1]) for v in value)}) as {kind})"
    if value is None:
        return f"cast(null as {kind})"
    return f"double('{value!r}')" if kind == "double" else str(value).lower()


def _array(kind: str, values: Sequence) -> Column:
    """A literal array; one text to parse, and a constant in the plan."""
    return F.expr(_text(values, f"array<{kind}>"))


def frame_of(rows: DataFrame, columns: Sequence[str], categorical: Sequence[str] = (), label: str = "label") -> Frame:
    """Ends, checked categories and classes of the rows, from one aggregation each."""
    labels = sorted(r[0] for r in rows.select(F.col(label).cast("double")).dropna().distinct().limit(MOST_CLASSES + 1).collect())
    if len(labels) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    if not labels:
        return Frame(tuple(columns), tuple(None if c in categorical else (0.0, 0.0) for c in columns), ())
    asked = []
    for c in columns:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        asked += [F.approx_count_distinct(x), F.lit(0)] if c in categorical else [F.min(x), F.max(x)]
    found = rows.where(F.col(label).isNotNull()).agg(*[a.alias(str(i)) for i, a in enumerate(asked)]).first()
    ends = []
    for i, c in enumerate(columns):
        low, high = found[2 * i], found[2 * i + 1]
        if c in categorical:
            if low > MOST_CATEGORIES:  # a count within a few per cent, as only the cost depends on it
                raise ValueError(f"more than about {MOST_CATEGORIES} categories in {c}")
            ends.append(None)
        else:
            low, high = (0.0, 0.0) if low is None else (low, high)
            if not isfinite(low) or not isfinite(high):
                raise ValueError(f"values that are not finite in {c}")
            ends.append((low, high))
    return Frame(tuple(columns), tuple(ends), tuple(labels))


def impurity_of(kind: str, counts: Sequence[Column], total: Column) -> Column:
    """Gini index or entropy in bits of class weights; the classes are added in their order."""
    if kind == "gini":
        squares = [c * c for c in counts]
        return F.lit(1.0) - sum(squares[1:], squares[0]) / (total * total)
    bits = [F.when(c > 0, c / total * F.log2(c / total)).otherwise(F.lit(0.0)) for c in counts]
    return F.lit(0.0) - sum(bits[1:], bits[0])


def _best_cuts(base: DataFrame, frame: Frame, trees: Sequence[Tree], opened: Sequence[set[int]]) -> list:
    """For each trial and open node its class weights and best cut, as rows."""
    kinds = range(len(frame.classes))
    placed = []
    for n, tree in enumerate(trees):
        values = F.col(f"binned{tree.trial.bins}")
        placed.append(F.struct(F.lit(n).alias("trial"), tree.node(values).alias("node"), values.alias("binned")))
    flags = _array("array<boolean>", [[i in nodes for i in range(len(tree.nodes))] for tree, nodes in zip(trees, opened)])
    left_out = _array("int", [tree.trial.left_out for tree in trees])

    def trains(at: Column) -> Column:
        return F.get(F.get(flags, at["trial"]), at["node"]) & ~F.get(left_out, at["trial"]).eqNullSafe(F.coalesce(F.col("fold"), F.lit(-1)))

    dealt = base.select("kind", "weight", F.inline(F.filter(F.array(*placed), trains)))
    cells = dealt.select("kind", "weight", "trial", "node", F.posexplode("binned").alias("f", "v")).groupBy("trial", "node", "f", "v").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("weight")).otherwise(F.lit(0.0))).alias(f"c{k}") for k in kinds]
    )
    counts = [F.col(f"c{k}") for k in kinds]
    categorical = [i for i, ends in enumerate(frame.ends) if ends is None]
    mean = sum((c * float(k) for k, c in zip(kinds, counts)), F.lit(0.0)) / sum(counts[1:], counts[0])
    order = F.when(F.col("f").isin(categorical), mean).otherwise(F.lit(0.0)) if categorical else F.lit(0.0)
    column = Window.partitionBy("trial", "node", "f")
    ordered = column.orderBy("order", "v")
    ranked = cells.withColumn("order", order).select(
        "trial", "node", "f", "v", F.row_number().over(ordered).alias("rank"),
        *[F.sum(c).over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias(f"l{k}") for k, c in zip(kinds, counts)],
        *[F.sum(c).over(column).alias(f"t{k}") for k, c in zip(kinds, counts)],
    )
    left, total = [F.col(f"l{k}") for k in kinds], [F.col(f"t{k}") for k in kinds]
    sides = {"n_left": sum(left[1:], left[0]), "n": sum(total[1:], total[0])} | {f"r{k}": t - l for k, l, t in zip(kinds, left, total)}
    ranked = ranked.withColumns(sides).withColumn("n_right", F.col("n") - F.col("n_left"))
    right = [F.col(f"r{k}") for k in kinds]
    n_left, n_right, n = F.col("n_left"), F.col("n_right"), F.col("n")

    def gain(kind: str) -> Column:
        after = n_left * impurity_of(kind, left, n_left) + n_right * impurity_of(kind, right, n_right)
        return F.when(n_right > 0, F.round(impurity_of(kind, total, n) - after / n, PLACES))

    entropy = [i for i, tree in enumerate(trees) if tree.trial.impurity == "entropy"]
    gained = gain("gini") if not entropy else F.when(F.col("trial").isin(entropy), gain("entropy")).otherwise(gain("gini"))
    cut = F.struct(gained.alias("gain"), (-F.col("rank")).alias("back"), F.col("v").alias("v"), F.array(*left).alias("left"))
    per_column = ranked.select("trial", "node", "f", "rank", "v", cut.alias("cut"), F.array(*total).alias("total")).groupBy("trial", "node", "f").agg(
        F.max("cut").alias("cut"), F.any_value("total").alias("total"), F.collect_list(F.struct("rank", "v")).alias("values")
    )
    going = F.transform(F.filter("values", lambda x: x["rank"] <= -F.col("cut.back")), lambda x: x["v"])
    categories = F.when(F.col("f").isin(categorical), going) if categorical else F.lit(None).cast("array<double>")
    best = F.struct(F.col("cut.gain").alias("gain"), (-F.col("f")).alias("back"), F.col("cut.v").alias("v"), F.col("cut.left").alias("left"), categories.alias("going"))
    return per_column.groupBy("trial", "node").agg(F.max(best).alias("best"), F.any_value("total").alias("total")).collect()  # a row an open node


def _prepared(rows: DataFrame, frame: Frame, bins: set[int], label: str, weight: str | None, fold: str | None) -> DataFrame:
    """``kind, weight, fold`` and the binned values for each number of bins."""
    kind = F.array_position(_array("double", frame.classes), F.col(label).cast("double")).cast("int") - 1
    known = rows.where(F.col(label).isNotNull()).select(
        kind.alias("kind"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
        (F.col(fold).cast("int") if fold else F.lit(None).cast("int")).alias("fold"), frame.values().alias("values"),
    )
    binned = [frame.binned(F.col("values"), b).alias(f"binned{b}") for b in sorted(bins)]
    return known.where(F.col("weight") > 0).select("kind", "weight", "fold", *binned)


def train_trees(
    rows: DataFrame, columns: Sequence[str], trials: Sequence[Trial], depth: int, categorical: Sequence[str] = (),
    label: str = "label", weight: str | None = None, fold: str | None = None, depths: Sequence[int] = (),
) -> tuple[list[Tree], dict[tuple[int, int], float | None]]:
    """A tree for each trial, and the accuracy of trial and depth for each of ``depths``.

    Accuracy is that on the fold a trial leaves out, or on all rows if it leaves none out; None if there are no such rows.
    Rows without a label, or without a positive weight, neither train nor count.  A missing
    number goes before all bins, a missing category is one of its own; a category that a node has not
    seen goes right.  Categories are ordered by their mean class, which finds the best cut of two
    classes and a good one of more.  No rows give trees that predict NULL.
    """
    if not 0 <= depth <= MOST_DEPTH:
        raise ValueError(f"no tree of depth {depth}")
    frame = frame_of(rows, columns, categorical, label)
    if not frame.classes:
        return [Tree(frame, t, []) for t in trials], {(i, d): None for i in range(len(trials)) for d in depths}
    base = _prepared(rows, frame, {t.bins for t in trials}, label, weight, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        near = base.coalesce(1) if base.count() * len(columns) * len(trials) <= FEW_VALUES else base
        trees = [Tree(frame, t, [Node([0.0] * len(frame.classes))]) for t in trials]
        opened = [{0} for _ in trials]
        for level in range(max(depth, 1)):
            found = _best_cuts(near, frame, trees, opened)
            opened = [set() for _ in trials]
            for row in sorted(found, key=lambda r: (r["trial"], r["node"])):
                nodes, best, total = trees[row["trial"]].nodes, row["best"], list(row["total"])
                node = nodes[row["node"]]
                node.counts = total
                if depth == 0 or best["gain"] is None or best["gain"] <= 0:
                    continue
                node.column, node.child = -best["back"], len(nodes)
                if best["going"] is None:
                    node.threshold = best["v"]
                else:
                    node.left = sorted(best["going"])
                sides = list(best["left"]), [t - l for t, l in zip(total, best["left"])]
                nodes.extend(Node(side) for side in sides)
                opened[row["trial"]] |= {node.child + i for i, side in enumerate(sides) if sum(c > 0 for c in side) > 1}
            if not any(opened):
                break
        trees = [t if sum(t.nodes[0].counts) else Tree(frame, t.trial, []) for t in trees]
        return trees, _accuracies(near, frame, trees, depths) if depths else {}
    finally:
        base.unpersist()


def _accuracies(base: DataFrame, frame: Frame, trees: Sequence[Tree], depths: Sequence[int]) -> dict[tuple[int, int], float | None]:
    known = _array("double", frame.classes)
    guesses = []
    for n, tree in enumerate(trees):
        values = F.col(f"binned{tree.trial.bins}")
        asked = F.lit(True) if tree.trial.left_out is None else F.col("fold").eqNullSafe(F.lit(tree.trial.left_out))
        for depth in depths:
            hit = F.coalesce(tree.guess(values, depth) == F.get(known, F.col("kind")), F.lit(False))
            guesses.append(F.when(asked, F.struct(F.lit(n).alias("trial"), F.lit(depth).alias("depth"), hit.alias("hit"))))
    dealt = base.select("weight", F.inline(F.array_compact(F.array(*guesses))))
    share = F.sum(F.when(F.col("hit"), F.col("weight")).otherwise(F.lit(0.0))) / F.sum("weight")
    found = {(t, d): a for t, d, a in dealt.groupBy("trial", "depth").agg(share).collect()}
    return {(n, d): found.get((n, d)) for n in range(len(trees)) for d in depths}


def search_trees(
    rows: DataFrame, columns: Sequence[str], left_out: Sequence[int], depths: Sequence[int], impurities: Sequence[str] = ("gini",),
    bins: Sequence[int] = (32,), categorical: Sequence[str] = (), label: str = "label", weight: str | None = None, fold: str = "fold",
) -> tuple[Tree, int, list[tuple[int, str, int, float]]]:
    """The tree of the best grid point, its depth, and ``(depth, impurity, bins, accuracy)`` of every point.

    A point's accuracy is the mean over the left-out folds that hold rows, rounded; the first of equally good
    points wins and is the tree of all rows.  All points and folds train in the same passes.
    """
    pairs = [(i, b) for i in impurities for b in bins]
    trials = [Trial(i, b, out) for i, b in pairs for out in [*left_out, None]]
    trees, found = train_trees(rows, columns, trials, max(depths), categorical, label, weight, fold, depths)
    scores, per = [], len(left_out) + 1
    for d in depths:
        for n, (i, b) in enumerate(pairs):
            known = [a for a in (found[n * per + f, d] for f in range(len(left_out))) if a is not None]
            scores.append((d, i, b, round(sum(known) / len(known), PLACES) if known else 0.0))
    best = max(scores, key=lambda s: s[3])  # the first of equals
    return trees[pairs.index(best[1:3]) * per + per - 1], best[0], scores
