import math
import random
from itertools import groupby

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.operators import trees
from tagloom.operators.trees import Trial, search_trees, train_trees

SCHEMA = "a double, b double, code double, label double, weight double, fold int"


def impurity(kind, labels, counted):
    total = sum(counted.values())
    shares = [counted.get(c, 0) / total for c in labels]
    return 1 - sum(s * s for s in shares) if kind == "gini" else -sum(s * math.log2(s) for s in shares if s)


def counted(data):
    out = {}
    for _, label, weight in data:
        out[label] = out.get(label, 0) + weight
    return out


def brute(data, labels, kind, depth, categorical):
    """A tree over rows of (values, label, weight) by trying every cut of every column: a prediction function."""
    here = counted(data)
    guess = min(here, key=lambda c: (-here[c], c))
    best = None
    for f in range(len(data[0][0])) if depth else ():
        def mean(v, f=f):
            mine = [(label, w) for values, label, w in data if values[f] == v]
            return sum(labels.index(label) * w for label, w in mine) / sum(w for _, w in mine) if f in categorical else 0.0

        order = sorted({values[f] for values, _, _ in data}, key=lambda v: (mean(v), v))
        for n in range(1, len(order)):
            left = [r for r in data if r[0][f] in order[:n]]
            right = [r for r in data if r[0][f] not in order[:n]]
            sizes = sum(r[2] for r in left), sum(r[2] for r in right)
            after = sum(s * impurity(kind, labels, counted(side)) for s, side in zip(sizes, (left, right))) / sum(sizes)
            gain = round(impurity(kind, labels, here) - after, trees.PLACES)
            if gain > 0 and (best is None or gain > best[0]):
                goes = (lambda x, s=set(order[:n]): x in s) if f in categorical else (lambda x, t=order[n - 1]: x <= t)
                best = gain, f, goes, left, right
    if best is None:
        return lambda values: guess
    _, f, goes, left, right = best
    sides = [brute(side, labels, kind, depth - 1, categorical) for side in (left, right)]
    return lambda values: sides[0 if goes(values[f]) else 1](values)


def drawn(n, seed):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a, b, code = float(draw.randrange(9)), draw.choice([None, 1.0, 2.0, 5.0]), draw.choice([None, 7.0, 3.0, 11.0, 2.0])
        label = float((a > 4) + (b is None or code in (7.0, 2.0) and b == 1.0)) if draw.random() < 0.9 else float(draw.randrange(3))
        out.append((a, b, code, label, float(draw.randrange(1, 4)), i % 3))
    return out


def seen(row, bins):
    a, b, code = row[:3]
    return (min(math.floor(a / 8 * bins), bins - 1), -1 if b is None else min(math.floor((b - 1) / 4 * bins), bins - 1), -math.inf if code is None else code)


@pytest.mark.parametrize("kind,bins", [("gini", 32), ("entropy", 4)])
def test_equals_a_search_over_every_cut(table, kind, bins):
    data = drawn(160, 5)
    data[0], data[1] = (0.0, 1.0, *data[0][2:]), (8.0, 5.0, *data[1][2:])  # both ends occur
    df = table(data, SCHEMA)
    (whole, part), _ = train_trees(df, ["a", "b", "code"], [Trial(kind, bins), Trial(kind, bins, 1)], 3, ["code"], weight="weight", fold="fold")
    for tree, left_out in ((whole, None), (part, 1)):
        train = [(seen(r, bins), r[3], r[4]) for r in data if r[5] != left_out]
        expected = brute(train, [0.0, 1.0, 2.0], kind, 3, {2})
        got = [r["prediction"] for r in tree.transform(df.coalesce(1)).collect()]
        assert got == [expected(seen(r, bins)) for r in data]


def test_a_shallower_tree_is_the_top_of_a_deeper_one(table):
    df = table(drawn(120, 8), SCHEMA)
    (deep,), _ = train_trees(df, ["a", "code"], [Trial()], 4, ["code"])
    (flat,), _ = train_trees(df, ["a", "code"], [Trial()], 1, ["code"])
    assert rows(deep.transform(df, depth=1)) == rows(flat.transform(df)) and deep.height() > 1 == flat.height()


def test_the_same_tree_under_any_partitioning(table, monkeypatch):
    df = table(drawn(200, 3), SCHEMA)
    few, _ = train_trees(df, ["a", "b", "code"], [Trial("entropy")], 4, ["code"], weight="weight")
    monkeypatch.setattr(trees, "FEW_VALUES", 0)
    many, _ = train_trees(df.repartition(13), ["a", "b", "code"], [Trial("entropy")], 4, ["code"], weight="weight")
    assert few == many


def test_weights_count_as_repeated_rows(table):
    data = drawn(60, 4)
    repeated = [r for r in data for _ in range(int(r[4]))]
    one, _ = train_trees(table(data, SCHEMA), ["a", "code"], [Trial()], 3, ["code"], weight="weight")
    other, _ = train_trees(table(repeated, SCHEMA), ["a", "code"], [Trial()], 3, ["code"])
    assert one == other


def test_search_takes_the_first_of_equally_good_points_and_trains_it_on_all_rows(table):
    data = [(float(i % 8), None, 0.0, float(i % 8 > 3), 1.0, i // 8 % 3) for i in range(48)]
    tree, depth, scores = search_trees(table(data, SCHEMA), ["a"], range(3), (1, 3), ("gini", "entropy"), (8,))
    assert scores == [(1, "gini", 8, 1.0), (1, "entropy", 8, 1.0), (3, "gini", 8, 1.0), (3, "entropy", 8, 1.0)]
    assert depth == 1 and tree.trial == Trial("gini", 8) and sum(tree.nodes[0].counts) == 48


def test_accuracy_on_the_left_out_fold(table):
    data = [(1.0, None, 0.0, 0.0, 1.0, 0), (2.0, None, 0.0, 1.0, 1.0, 0), (1.0, None, 0.0, 0.0, 3.0, 1), (2.0, None, 0.0, 0.0, 1.0, 1)]
    _, found = train_trees(table(data, SCHEMA), ["a"], [Trial(left_out=1), Trial(left_out=9)], 2, weight="weight", fold="fold", depths=(2,))
    assert found == {(0, 2): 0.75, (1, 2): None}


def test_no_rows_no_labels_and_single_classes(table):
    for data in ([], [(1.0, 1.0, 1.0, None, 1.0, 0)]):
        (tree,), found = train_trees(table(data, SCHEMA), ["a", "code"], [Trial()], 2, ["code"], depths=(1,))
        assert {r["prediction"] for r in tree.transform(table([(1.0, 1.0, 1.0, 0.0, 1.0, 0)], SCHEMA)).collect()} == {None}
        assert found == {(0, 1): None}
    (tree,), _ = train_trees(table([(None, 1.0, None, 4.0, 1.0, 0)], SCHEMA), ["a", "code"], [Trial()], 2, ["code"])
    assert tree.height() == 0 and tree.transform(table([(1.0, 1.0, 1.0, 0.0, 1.0, 0)], SCHEMA)).first()["prediction"] == 4.0


def test_unseen_and_missing_values(table):
    data = [(None, 1.0, 1.0, 0.0, 1.0, 0), (2.0, 1.0, 1.0, 1.0, 1.0, 0), (9.0, 1.0, 2.0, 1.0, 1.0, 0)]
    (tree,), _ = train_trees(table(data, SCHEMA), ["a"], [Trial()], 2)
    asked = table([(v, 1.0, 1.0, 0.0, 1.0, 0) for v in (None, float("nan"), -50.0, 99.0)], SCHEMA)
    assert [r["prediction"] for r in tree.transform(asked.coalesce(1)).collect()] == [0.0, 0.0, 1.0, 1.0]


def test_refuses_what_it_cannot_hold(spark, table):
    df = spark.range(3000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 40).cast("double").alias("many"), (F.col("id") % 2).cast("double").alias("label"))
    with pytest.raises(ValueError, match="classes"):
        train_trees(df, ["a"], [Trial()], 2, label="many")
    with pytest.raises(ValueError, match="categories"):
        train_trees(df, ["a"], [Trial()], 2, ["a"])
    with pytest.raises(ValueError, match="depth"):
        train_trees(df, ["a"], [Trial()], 40)
    with pytest.raises(ValueError, match="finite"):
        train_trees(table([(float("inf"), 1.0, 1.0, 1.0, 1.0, 0)], SCHEMA), ["a"], [Trial()], 2)
