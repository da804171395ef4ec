"""KMeans from a fixed start against plain loops and against the library's KMeans."""

import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from tagloom.operators import centres, clustering
from tagloom.plans.all_queries import run

SMALL = "/root/testdata/sf0.01"
COLUMNS = ["r_score", "f_score", "m_score"]


def plain_steps(points, k, steps):
    """Centres and costs of weighted points ``(x, …, w)``."""
    width = len(points[0]) - 1
    ends = [(min(p[j] for p in points), max(p[j] for p in points)) for j in range(width)]
    found = [tuple(lo + (hi - lo) * i / max(k - 1, 1) for lo, hi in ends) for i in range(k)]
    costs = []
    for step in range(steps + 1):
        dealt = [min((sum((p[j] - c[j]) ** 2 for j in range(width)), i) for i, c in enumerate(found)) for p in points]
        costs.append(sum(d * p[-1] for (d, _), p in zip(dealt, points)))
        if step < steps:
            for i in range(k):
                mine = [p for (_, at), p in zip(dealt, points) if at == i]
                if mine:
                    total = sum(p[-1] for p in mine)
                    found[i] = tuple(round(sum(p[j] * p[-1] for p in mine) / total, centres.PLACES) for j in range(width))
    return found, costs


@pytest.mark.parametrize("k", [1, 2, 5, 9])
def test_steps_against_a_plain_loop(table, k):
    rng = random.Random(k)
    points = [(rng.randrange(-4, 6), rng.random() * 3, float(rng.randrange(1, 9))) for _ in range(120)]
    frame = table([tuple(map(float, p)) for p in points], "a double, b double, weight double").repartition(7)
    model = centres.train_centres(frame, ["a", "b"], k, 8)
    expected, costs = plain_steps(points, k, 8)
    assert [pytest.approx(c, abs=1e-8) for c in expected] == model.centres
    assert model.costs == [pytest.approx(c) for c in costs] and len(model.costs) == 9
    assert all(b <= a + 1e-6 for a, b in zip(model.costs, model.costs[1:]))


def test_partitions_do_not_matter(spark):
    scores = run("rfm_scores", spark, SMALL).withColumn("weight", F.lit(1.0))
    one = centres.train_centres(scores.coalesce(1), COLUMNS, 6, 10)
    many = centres.train_centres(scores.repartition(13, "uid"), COLUMNS, 6, 10)
    counted = centres.train_centres(clustering.score_vectors(scores, COLUMNS), COLUMNS, 6, 10)
    assert one.centres == many.centres == counted.centres
    assert one.costs == pytest.approx(counted.costs)


def test_one_task_and_many_give_the_same(spark, monkeypatch):
    scores = run("rfm_scores", spark, SMALL).withColumn("weight", F.lit(1.0)).repartition(9, "uid")
    near = centres.train_centres(scores, COLUMNS, 5, 10)
    monkeypatch.setattr(centres, "FEW_ROWS", 10)
    assert centres.train_centres(scores, COLUMNS, 5, 10).centres == near.centres


def test_no_worse_than_sampled_starts_by_much(spark):
    vectors = clustering.cluster_vectors(run("rfm_scores", spark, SMALL), COLUMNS)
    ours = centres.train_centres(vectors, COLUMNS, 5, 20).costs[-1]
    assert ours <= 1.25 * clustering.fit_kmeans(vectors, 5, 20, weight="weight").summary.trainingCost


def test_trials_together_are_the_trials_alone(table):
    frame = table([(float(i * i % 17), 1.0) for i in range(50)], "x double, weight double")
    together = centres.train_each(frame, ["x"], [2, 3, 7], 6)
    assert together == [centres.train_centres(frame, ["x"], k, 6) for k in (2, 3, 7)]


def test_ties_nulls_empty_clusters_and_empty_tables(table):
    model = centres.Centres(("x",), [(0.0,), (2.0,), (2.0,)], [])
    frame = table([(1, 0.0), (2, 1.0), (3, 2.0), (4, None)], "uid bigint, x double")
    assert rows(model.transform(frame), "uid", "prediction") == [(1, 0), (2, 0), (3, 1), (4, None)]
    weighted = table([(0.0, 5.0), (10.0, 5.0), (None, 1.0)], "x double, weight double")
    assert centres.train_centres(weighted, ["x"], 3, 4).centres == [(0.0,), (5.0,), (10.0,)]
    same = centres.train_centres(table([(3.0, 2.0)] * 4, "x double, weight double"), ["x"], 2, 3)
    assert same.centres == [(3.0,), (3.0,)] and same.costs == [0.0] * 4
    none = centres.train_centres(table([], "x double, weight double"), ["x"], 3, 4)
    assert none.centres == [] and none.costs == []
    assert none.transform(frame).where("prediction IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        centres.train_centres(table([(float("inf"), 1.0)], "x double, weight double"), ["x"], 2, 2)


def test_a_null_score_ends_the_job(table):
    rules = table([(1, "0"), (2, "1")], "tag_id bigint, rule string")
    scores = table([(1, 1.0), (2, 5.0), (3, None)], "uid bigint, x double")
    with pytest.raises(Exception):
        clustering.fixed_start_tag(scores, ["x"], rules, 2).collect()
    assert rows(clustering.fixed_start_tag(scores.dropna(), ["x"], rules, 2)) == [(1, 2), (2, 1)]


def test_prediction_needs_no_exchange(spark):
    model = centres.Centres(("id",), [(0.0,), (50.0,)], [])
    plan = plan_text(model.transform(spark.range(100)))
    assert "Exchange" not in plan and "Join" not in plan
