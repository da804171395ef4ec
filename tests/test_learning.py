import pytest
from conftest import rows
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tagloom.operators import clustering, learning, tagging
from tagloom.plans.all_queries import run
from tagloom.sources.models import load_or_train

SMALL = "/root/testdata/sf0.01"
COLUMNS = ["r_score", "f_score", "m_score"]


@pytest.fixture(scope="module")
def scores(spark):
    return run("rfm_scores", spark, SMALL).cache()


def rule_rows(table, first, k):
    return table([(first + i, str(i)) for i in range(k)], "tag_id bigint, rule string")


def test_every_user_gets_one_tag(spark):
    users = {"tag_rfm_value": 362, "tag_rfm_value_scaled": 362, "tag_psm_sensitivity": 373, "tag_rfm_spending_power": 390}
    for key, first in users.items():
        df = run(key, spark, SMALL)
        assert df.count() == df.select("uid").distinct().count() == 1500
        assert {r[0] for r in df.select("tag_id").distinct().collect()} <= set(range(first, first + 7))


def test_rank_zero_has_the_largest_centre(table, scores):
    vectors = clustering.cluster_vectors(scores, COLUMNS)
    model = clustering.fit_kmeans(vectors, 5, weight="weight")
    ranks = clustering.ranked_clusters(model, vectors).orderBy("rank").collect()
    sums = [r["centre_sum"] for r in ranks]
    assert sums == sorted(sums, reverse=True) and [r["rank"] for r in ranks] == list(range(5))
    rising = [r["centre_sum"] for r in clustering.ranked_clusters(model, vectors, descending=False).orderBy("rank").collect()]
    assert rising == sorted(sums)


def test_ranked_clusters_take_their_tags(table):
    ranks = table([(2, 0), (1, 1), (0, 2), (4, 3), (3, 4)], "prediction int, rank int")
    predicted = table([(u, p) for u, p in enumerate([2, 1, 0, 4, 3])], "uid bigint, prediction int")
    got = rows(clustering.cluster_tags(predicted, ranks, rule_rows(table, 362, 5)), "uid", "tag_id")
    assert got == [(i, 362 + i) for i in range(5)]


def test_equal_centre_sums_are_ordered_by_index(spark):
    class Model:
        @staticmethod
        def clusterCenters():
            return [[4.0, 4.0], [5.0, 4.002], [5.0, 6.0], [3.0, 4.0], [8.0, 0.0]]

    got = clustering.ranked_clusters(Model, spark.range(1)).orderBy("rank").collect()
    assert [r["prediction"] for r in got] == [2, 1, 0, 4, 3]


def test_counted_vectors_cost_what_the_users_cost(scores):
    vectors = clustering.cluster_vectors(scores, COLUMNS)
    model = clustering.fit_kmeans(vectors, 5, 20, weight="weight")
    users = clustering.assembled(scores, COLUMNS)
    predicted = model.transform(users).select("prediction", vector_to_array("features").alias("x"))
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    cost = 0.0
    for row in predicted.collect():
        cost += sum((a - b) ** 2 for a, b in zip(row["x"], centres[row["prediction"]]))
    assert model.summary.trainingCost == pytest.approx(cost)


def test_scaling_to_unit_range(table):
    df = table([(1.0, 5.0, 5.0, 2.0), (1.0, 3.0, 4.0, 3.0), (1.0, 2.0, 5.0, 4.0)], "a double, b double, c double, d double")
    ours = learning.minmax_columns(df, ["a", "b", "c", "d"])
    steps = clustering.feature_steps(df, ["a", "b", "c", "d"], scale=True)
    spark_rows = sorted(tuple(r[0]) for r in steps.transform(df).select(vector_to_array("features")).collect())
    assert rows(ours, "a_scaled", "b_scaled", "c_scaled", "d_scaled") == [pytest.approx(r) for r in spark_rows]
    assert rows(ours, "a_scaled")[0] == (0.5,)


@pytest.mark.parametrize("p", [1.0, 2.0, float("inf")])
def test_norms_equal_spark(table, p):
    df = table([(1.0, 0.1, -8.0), (2.0, 1.0, -4.0), (4.0, 10.0, 8.0), (0.0, 0.0, 0.0)], "a double, b double, c double")
    ours = rows(learning.normalized_columns(df, ["a", "b", "c"], p), "a_norm", "b_norm", "c_norm")
    vectors = learning.normalized_vectors(clustering.assembled(df, ["a", "b", "c"]), p=p)
    theirs = sorted((tuple(r[0]) for r in vectors.select(vector_to_array("normalized")).collect()), key=repr)
    assert ours == [pytest.approx(r) for r in theirs]


def test_metrics_equal_spark_evaluator(spark):
    df = spark.range(5000).select(
        (F.col("id") % 4).cast("double").alias("label"),
        F.when(F.col("id") % 7 < 4, F.col("id") % 4).otherwise((F.col("id") * 31) % 4).cast("double").alias("prediction"),
    )
    ours = learning.classification_metrics(df).first()
    for mine, name in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                       ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert ours[mine] == pytest.approx(theirs)
    assert ours["error_rate"] == pytest.approx(1 - ours["accuracy"])


def test_class_never_guessed(table):
    df = table([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    got = learning.classification_metrics(df).first()
    assert got["accuracy"] == pytest.approx(1 / 3) and got["weighted_precision"] == pytest.approx(1 / 9)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(10_000)
    train, test = learning.split_by_key(df, "id", 80)
    again, _ = learning.split_by_key(df.repartition(37, "id"), "id", 80)
    assert train.count() + test.count() == 10_000 and 7_700 < train.count() < 8_300
    assert rows(train) == rows(again) and train.intersect(test).count() == 0


def test_counted_rows_train_the_same_tree(spark, table):
    items = spark.range(3000).select(
        F.col("id").alias("key"), (F.col("id") % 5).cast("int").alias("colour_id"), (F.col("id") % 3).cast("int").alias("product_id"),
        (((F.col("id") % 5 == 2) | (F.col("id") % 3 == 1)) & (F.col("id") % 11 != 0)).cast("double").alias("label"),
    )
    features = ["colour_id", "product_id"]
    plain, _ = learning.tree_stages(features, maxDepth=4)
    weighted, _ = learning.tree_stages(features, weight="weight", maxDepth=4)
    counted = learning.counted_rows(items, [*features, "label"])
    assert counted.agg(F.sum("weight")).first()[0] == 3000
    combos = items.select(*features).distinct()

    def guesses(model):
        return rows(model.transform(combos), *features, "prediction")

    assert guesses(plain.fit(items)) == guesses(weighted.fit(counted))
    folds = learning.counted_rows(items, [*features, "label"], "key", 3)
    assert {r[0] for r in folds.select("fold").distinct().collect()} == {0, 1, 2}
    assert folds.agg(F.sum("weight")).first()[0] == 3000


def test_predicted_gender_follows_a_learnable_rule(spark, table):
    items = spark.range(4000).select(
        F.col("id").alias("key"), (F.col("id") % 20).alias("uid"),
        F.when(F.col("id") % 20 < 8, 1).otherwise(2).alias("colour_id"), (F.col("id") % 3).cast("int").alias("product_id"),
        F.when(F.col("id") % 20 < 8, 1).otherwise(0).alias("label"),
    )
    rules = table([(379, "0"), (380, "1"), (381, "-1")], "tag_id bigint, rule string")
    got = rows(tagging.gender_model_tag(items, rules, depths=(2,), impurities=("gini",)))
    assert got == sorted([(u, 380 if u < 8 else 379) for u in range(20)], key=repr)


def test_label_order_breaks_ties_by_label(table):
    df = table([("b",), ("b",), ("a",), ("c",), ("c",)], "v string")
    assert rows(learning.label_order(df, "v")) == [("a", 2.0), ("b", 0.0), ("c", 1.0)]


def test_label_order_equals_the_library(spark, table):
    from pyspark.ml.feature import StringIndexer

    df = spark.range(3000).select(F.concat(F.lit("v"), F.col("id") * F.col("id") % 211).alias("v"))
    model = StringIndexer(inputCol="v", outputCol="i", stringOrderType="frequencyDesc").fit(df)
    order = learning.label_order(df.unionByName(table([(None,)] * 9, "v string")), "v")
    assert rows(order) == sorted([(v, float(i)) for i, v in enumerate(model.labels)], key=repr)
    assert learning.label_order(df.limit(0), "v").count() == 0


def test_many_labels_are_ranked_in_ranges(spark):
    df = spark.range(100_000).select(F.col("id").cast("string").alias("v"))
    order = learning.label_order(df.unionByName(df.where("v LIKE '77%'")), "v").cache()
    got = order.agg(F.count("*"), F.countDistinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(got) == (100_000, 100_000, 0.0, 99_999.0)
    twice = order.where("label LIKE '77%'").agg(F.max("index"), F.count("*")).first()
    assert twice[0] == twice[1] - 1
    assert order.where("index = 0").first()["label"] == "77"


def test_labels_there_and_back(table):
    df = table([(1, "b"), (2, "b"), (3, "a"), (4, None), (5, "new")], "id int, v string")
    order = learning.label_order(df.where("id < 5"), "v")
    indexed = learning.index_labels(df, "v", order)
    assert rows(indexed, "id", "label_index") == [(1, 0.0), (2, 0.0), (3, 1.0), (4, None), (5, None)]
    assert rows(learning.labels_again(indexed, "label_index", order, "again"), "id", "again") == [
        (1, "b"), (2, "b"), (3, "a"), (4, None), (5, None)]


def test_stored_model_is_loaded(spark, scores, folder):
    vectors = clustering.cluster_vectors(scores, COLUMNS)
    calls = []

    def train():
        calls.append(1)
        return clustering.fit_kmeans(vectors, 3, weight="weight")

    first = load_or_train(spark, folder, KMeansModel, train)
    second = load_or_train(spark, folder, KMeansModel, train)
    assert len(calls) == 1
    assert [list(c) for c in first.clusterCenters()] == [list(c) for c in second.clusterCenters()]


def test_toy_points_form_their_pairs(table):
    points = [(1.0, 1.0), (1.1, 1.0), (9.0, 1.0), (9.1, 1.0), (1.0, 9.0), (1.1, 9.0), (9.0, 9.0), (9.1, 9.1)]
    df = clustering.assembled(table([(i, *p) for i, p in enumerate(points)], "id int, x double, y double"), ["x", "y"])
    model, costs = clustering.best_by_iterations(df, 4)
    predicted = dict(model.transform(df).select("id", "prediction").collect())
    assert [predicted[i] == predicted[i + 1] for i in (0, 2, 4, 6)] == [True] * 4 and len(set(predicted.values())) == 4
    by_k = clustering.cost_by_k(df, range(2, 5))
    assert [c for _, c in by_k] == sorted((c for _, c in by_k), reverse=True)
    k, score, sizes = clustering.silhouette_by_k(df, [4])[0]
    assert k == 4 and score > 0.9 and sorted(sizes) == [2, 2, 2, 2]


def test_classifiers_beat_chance(spark):
    for key, rows_expected in (("ml_logistic_regression", 500), ("ml_decision_tree", None)):
        df = run(key, spark, SMALL)
        if rows_expected:
            assert df.count() == rows_expected
        assert set(df.columns) == {"vec_id", "label", "prediction"}


def test_components_are_not_centred(spark):
    df = run("ml_pca", spark, SMALL)
    assert df.columns == ["vec_id", "pc1", "pc2", "pc3", "pc4"] and df.count() == 500
    spread = df.select([F.variance(c) for c in df.columns[1:]]).first()
    assert list(spread) == sorted(spread, reverse=True)
