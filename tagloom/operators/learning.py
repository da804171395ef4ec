"""Classifiers, feature steps and evaluation around the tag models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, Normalizer, VectorAssembler, VectorIndexer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.text import portable_hash
from tagloom.session import cut_lineage
from tagloom.small import small_table

SEED = 31


def split_by_key(df: DataFrame, key: str, train_percent: int) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key.

    Unlike a random split the result does not depend on partitioning or row order, so a lost
    executor recomputes the same rows.
    """
    place = portable_hash(key) % 100
    return df.where(place < train_percent), df.where(place >= train_percent)


def minmax_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale plain columns to [0, 1]; all bounds come from one aggregation.

    A constant column becomes 0.5.
    """
    ends = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]
    bounds = df.agg(F.struct(*ends)).scalar()
    for c in columns:
        low, high = bounds[c]["low"], bounds[c]["high"]
        shown = F.when(high == low, F.lit(0.5)).otherwise(F.try_divide(F.col(c) - low, high - low))
        df = df.withColumn(f"{c}_scaled", shown)
    return df


def norm(values: Sequence[Column], p: float) -> Column:
    """L1, L2 or L-infinity length of a row of columns."""
    sizes = [F.abs(v) for v in values]
    if p == float("inf"):
        return F.greatest(*sizes)
    if p == 1:
        return sum(sizes[1:], sizes[0])
    if p == 2:
        return F.sqrt(sum((v * v for v in values[1:]), values[0] * values[0]))
    raise ValueError(f"no norm for p={p}")


def normalized_columns(df: DataFrame, columns: Sequence[str], p: float) -> DataFrame:
    """Each column divided by the row's norm; a zero row stays zero."""
    size = norm([F.col(c) for c in columns], p)
    for c in columns:
        df = df.withColumn(f"{c}_norm", F.coalesce(F.try_divide(F.col(c), size), F.lit(0.0)))
    return df


def normalized_vectors(df: DataFrame, source: str = "features", out: str = "normalized", p: float = 2.0) -> DataFrame:
    return Normalizer(inputCol=source, outputCol=out, p=p).transform(df)


def label_order(df: DataFrame, label: str) -> DataFrame:
    """Label -> index by falling frequency, equal frequencies by label: ``(label, index)``; NULL is no label.

    The counted labels are dealt into ranges of the order and written; a label's index is its rank inside
    its range plus the labels of the ranges before.  The driver hears one count a range, never the labels.
    """
    counted = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    order = [F.desc("n"), F.asc("label")]
    ranged = counted.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    kept = cut_lineage(ranged, "labels")
    before, starts = 0, []
    for place, rows in sorted(tuple(r) for r in kept.groupBy("range").count().collect()):
        starts.append((place, before))
        before += rows
    starts = small_table(df.sparkSession, starts, "range int, before bigint")
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    ranked = kept.withColumn("inside", inside).join(starts, "range")
    return ranked.select("label", (F.col("before") + F.col("inside")).cast("double").alias("index"))


def index_labels(df: DataFrame, label: str, order: DataFrame, out: str = "label_index") -> DataFrame:
    """Rows with the index of their label in ``order``; NULL without a label, or with one that ``order`` lacks."""
    known = order.select(F.col("label").alias(label), F.col("index").alias(out))
    return df.join(known, label, "left")


def labels_again(df: DataFrame, index: str, order: DataFrame, out: str) -> DataFrame:
    """Rows with the label that an index stands for."""
    known = order.select(F.col("index").alias(index), F.col("label").alias(out))
    return df.join(known, index, "left")


def tree_stages(
    columns: Sequence[str], max_categories: int = 30, weight: str | None = None, **tree
) -> tuple[Pipeline, DecisionTreeClassifier]:
    """Assemble -> index categorical features -> decision tree."""
    classifier = DecisionTreeClassifier(
        featuresCol="features", labelCol="label", predictionCol="prediction", seed=SEED, **tree
    )
    if weight:
        classifier = classifier.setWeightCol(weight)
    stages = [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        VectorIndexer(inputCol="raw_features", outputCol="features", maxCategories=max_categories,
                      handleInvalid="keep"),
        classifier,
    ]
    return Pipeline(stages=stages), classifier


def evaluator(
    metric: str = "accuracy", label: str = "label", weight: str | None = None
) -> MulticlassClassificationEvaluator:
    out = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    return out.setWeightCol(weight) if weight else out


def tree_grid(classifier: DecisionTreeClassifier, depths=(5, 10), impurities=("gini", "entropy"), bins=(32, 64)):
    return (
        ParamGridBuilder()
        .addGrid(classifier.maxDepth, list(depths))
        .addGrid(classifier.impurity, list(impurities))
        .addGrid(classifier.maxBins, list(bins))
        .build()
    )


def grid_rows(grid) -> list[tuple[int, str, int]]:
    """(depth, impurity, bins) of each grid point, in grid order."""
    named = [{param.name: value for param, value in point.items()} for point in grid]
    return [(p["maxDepth"], p["impurity"], p["maxBins"]) for p in named]


def counted_rows(df: DataFrame, columns: Sequence[str], key: str | Sequence[str] | None = None, folds: int = 0) -> DataFrame:
    """Equal rows as one row with a ``weight``; with ``folds``, equal rows of the same fold.

    The fold is a hash of the row key and is drawn before counting, so weighted training and
    k-fold search on the counted rows give what they would give on the rows themselves.
    """
    if not folds:
        return df.groupBy(*columns).agg(F.count("*").cast("double").alias("weight"))
    keys = [key] if isinstance(key, str) else key
    fold = (portable_hash(*keys, salt=SEED) % folds).cast("int").alias("fold")
    return df.select(*columns, fold).groupBy(*columns, "fold").agg(
        F.count("*").cast("double").alias("weight")
    )


def cross_validated(
    train: DataFrame, columns: Sequence[str], folds: int = 3, fold: str | None = None,
    weight: str | None = None, **grid,
):
    """Best tree chain by k-fold grid search, with the mean metric of each grid point."""
    chain, classifier = tree_stages(columns, weight=weight)
    points = tree_grid(classifier, **grid)
    search = CrossValidator(
        estimator=chain, estimatorParamMaps=points, evaluator=evaluator(weight=weight),
        numFolds=folds, seed=SEED, parallelism=4,
    )
    fitted = (search.setFoldCol(fold) if fold else search).fit(train)
    scores = [row + (float(m),) for row, m in zip(grid_rows(points), fitted.avgMetrics)]
    return fitted.bestModel, scores


def train_validated(train: DataFrame, columns: Sequence[str], ratio: float = 0.8, **grid):
    """Best tree chain by one train/validation split."""
    chain, classifier = tree_stages(columns)
    points = tree_grid(classifier, **grid)
    search = TrainValidationSplit(
        estimator=chain, estimatorParamMaps=points, evaluator=evaluator(),
        trainRatio=ratio, seed=SEED, parallelism=4,
    )
    fitted = search.fit(train)
    scores = [row + (float(m),) for row, m in zip(grid_rows(points), fitted.validationMetrics)]
    return fitted.bestModel, scores


def confusion(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): all classification metrics follow from this small table."""
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def classification_metrics(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, error rate, weighted precision and recall, f1, from the confusion counts."""
    cells = confusion(predictions, label, prediction)
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    as_label = F.struct(F.col("label").alias("class"), n.alias("support"), hit.alias("tp"), none.alias("guessed"))
    as_guess = F.struct(F.col("prediction").alias("class"), none.alias("support"), none.alias("tp"), n.alias("guessed"))
    per_class = cells.select(F.inline(F.array(as_label, as_guess))).groupBy("class").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("guessed").alias("guessed")
    )
    per_class = per_class.select(
        "support", "tp",
        F.coalesce(F.try_divide("tp", "guessed"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("tp", "support"), F.lit(0.0)).alias("recall"),
    )
    f1 = F.coalesce(
        F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        F.lit(0.0),
    )
    total = F.sum("support")
    return per_class.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (1 - F.sum("tp") / total).alias("error_rate"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(f1 * F.col("support")) / total).alias("f1"),
    )


def naive_bayes(train: DataFrame):
    """Features must not be negative."""
    return NaiveBayes(featuresCol="features", labelCol="label").fit(train)


def logistic_regression(train: DataFrame):
    # Elastic-net strength, mix and iteration limit.
    return LogisticRegression(
        featuresCol="features", labelCol="label", regParam=0.3, elasticNetParam=0.8, maxIter=10
    ).fit(train)


def principal_components(df: DataFrame, k: int = 4, source: str = "features"):
    return PCA(k=k, inputCol=source, outputCol="components").fit(df)


def bisecting_cost_by_k(df: DataFrame, ks: Sequence[int], weight: str | None = None) -> list[tuple[int, float]]:
    kept = df.persist()
    try:
        out = []
        for k in ks:
            bisecting = BisectingKMeans(k=k, seed=SEED, featuresCol="features")
            bisecting = bisecting.setWeightCol(weight) if weight else bisecting
            out.append((k, float(bisecting.fit(kept).summary.trainingCost)))
        return out
    finally:
        kept.unpersist()
