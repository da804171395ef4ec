"""KMeans tag models.

Score vectors take few distinct values (5 x 5 x 5 at most), so users are grouped by vector and the
vectors are clustered with their user counts as weights.  Training then costs the same for a
thousand users and for a billion.  Prediction runs over the users themselves, row by row on the
JVM, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tagloom.bounds import small_copy
from tagloom.operators.centres import train_centres
from tagloom.operators.joins import match_values
from tagloom.session import cut_lineage
from tagloom.small import small_table

SEED = 31


def score_vectors(scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct score vectors with the number of users that have each."""
    return scores.groupBy(*columns).agg(F.count("*").cast("double").alias("weight"))


def assembled(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error").transform(df)


def fit_kmeans(
    df: DataFrame, k: int, max_iter: int = 10, distance: str = "euclidean", weight: str | None = None,
) -> KMeansModel:
    kmeans = KMeans(
        k=k, maxIter=max_iter, initMode="k-means||", seed=SEED, distanceMeasure=distance,
        featuresCol="features", predictionCol="prediction",
    )
    if weight:
        kmeans = kmeans.setWeightCol(weight)
    return kmeans.fit(df)


def best_by_iterations(
    df: DataFrame, k: int, max_iters: Sequence[int] = (5, 15, 20), weight: str | None = None,
) -> tuple[KMeansModel, list[tuple[int, float]]]:
    """Train once per iteration limit; keep the model with the lowest cost."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = [(n, fit_kmeans(kept, k, n, weight=weight)) for n in max_iters]
        costs = [(n, model.summary.trainingCost) for n, model in fits]
        best = min(range(len(fits)), key=lambda i: costs[i][1])
        return fits[best][1], costs
    finally:
        kept.unpersist()


def cost_by_k(df: DataFrame, ks: Sequence[int], weight: str | None = None) -> list[tuple[int, float]]:
    """Within-cluster cost for each ``k``."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [(k, fit_kmeans(kept, k, weight=weight).summary.trainingCost) for k in ks]
    finally:
        kept.unpersist()


def silhouette_by_k(
    df: DataFrame, ks: Sequence[int], distance: str = "euclidean", max_iter: int = 20,
) -> list[tuple[int, float, list[int]]]:
    """Silhouette and cluster sizes for each ``k``."""
    evaluator = ClusteringEvaluator(
        featuresCol="features", predictionCol="prediction", metricName="silhouette",
        distanceMeasure="squaredEuclidean" if distance == "euclidean" else "cosine",
    )
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = []
        for k in ks:
            model = fit_kmeans(kept, k, max_iter, distance)
            score = evaluator.evaluate(model.transform(kept))
            out.append((k, float(score), [int(n) for n in model.summary.clusterSizes]))
        return out
    finally:
        kept.unpersist()


def ranked_clusters(model: KMeansModel, df: DataFrame, descending: bool = True) -> DataFrame:
    """``ranked_centres`` of a trained model."""
    return ranked_centres(df.sparkSession, model.clusterCenters(), descending)


def ranked_centres(spark: SparkSession, centres: Sequence[Sequence[float]], descending: bool = True) -> DataFrame:
    """``(prediction, centre_sum, rank)``: rank 0 has the largest (or smallest) sum of centre coordinates.

    Equal sums are ordered by cluster index.  The table has one row a cluster.
    """
    rows = [(i, float(sum(c))) for i, c in enumerate(centres)]
    rows.sort(key=lambda r: (-r[1] if descending else r[1], r[0]))
    table = [(i, total, rank) for rank, (i, total) in enumerate(rows)]
    return small_table(spark, table, "prediction int, centre_sum double, rank int")


def cluster_sizes(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy("prediction").agg(F.count("*").alias("n"))


def cluster_tags(predicted: DataFrame, ranks: DataFrame, rules: DataFrame) -> DataFrame:
    """Prediction -> rank of its cluster -> the tag whose rule is that rank.

    A rank without a rule, or a prediction without a rank, ends the job: no user is lost.
    """
    ranked = predicted.join(small_copy(ranks.select("prediction", "rank")) or ranks.select("prediction", "rank"), "prediction", "left")
    return match_values(ranked, "rank", rules, unmatched="fail").select("uid", "tag_id")


def feature_steps(vectors: DataFrame, columns: Sequence[str], scale: bool = False) -> PipelineModel:
    """Assembling, and min-max scaling if asked for, fitted on the distinct vectors."""
    if not scale:
        stages = [VectorAssembler(inputCols=list(columns), outputCol="features")]
    else:
        stages = [
            VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
            MinMaxScaler(inputCol="raw_features", outputCol="features"),
        ]
    return Pipeline(stages=stages).fit(vectors)


def cluster_vectors(scores: DataFrame, columns: Sequence[str], scale: bool = False) -> DataFrame:
    """Distinct score vectors as ``features`` with their ``weight``, ready for training.

    They are written first: training passes over them many times, and reading the few rows back
    takes a few tasks, where a shuffle's result would have as many tasks as it has partitions.
    """
    grouped = cut_lineage(score_vectors(scores, columns), "vectors")
    return feature_steps(grouped, columns, scale).transform(grouped)


def score_cluster_tag(
    scores: DataFrame, columns: Sequence[str], rules: DataFrame, k: int, max_iter: int = 10,
    scale: bool = False, make_model: Callable[[DataFrame], KMeansModel] | None = None,
    keep: Callable[[Callable[[], PipelineModel]], PipelineModel] | None = None, compress: bool = True,
) -> DataFrame:
    """Scores -> clusters -> ranked clusters -> tags.

    Scores are written once, so that training and prediction do not both go back to the business
    data.  ``make_model`` replaces the plain fit.  ``keep`` takes the training of the whole chain,
    scaling included, and may return a stored one instead.  Without ``compress`` every user trains
    as a vector of its own, which is right for continuous scores that hardly ever repeat.
    """
    kept = cut_lineage(scores.select("uid", *columns), "scores")

    def train() -> PipelineModel:
        grouped = cut_lineage(score_vectors(kept, columns), "vectors") if compress else kept.withColumn("weight", F.lit(1.0))
        steps = feature_steps(grouped, columns, scale)
        vectors = steps.transform(grouped)
        model = make_model(vectors) if make_model else fit_kmeans(vectors, k, max_iter, weight="weight")
        return PipelineModel(stages=[*steps.stages, model])

    chain = keep(train) if keep else train()
    predicted = chain.transform(kept).select("uid", "prediction")
    return cluster_tags(predicted, ranked_clusters(chain.stages[-1], kept), rules)


def fixed_start_tag(
    scores: DataFrame, columns: Sequence[str], rules: DataFrame, k: int, steps: int = 10, compress: bool = True,
) -> DataFrame:
    """``score_cluster_tag`` with clusters from a fixed start, so the same scores always give the same tags.

    A user with a NULL score ends the job, as a rank without a rule does.
    """
    kept = cut_lineage(scores.select("uid", *columns), "scores")
    vectors = cut_lineage(score_vectors(kept, columns), "vectors") if compress else kept.withColumn("weight", F.lit(1.0))
    model = train_centres(vectors, columns, k, steps)
    ranks = ranked_centres(scores.sparkSession, model.centres)
    return cluster_tags(model.transform(kept).select("uid", "prediction"), ranks, rules)


def cluster_bounds(scored: DataFrame, columns: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Least and greatest score sum of each cluster, in cluster order."""
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return (
        scored.groupBy(cluster)
        .agg(F.min(total).alias("min_score"), F.max(total).alias("max_score"))
        .orderBy(cluster)
    )


def spending_power_tag(
    scores: DataFrame, rules: DataFrame, columns: Sequence[str], k: int = 7, max_iter: int = 20,
) -> DataFrame:
    """Clusters from a fixed start, in falling order of their score range; the n-th takes the n-th rule's tag."""
    kept = cut_lineage(scores.select("uid", *columns), "scores")
    vectors = cut_lineage(score_vectors(kept, columns), "vectors")
    model = train_centres(vectors, columns, k, max_iter)
    # k rows at most on either side
    bounds = cluster_bounds(model.transform(vectors), columns).collect()
    order = sorted(bounds, key=lambda b: (-b["max_score"], -b["min_score"], b["prediction"]))
    tags = [r["tag_id"] for r in rules.orderBy("tag_id").limit(k).collect()]
    if len(tags) < len(order):
        raise ValueError(f"{len(tags)} rules for {len(order)} clusters")
    table = [(b["prediction"], tag) for b, tag in zip(order, tags)]
    tag_of = small_table(scores.sparkSession, table, "prediction int, tag_id bigint")
    predicted = model.transform(kept).select("uid", "prediction")
    return predicted.join(tag_of, "prediction").select("uid", "tag_id")
