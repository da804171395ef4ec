"""Machine learning steps over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tagloom.functions.text import portable_hash
from tagloom.operators import clustering, learning
from tagloom.operators.centres import train_centres, train_each
from tagloom.operators.metrics import rfm_metrics, weak_label
from tagloom.operators.trees import Trial, search_trees, train_trees
from tagloom.plans.book import query
from tagloom.plans.datasets import LABEL_COLOURS, LABEL_PRODUCTS, RFM_COLUMNS, SQL_RFM, SQL_RFM_SCORES, Data, sql_centres, sql_items
from tagloom.plans.q_preparation import _hash
from tagloom.plans.q_tags import coded, rfm_scores
from tagloom.plans.tree_sql import sql_scores, sql_trees
from tagloom.session import cut_lineage

TREE_COLUMNS = ["colour_id", "product_id"]


def embedded(d: Data):
    """``(vec_id, label, features)``."""
    return d.table("embeddings").select(
        "vec_id", F.col("label").cast("double"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )


def counted_items(d: Data, folds: int = 0):
    """Order lines by colour, product and label, counted; coded for the tree."""
    items = d.lines.select(
        "order_id", "colour", "product",
        weak_label("colour", "product", LABEL_COLOURS, LABEL_PRODUCTS).cast("double").alias("label"),
    )
    counted = learning.counted_rows(items, ["colour", "product", "label"], ["order_id", "colour", "product"], folds)
    return cut_lineage(coded(d, counted), "items")


def _counted_sql(folds: int) -> str:
    return f"{sql_items(folds)}, counted AS (SELECT colour_id, product_id, label, fold, count(*) AS w FROM items GROUP BY ALL)"


@query("ml_assemble", f"WITH {SQL_RFM_SCORES} SELECT uid, r_score || ',' || f_score || ',' || m_score AS features FROM rfm_scores")
def ml_assemble(d: Data):
    vectors = clustering.assembled(rfm_scores(d), RFM_COLUMNS)
    return vectors.select("uid", F.array_join(vector_to_array("features").cast("array<string>"), ",").alias("features"))


@query("ml_minmax_scale", f"""
  WITH {SQL_RFM}, b AS (SELECT min(recency) AS r0, max(recency) AS r1, min(frequency) AS f0, max(frequency) AS f1 FROM rfm)
  SELECT uid, CAST(recency - r0 AS DOUBLE) / (r1 - r0) AS recency_scaled, CAST(frequency - f0 AS DOUBLE) / (f1 - f0) AS frequency_scaled FROM rfm, b
""")
def ml_minmax_scale(d: Data):
    rfm = rfm_metrics(d.orders, d.orders_as_of, scale=2).select("uid", "recency", "frequency")
    return learning.minmax_columns(rfm, ["recency", "frequency"]).select("uid", "recency_scaled", "frequency_scaled")


@query("ml_normalize", """
  SELECT l_orderkey, l_linenumber, l_partkey, 'l1' AS p, l_quantity / (abs(l_quantity) + abs(l_discount) + abs(l_tax)) AS quantity, l_tax / (abs(l_quantity) + abs(l_discount) + abs(l_tax)) AS tax FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l2', l_quantity / sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax), l_tax / sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax) FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'max', l_quantity / greatest(l_quantity, l_discount, l_tax), l_tax / greatest(l_quantity, l_discount, l_tax) FROM lineitem
""")
def ml_normalize(d: Data):
    columns = ["l_quantity", "l_discount", "l_tax"]
    rows, out = d.table("lineitem"), None
    for name, p in (("l1", 1), ("l2", 2), ("max", float("inf"))):
        scaled = learning.normalized_columns(rows, columns, p).select(
            "l_orderkey", "l_linenumber", "l_partkey", F.lit(name).alias("p"),
            F.col("l_quantity_norm").alias("quantity"), F.col("l_tax_norm").alias("tax"),
        )
        out = scaled if out is None else out.unionByName(scaled)
    return out


@query("ml_kmeans")
def ml_kmeans(d: Data):
    vectors = embedded(d)
    model = clustering.fit_kmeans(vectors, 10, distance="cosine")
    return model.transform(vectors).select("vec_id", "prediction")


def _cost_rows(d: Data):
    return cut_lineage(clustering.score_vectors(rfm_scores(d), RFM_COLUMNS), "vectors")


@query("ml_kmeans_best_iter", f"""
  WITH {SQL_RFM_SCORES}, {sql_centres("t", "rfm_scores", RFM_COLUMNS, 5, 20)},
  costs AS (SELECT 5 AS max_iter, round(sum(w * d), 6) AS cost FROM t_a5 UNION ALL SELECT 15, round(sum(w * d), 6) FROM t_a15
    UNION ALL SELECT 20, round(sum(w * d), 6) FROM t_a20)
  SELECT max_iter, cost, row_number() OVER (ORDER BY cost, max_iter) = 1 AS best FROM costs
""")
def ml_kmeans_best_iter(d: Data):
    """One training shows the cost at every iteration limit; of equal costs the lower limit is the best."""
    model = train_centres(_cost_rows(d), RFM_COLUMNS, 5, 20)
    costs = [(n, round(model.costs[n], 6)) for n in (5, 15, 20)]
    best = min(costs, key=lambda c: c[1])[0]
    return d.small([(n, cost, n == best) for n, cost in costs], "max_iter int, cost double, best boolean")


@query("ml_kmeans_best_k", f"""
  WITH {SQL_RFM_SCORES}, {", ".join(sql_centres(f"t{k}", "rfm_scores", RFM_COLUMNS, k, 10) for k in range(2, 11))}
  {" UNION ALL ".join(f"SELECT {k} AS k, round(sum(w * d), 6) AS cost FROM t{k}_a10" for k in range(2, 11))}
""")
def ml_kmeans_best_k(d: Data):
    ks = range(2, 11)
    costs = [(k, round(model.costs[-1], 6)) for k, model in zip(ks, train_each(_cost_rows(d), RFM_COLUMNS, ks, 10))]
    return d.small(costs, "k int, cost double")


@query("ml_kmeans_silhouette")
def ml_kmeans_silhouette(d: Data):
    found = clustering.silhouette_by_k(embedded(d), range(2, 7))
    rows = [(k, score, ",".join(map(str, sorted(sizes)))) for k, score, sizes in found]
    return d.small(rows, "k int, silhouette double, cluster_sizes string")


@query("agg_cluster_sizes", f"""
  WITH {SQL_RFM_SCORES} SELECT CAST(r_score - 1 AS INTEGER) AS prediction, count(*) AS n FROM rfm_scores GROUP BY 1
""")
def agg_cluster_sizes(d: Data):
    """Sizes of given clusters: the users by recency score."""
    predicted = rfm_scores(d).select("uid", (F.col("r_score") - 1).cast("int").alias("prediction"))
    return clustering.cluster_sizes(predicted)


_PARTS = [f"e{i}" for i in range(64)]


@query("ml_decision_tree", f"""
  WITH s AS (SELECT vec_id, label, 1 AS w, CASE WHEN {_hash("vec_id")} % 100 < 80 THEN 0 ELSE 1 END AS fold,
    {", ".join(f"embedding[{i + 1}] AS {c}" for i, c in enumerate(_PARTS))} FROM embeddings),
  {sql_trees("t", "s", _PARTS, [("gini", 32, 1)], 5, range(10), bounds="fold = 0")}
  SELECT vec_id, CAST(label AS DOUBLE) AS label, prediction FROM t_p5 JOIN t_x USING (id) WHERE fold = 1
""")
def ml_decision_tree(d: Data):
    """Trained on the training rows only, applied to the others."""
    values = F.col("embedding").cast("array<double>")
    rows = d.table("embeddings").select("vec_id", F.col("label").cast("double"), *[F.get(values, i).alias(c) for i, c in enumerate(_PARTS)])
    train, test = learning.split_by_key(rows, "vec_id", 80)
    (tree,), _ = train_trees(train, _PARTS, [Trial("gini", 32)], 5)
    return tree.transform(test).select("vec_id", "label", "prediction")


@query("ml_pipeline", f"""
  WITH {_counted_sql(5)}, {sql_trees("t", "counted", TREE_COLUMNS, [("gini", 32, 4)], 5, categorical=True)}
  SELECT CAST(label AS DOUBLE) AS label, prediction, CAST(sum(w) AS BIGINT) AS items FROM t_p5 JOIN t_x USING (id) WHERE fold = 4 GROUP BY ALL
""")
def ml_pipeline(d: Data):
    """Code, count and classify as one chain; the label and prediction of the items left out."""
    items = counted_items(d, folds=5)
    (tree,), _ = train_trees(items.where("fold < 4"), TREE_COLUMNS, [Trial()], 5, TREE_COLUMNS, weight="weight")
    tested = tree.transform(items.where("fold = 4"))
    return tested.groupBy("label", "prediction").agg(F.sum("weight").cast("bigint").alias("items"))


_FOLD_TRIALS = [(kind, 32, out) for kind in ("gini", "entropy") for out in range(3)]


@query("ml_cross_validate", f"""
  WITH {_counted_sql(3)}, {sql_trees("t", "counted", TREE_COLUMNS, _FOLD_TRIALS, 5, categorical=True)}
  {sql_scores("t", [2, 5])}
""")
def ml_cross_validate(d: Data):
    """Mean accuracy on three folds, each left out once."""
    _, _, scores = search_trees(
        counted_items(d, folds=3), TREE_COLUMNS, range(3), (2, 5), ("gini", "entropy"), (32,), TREE_COLUMNS, weight="weight"
    )
    return d.small(scores, "depth int, impurity string, bins int, accuracy double")


@query("ml_train_validation_split", f"""
  WITH {SQL_RFM_SCORES}, counted AS (SELECT r_score, f_score, m_score, c_nationkey % 2 AS label, {_hash("uid")} % 5 AS fold, count(*) AS w
    FROM rfm_scores JOIN customer ON c_custkey = uid GROUP BY ALL),
  {sql_trees("t", "counted", RFM_COLUMNS, [("gini", 32, 4)], 5)}
  {sql_scores("t", [2, 5])}
""")
def ml_train_validation_split(d: Data):
    """Four fifths of the users train, the accuracy is that on the others."""
    users = rfm_scores(d).join(d.users.select("uid", (F.col("nationality") % 2).cast("double").alias("label")), "uid")
    rows = users.withColumn("fold", (portable_hash("uid") % 5).cast("int")).groupBy(*RFM_COLUMNS, "label", "fold").agg(
        F.count("*").alias("weight")
    )
    _, _, scores = search_trees(rows, RFM_COLUMNS, [4], (2, 5), weight="weight")
    return d.small(scores, "depth int, impurity string, bins int, accuracy double")


_GRID_TRIALS = [(kind, bins, None) for kind in ("gini", "entropy") for bins in (32, 64)]


@query("ml_param_grid", f"""
  WITH {_counted_sql(1)}, {sql_trees("t", "counted", TREE_COLUMNS, _GRID_TRIALS, 10, categorical=True)}
  {sql_scores("t", [5, 10])}
""")
def ml_param_grid(d: Data):
    """Every grid point trained on the counted items, with its weighted training accuracy."""
    trials = [Trial(*point) for point in _GRID_TRIALS]
    _, found = train_trees(counted_items(d), TREE_COLUMNS, trials, 10, TREE_COLUMNS, weight="weight", depths=(5, 10))
    rows = [(depth, trials[n].impurity, trials[n].bins, round(share, 9)) for (n, depth), share in found.items()]
    return d.small(rows, "depth int, impurity string, bins int, accuracy double")


@query("ml_vector_index", """
  SELECT c_custkey AS uid, CAST(10 + 5 * (c_nationkey % 4) AS DOUBLE) AS code, CAST(c_nationkey % 4 AS DOUBLE) AS code_index,
    c_acctbal AS balance, c_acctbal AS balance_index FROM customer
""")
def ml_vector_index(d: Data):
    """A column of four values becomes an index, a column of many stays as it is."""
    from pyspark.ml.feature import VectorIndexer

    users = d.users.select("uid", (F.lit(10) + F.col("nationality") % 4 * 5).cast("double").alias("code"), "balance")
    raw = clustering.assembled(users, ["code", "balance"], "raw")
    indexed = VectorIndexer(inputCol="raw", outputCol="indexed", maxCategories=4).fit(raw).transform(raw)
    values = vector_to_array("indexed")
    return indexed.select("uid", "code", values[0].alias("code_index"), "balance", values[1].alias("balance_index"))


@query("ml_string_index", """
  WITH n AS (SELECT o_orderpriority AS label, count(*) AS c FROM orders GROUP BY 1),
  i AS (SELECT label, CAST(row_number() OVER (ORDER BY c DESC, label) - 1 AS DOUBLE) AS label_index FROM n)
  SELECT o_orderkey, o_orderpriority, label_index, o_orderpriority AS again FROM orders JOIN i ON label = o_orderpriority
""")
def ml_string_index(d: Data):
    rows = d.table("orders").select("o_orderkey", "o_orderpriority")
    order = cut_lineage(learning.label_order(rows, "o_orderpriority"), "order")
    indexed = learning.index_labels(rows, "o_orderpriority", order)
    return learning.labels_again(indexed, "label_index", order, "again").select(*rows.columns, "label_index", "again")


@query("ml_evaluate_multiclass", """
  WITH c AS (SELECT CASE l_linestatus WHEN 'O' THEN 1 ELSE 0 END AS a, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS b FROM lineitem),
  n AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(CASE WHEN a = 1 AND b = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
    CAST(sum(CASE WHEN a = 0 AND b = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn, CAST(sum(a) AS DOUBLE) AS p, CAST(sum(b) AS DOUBLE) AS g FROM c),
  m AS (SELECT *, tp / g AS p1, tn / (n - g) AS p0, tp / p AS r1, tn / (n - p) AS r0 FROM n)
  SELECT (tp + tn) / n AS accuracy, 1 - (tp + tn) / n AS error_rate,
    round((p1 * p + p0 * (n - p)) / n, 12) AS weighted_precision, round((r1 * p + r0 * (n - p)) / n, 12) AS weighted_recall,
    round((2 * p1 * r1 / (p1 + r1) * p + 2 * p0 * r0 / (p0 + r0) * (n - p)) / n, 12) AS f1 FROM m
""")
def ml_evaluate_multiclass(d: Data):
    guessed = d.table("lineitem").select(
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("label"),
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("prediction"),
    )
    out = learning.classification_metrics(guessed)
    for c in ("weighted_precision", "weighted_recall", "f1"):
        out = out.withColumn(c, F.round(c, 12))
    return out


@query("ml_bisecting_kmeans")
def ml_bisecting_kmeans(d: Data):
    vectors = clustering.cluster_vectors(rfm_scores(d), RFM_COLUMNS)
    return d.small(learning.bisecting_cost_by_k(vectors, range(2, 6), weight="weight"), "k int, cost double")


@query("ml_naive_bayes", f"""
  WITH {SQL_RFM_SCORES}, x AS (
    SELECT uid, CAST(length(c_mktsegment) % 3 AS DOUBLE) AS label, r_score AS r, f_score AS f, m_score AS m, {_hash("uid")} % 100 < 60 AS train
    FROM rfm_scores JOIN customer ON c_custkey = uid),
  t AS (SELECT label AS c, count(*) AS n, sum(r) AS r, sum(f) AS f, sum(m) AS m FROM x WHERE train GROUP BY label),
  w AS (SELECT c, ln(n + 1) - ln(sum(n) OVER () + count(*) OVER ()) AS prior, ln(r + 1) - ln(r + f + m + 3) AS wr,
    ln(f + 1) - ln(r + f + m + 3) AS wf, ln(m + 1) - ln(r + f + m + 3) AS wm FROM t)
  SELECT uid, label, arg_max(c, prior + r * wr + f * wf + m * wm) AS prediction FROM x, w WHERE NOT train GROUP BY uid, label
""")
def ml_naive_bayes(d: Data):
    """60 % of the users train, the others are classified."""
    segments = d.users.select("uid", (F.length("gender") % 3).cast("double").alias("label"))
    rows = clustering.assembled(rfm_scores(d).join(segments, "uid"), RFM_COLUMNS)
    train, test = learning.split_by_key(rows, "uid", 60)
    return learning.naive_bayes(train).transform(test).select("uid", "label", "prediction")


@query("ml_logistic_regression")
def ml_logistic_regression(d: Data):
    rows = embedded(d)
    return learning.logistic_regression(rows).transform(rows).select("vec_id", "label", "prediction")


@query("ml_pca")
def ml_pca(d: Data):
    rows = embedded(d)
    projected = learning.principal_components(rows, 4).transform(rows)
    values = vector_to_array("components")
    return projected.select("vec_id", *[values[i].alias(f"pc{i + 1}") for i in range(4)])


@query("ml_random_split", f"""
  WITH p AS (SELECT * FROM (VALUES (80), (70), (60)) v(percent))
  SELECT CAST(percent AS INTEGER) AS percent, CASE WHEN {_hash("o_orderkey")} % 100 < percent THEN 'train' ELSE 'test' END AS part, o_orderkey FROM orders, p
""")
def ml_random_split(d: Data):
    out = None
    for percent in (80, 70, 60):
        for name, part in zip(("train", "test"), learning.split_by_key(d.table("orders"), "o_orderkey", percent)):
            rows = part.select(F.lit(percent).alias("percent"), F.lit(name).alias("part"), "o_orderkey")
            out = rows if out is None else out.unionByName(rows)
    return out
