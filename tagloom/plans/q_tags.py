"""Tag models: match, statistics and clustering."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tagloom.functions import bins
from tagloom.operators import clustering, metrics, tagging
from tagloom.operators.joins import lookup_default
from tagloom.operators.profiles import render_profile
from tagloom.plans import registry
from tagloom.plans.book import query
from tagloom.plans.datasets import (
    LABEL_COLOURS, LABEL_PRODUCTS, RFE_COLUMNS, RFE_E, RFE_F, RFE_R, RFM_COLUMNS, RFM_F, RFM_M, RFM_R,
    SQL_CYCLE, SQL_LINES, SQL_PAY, SQL_PROFILE_ROWS, SQL_RFE, SQL_RFE_SCORES, SQL_RFM, SQL_RFM_SCORES, SQL_USERS, Data, sql_centres, sql_items,
)
from tagloom.plans.tree_sql import sql_scores, sql_trees
from tagloom.sources.models import load_or_train


def rules(d: Data, tag_id: int):
    return tagging.level5_rules(d.model_tags, tag_id)


def rfm_scores(d: Data):
    return metrics.rfm_scores(metrics.rfm_metrics(d.orders, d.orders_as_of, scale=2), RFM_R, RFM_F, RFM_M)


def rfe_scores(d: Data):
    return metrics.rfe_scores(metrics.rfe_metrics(d.visits, d.events_as_of), RFE_R, RFE_F, RFE_E)


def usg_items(d: Data):
    return metrics.usg_features(d.lines, d.orders, d.colours, d.products, LABEL_COLOURS, LABEL_PRODUCTS)


def _match(d: Data, field: str, tag_id: int):
    return tagging.match_tag(d.users.select("uid", field), field, rules(d, tag_id))


@query("tag_match", """
  SELECT c_custkey AS uid, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 319 ELSE 320 END AS BIGINT) AS tag_id
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def tag_match(d: Data):
    return _match(d, "gender", 318)


@query("tag_match_nationality", """
  SELECT c_custkey AS uid, CAST(332 + c_nationkey AS BIGINT) AS tag_id FROM customer WHERE c_nationkey BETWEEN 1 AND 4
""")
def tag_match_nationality(d: Data):
    return _match(d, "nationality", 332)


@query("tag_age_range", f"""
  WITH {SQL_USERS}
  SELECT uid, CAST(339 + (year(birthday) - 1950) // 10 AS BIGINT) AS tag_id FROM users
""")
def tag_age_range(d: Data):
    return tagging.age_range_tag(d.users, rules(d, 338))


@query("tag_consume_cycle", f"WITH {SQL_CYCLE} SELECT uid, tag_id FROM cycle")
def tag_consume_cycle(d: Data):
    return tagging.consume_cycle_tag(d.orders, rules(d, 347), d.orders_as_of)


@query("tag_consume_cycle_narrow", f"""
  WITH {SQL_CYCLE} SELECT uid, tag_id FROM cycle WHERE tag_id BETWEEN 348 AND 355
""")
def tag_consume_cycle_narrow(d: Data):
    """With the original eight ranges most users match none, and are dropped."""
    narrow = rules(d, 347).where(F.col("tag_id") <= 355)
    return tagging.consume_cycle_tag(d.orders, narrow, d.orders_as_of)


@query("tag_pay_type", f"WITH {SQL_PAY} SELECT uid, tag_id FROM pay")
def tag_pay_type(d: Data):
    return tagging.pay_type_tag(d.orders, rules(d, 356))


@query("rfm_metrics", f"WITH {SQL_RFM} SELECT * FROM rfm")
def rfm_metrics(d: Data):
    out = metrics.rfm_metrics(d.orders, d.orders_as_of, scale=2)
    return out.withColumn("monetary", F.col("monetary").cast("double"))


@query("rfm_scores", f"WITH {SQL_RFM_SCORES} SELECT * FROM rfm_scores")
def rfm_scores_query(d: Data):
    return rfm_scores(d)


@query("rfe_metrics", f"WITH {SQL_RFE} SELECT * FROM rfe")
def rfe_metrics(d: Data):
    return metrics.rfe_metrics(d.visits, d.events_as_of)


@query("rfe_scores", f"WITH {SQL_RFE_SCORES} SELECT * FROM rfe_scores")
def rfe_scores_query(d: Data):
    return rfe_scores(d)


def _published(name: str, value: str, cases: list[tuple[str, int]], strict: list[tuple[str, int]]) -> str:
    """A score by the published ranges, without gaps and taken literally."""
    closed = " ".join(f"WHEN {test.format(value)} THEN {score}" for test, score in cases[:-1])
    exact = " ".join(f"WHEN {test.format(value)} THEN {score}" for test, score in strict)
    return f"CAST(CASE {closed} ELSE {cases[-1][1]} END AS DOUBLE) AS {name}, CAST(CASE {exact} END AS DOUBLE) AS {name}_strict"


def _steps(order: str, cuts: list[int], scores: list[int]) -> list[tuple[str, int]]:
    return [(f"{{0}} {order} {cut}", score) for cut, score in zip(cuts, scores)] + [("", scores[-1])]


def _ranges(*rows: tuple[str, int]) -> list[tuple[str, int]]:
    return [(f"{{0}} {test}", score) for test, score in rows]


@query("rfm_scores_published", f"""
  WITH {SQL_RFM}, x AS (SELECT uid, recency // 25 AS r, frequency * 15 AS f, monetary / 20 AS m FROM rfm)
  SELECT uid,
    {_published("r_score", "r", _steps("<=", [3, 6, 9, 15], [5, 4, 3, 2, 1]),
        _ranges(("BETWEEN 1 AND 3", 5), ("BETWEEN 4 AND 6", 4), ("BETWEEN 7 AND 9", 3), ("BETWEEN 10 AND 15", 2), ("> 16", 1)))},
    {_published("f_score", "f", _steps(">=", [200, 150, 100, 50], [5, 4, 3, 2, 1]),
        _ranges(("BETWEEN 1 AND 49", 1), ("BETWEEN 50 AND 99", 2), ("BETWEEN 100 AND 149", 3), ("BETWEEN 150 AND 199", 4), (">= 200", 5)))},
    {_published("m_score", "m", _steps(">=", [200000, 100000, 50000, 10000], [5, 4, 3, 2, 1]),
        _ranges(("< 10000", 1), ("BETWEEN 10000 AND 49999", 2), ("BETWEEN 50000 AND 99999", 3), ("BETWEEN 100000 AND 199999", 4), (">= 200000", 5)))}
  FROM x
""")
def rfm_scores_published(d: Data):
    """The published ranges, closed and literal; measures are scaled so that every range has users."""
    rfm = metrics.rfm_metrics(d.orders, d.orders_as_of, scale=2).select(
        "uid", F.floor(F.col("recency") / 25).alias("recency"), (F.col("frequency") * 15).alias("frequency"),
        (F.col("monetary").cast("double") / 20).alias("monetary"),
    )
    return _both(metrics.rfm_scores, rfm, ["r_score", "f_score", "m_score"])


def _both(score, measured, columns):
    strict = score(measured, strict=True).select("uid", *[F.col(c).alias(f"{c}_strict") for c in columns])
    return score(measured).join(strict, "uid")


def _rfe_published_sql(e_below: str, first: str, last: str) -> str:
    return f"""
  WITH {SQL_RFE}, x AS (SELECT uid, recency * 9 + CAST(uid % 70 AS INTEGER) AS r, frequency * 5 AS f, engagements * 3 AS e FROM rfe)
  SELECT uid,
    {_published("r_score", "r", _steps("<=", [15, 30, 45, 60], [5, 4, 3, 2, 1]),
        _ranges((first, 5), ("BETWEEN 16 AND 30", 4), ("BETWEEN 31 AND 45", 3), ("BETWEEN 46 AND 60", 2), (last, 1)))},
    {_published("f_score", "f", _steps(">=", [400, 300, 200, 100], [5, 4, 3, 2, 1]),
        _ranges(("<= 99", 1), ("BETWEEN 100 AND 199", 2), ("BETWEEN 200 AND 299", 3), ("BETWEEN 300 AND 399", 4), (">= 400", 5)))},
    {_published("e_score", "e", _steps(">=", [250, 200, 150, 50], [5, 4, 3, 2, 1]),
        _ranges((e_below, 1), ("BETWEEN 50 AND 149", 2), ("BETWEEN 150 AND 199", 3), ("BETWEEN 200 AND 249", 4), (">= 250", 5)))}
  FROM x"""


def _rfe_scaled(d: Data):
    return metrics.rfe_metrics(d.visits, d.events_as_of).select(
        "uid", (F.col("recency") * 9 + F.col("uid") % 70).cast("int").alias("recency"), (F.col("frequency") * 5).alias("frequency"),
        (F.col("engagements") * 3).alias("engagements"),
    )


@query("rfe_scores_published", _rfe_published_sql("<= 49", "BETWEEN 0 AND 15", "> 61"))
def rfe_scores_published(d: Data):
    return _both(metrics.rfe_scores, _rfe_scaled(d), ["r_score", "f_score", "e_score"])


@query("rfe_scores_published_second", _rfe_published_sql("< 49", "BETWEEN 1 AND 15", ">= 61"))
def rfe_scores_published_second(d: Data):
    """The second version of the activity ranges."""
    def score(measured, strict=False):
        return metrics.rfe_scores(measured, bins.RFE_RECENCY_FROM_ONE, engagements=bins.RFE_ENGAGEMENTS_BELOW_49, strict=strict)

    return _both(score, _rfe_scaled(d), ["r_score", "f_score", "e_score"])


@query("rfe_bean_score", """
  WITH d AS (
    SELECT user_id AS uid, CAST(date_diff('day', CAST(max(ts) AS DATE), (SELECT CAST(max(ts) AS DATE) + 1 FROM events)) AS INTEGER) AS r,
      count(*) AS f, count(DISTINCT event_type) AS e FROM events GROUP BY user_id),
  s AS (
    SELECT uid, CAST(CASE WHEN r <= 1 THEN 6 WHEN r <= 3 THEN 5 WHEN r <= 5 THEN 4 WHEN r <= 7 THEN 3 WHEN r <= 14 THEN 2 ELSE 1 END AS DOUBLE) AS r_score,
      CAST(CASE WHEN f >= 10 THEN 6 WHEN f >= 8 THEN 5 WHEN f >= 6 THEN 4 WHEN f >= 4 THEN 3 WHEN f >= 2 THEN 2 ELSE 1 END AS DOUBLE) AS f_score,
      CAST(least(e, 6) AS DOUBLE) AS e_score FROM d)
  SELECT *, r_score + f_score + e_score AS score FROM s
""")
def rfe_bean_score(d: Data):
    visits = d.table("events").select(
        F.col("user_id").alias("uid"), F.col("ts").alias("log_time"), F.col("event_type").alias("url")
    )
    return metrics.rfe_bean_scores(metrics.rfe_metrics(visits, d.events_as_of))


def _psm_sql(state: str, tail: str) -> str:
    return f"""
  WITH c AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS off
    FROM lineitem GROUP BY l_orderkey),
  o AS (SELECT o_custkey AS uid, CAST(o_totalprice AS DECIMAL(12,2)) AS paid, off, {state} AS st
    FROM orders LEFT JOIN c ON l_orderkey = o_orderkey),
  t AS (SELECT uid, CAST(sum(st) AS DOUBLE) AS dn, CAST(count(st) AS DOUBLE) AS n,
    CAST(sum(off) AS DOUBLE) AS d, CAST(sum(paid + off) AS DOUBLE) AS r FROM o GROUP BY uid),
  p AS (SELECT uid, dn / nullif(n, 0) AS tdonr, d / nullif(r, 0) AS tdar,
    (d / nullif(dn, 0)) / nullif(r / nullif(n, 0), 0) AS adar FROM t)
  {tail}"""


@query("psm_score", _psm_sql(
    "CASE WHEN off = 0 THEN 0 ELSE 1 END",
    "SELECT uid, tdonr, tdar, adar, coalesce(tdonr + tdar + adar, 0.00000001) AS psm_score FROM p",
))
def psm_score(d: Data):
    return metrics.psm_scores(d.orders_with_coupons)


@query("psm_score_parts", _psm_sql(
    "CASE WHEN off > 0 THEN 1 WHEN off = 0 THEN 0 END",
    """SELECT uid, coalesce(tdonr, 0) AS tdonr, coalesce(tdar, 0) AS tdar, coalesce(adar, 0) AS adar,
    coalesce(tdonr, 0) + coalesce(tdar, 0) + coalesce(adar, 0) AS psm_score FROM p""",
))
def psm_score_parts(d: Data):
    return metrics.psm_scores(d.orders_with_coupons, mode="parts")


_USG_SQL = f"""{SQL_LINES}, items AS (
    SELECT o_custkey AS uid, CASE WHEN colour IN ('RF', 'RO', 'NF') OR product IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS label,
      CASE colour WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3 WHEN 'NO' THEN 4 WHEN 'RF' THEN 5 ELSE 0 END AS colour_id,
      CASE product WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 0 END AS product_id
    FROM lines JOIN orders ON o_orderkey = order_id)"""


@query("usg_features", f"WITH {_USG_SQL} SELECT * FROM items")
def usg_features(d: Data):
    return usg_items(d)


@query("tag_usg_rule", f"""
  WITH {_USG_SQL}, s AS (SELECT uid, avg(CASE WHEN label = 0 THEN 1.0 ELSE 0.0 END) AS male, avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END) AS female
    FROM items GROUP BY uid)
  SELECT uid, CAST(CASE WHEN male >= 0.6 THEN 379 WHEN female >= 0.6 THEN 380 ELSE 381 END AS BIGINT) AS tag_id FROM s
""")
def tag_usg_rule(d: Data):
    """Labels come straight from the names; lines are counted per order before orders are joined."""
    labelled = d.lines.select("order_id", metrics.weak_label("colour", "product", LABEL_COLOURS, LABEL_PRODUCTS).alias("label"))
    per_order = metrics.usg_shares(labelled, user="order_id")
    per_user = per_order.join(d.orders.select("order_id", "uid"), "order_id").groupBy("uid").agg(
        *[F.sum(c).alias(c) for c in ("total", "male", "female")]
    )
    return tagging.gender_counts_tag(per_user, rules(d, 378))


_USG_TRIALS = [(kind, 32, out) for kind in ("gini", "entropy") for out in (0, 1, 2, None)]


@query("tag_usg_model", f"""
  WITH {sql_items(3)}, counted AS (SELECT colour_id, product_id, label, fold, count(*) AS w FROM items GROUP BY ALL),
  {sql_trees("t", "counted", ["colour_id", "product_id"], _USG_TRIALS, 5, categorical=True)},
  scored AS ({sql_scores("t", [5], left_out_only=True)}),
  best AS (SELECT trial FROM t_t WHERE left_out IS NULL
    AND kind = (SELECT impurity FROM scored ORDER BY accuracy DESC, impurity DESC LIMIT 1)),
  guessed AS (SELECT DISTINCT colour_id, product_id, prediction FROM t_p5 JOIN best USING (trial) JOIN t_x USING (id)),
  s AS (SELECT uid, avg(CASE WHEN prediction = 0 THEN 1.0 ELSE 0.0 END) AS male, avg(CASE WHEN prediction = 1 THEN 1.0 ELSE 0.0 END) AS female
    FROM items JOIN guessed USING (colour_id, product_id) GROUP BY uid)
  SELECT uid, CAST(CASE WHEN male >= 0.6 THEN 379 WHEN female >= 0.6 THEN 380 ELSE 381 END AS BIGINT) AS tag_id FROM s
""")
def tag_usg_model(d: Data):
    """Items get the label a tuned tree predicts from their colour and product."""
    lines = coded(d, d.lines.withColumn(
        "label", metrics.weak_label("colour", "product", LABEL_COLOURS, LABEL_PRODUCTS)
    ))
    items = lines.join(d.orders.select("order_id", "uid"), "order_id").select(
        "order_id", "colour", "product", "uid", "label", "colour_id", "product_id"
    )
    return tagging.gender_model_tag(items, rules(d, 378), key=["order_id", "colour", "product"])


def coded(d: Data, rows):
    """Colour and product names as ids."""
    rows = lookup_default(rows, "colour", d.colours, "name", "id", "colour_id")
    return lookup_default(rows, "product", d.products, "name", "id", "product_id")


def _cluster_sql(views: str, source: str, columns: list[str], k: int, steps: int, first_tag: int) -> str:
    """Users of ``source`` with the tag of their cluster's rank by centre sum."""
    total, same = " + ".join(columns), " AND ".join(f"s.{c} = a.{c}" for c in columns)
    return f"""
  WITH {views}, {sql_centres("t", source, columns, k, steps)},
  ranked AS (SELECT i, row_number() OVER (ORDER BY {total} DESC, i) - 1 AS rank FROM t_c{steps})
  SELECT s.uid, CAST({first_tag} + rank AS BIGINT) AS tag_id FROM {source} s JOIN t_a{steps} a ON {same} JOIN ranked ON ranked.i = a.i
"""


@query("tag_rfm_value", _cluster_sql(SQL_RFM_SCORES, "rfm_scores", RFM_COLUMNS, 5, 10, 362))
def tag_rfm_value(d: Data):
    return clustering.fixed_start_tag(rfm_scores(d), RFM_COLUMNS, rules(d, 361), k=5)


@query("tag_rfm_value_scaled")
def tag_rfm_value_scaled(d: Data):
    """Min-max scaled scores, best of several iteration limits, chain with its scaler kept and loaded again."""
    path = d.folder_for("rfm-model")

    def stored(train):
        load_or_train(d.spark, path, PipelineModel, train)
        return load_or_train(d.spark, path, PipelineModel, train)

    return clustering.score_cluster_tag(
        rfm_scores(d), RFM_COLUMNS, rules(d, 361), k=5, scale=True, keep=stored,
        make_model=lambda vectors: clustering.best_by_iterations(vectors, 5, weight="weight")[0],
    )


@query("tag_rfm_spending_power", f"""
  WITH {SQL_RFM_SCORES}, {sql_centres("t", "rfm_scores", RFM_COLUMNS, 7, 20)},
  ends AS (SELECT i, min(r_score + f_score + m_score) AS low, max(r_score + f_score + m_score) AS high FROM t_a20 GROUP BY i),
  ranked AS (SELECT i, row_number() OVER (ORDER BY high DESC, low DESC, i) - 1 AS rank FROM ends)
  SELECT s.uid, CAST(390 + rank AS BIGINT) AS tag_id FROM rfm_scores s
  JOIN t_a20 a ON s.r_score = a.r_score AND s.f_score = a.f_score AND s.m_score = a.m_score JOIN ranked ON ranked.i = a.i
""")
def tag_rfm_spending_power(d: Data):
    seven = d.small([(390 + i, str(i)) for i in range(7)], "tag_id bigint, rule string")
    return clustering.spending_power_tag(rfm_scores(d), seven, RFM_COLUMNS)


@query("tag_rfe_activity", _cluster_sql(SQL_RFE_SCORES, "rfe_scores", RFE_COLUMNS, 4, 10, 368))
def tag_rfe_activity(d: Data):
    return clustering.fixed_start_tag(rfe_scores(d), RFE_COLUMNS, rules(d, 367), k=4)


_PSM_VIEWS = _psm_sql("CASE WHEN off = 0 THEN 0 ELSE 1 END", ", psm AS (SELECT uid, coalesce(tdonr + tdar + adar, 0.00000001) AS psm_score FROM p)")


@query("tag_psm_sensitivity", _cluster_sql(_PSM_VIEWS.replace("WITH", "", 1), "psm", ["psm_score"], 5, 10, 373))
def tag_psm_sensitivity(d: Data):
    scores = metrics.psm_scores(d.orders_with_coupons).select("uid", "psm_score")
    return clustering.fixed_start_tag(scores, ["psm_score"], rules(d, 372), k=5, compress=False)


# A ranking of five clusters.
_RANKS = [(2, 0), (1, 1), (0, 2), (4, 3), (3, 4)]


@query("tag_cluster_assign", f"""
  WITH {SQL_RFM_SCORES}
  SELECT uid, CAST(CASE CAST(r_score AS INTEGER) - 1 WHEN 2 THEN 362 WHEN 1 THEN 363 WHEN 0 THEN 364 WHEN 4 THEN 365
    WHEN 3 THEN 366 END AS BIGINT) AS tag_id FROM rfm_scores
""")
def tag_cluster_assign(d: Data):
    predicted = rfm_scores(d).select("uid", (F.col("r_score") - 1).cast("int").alias("prediction"))
    return clustering.cluster_tags(predicted, d.small(_RANKS, "prediction int, rank int"), rules(d, 361))


# The centres of five clusters, two with equal sums.
_CENTRES = [(1.0, 4.0, 3.0), (3.002, 3.0, 3.0), (1.0, 5.0, 5.0), (1.0, 3.0, 3.0), (2.0, 3.0, 3.0)]


def _rank_sql(order: str) -> str:
    rows = ", ".join(f"({i}, {c[0]}, {c[1]}, {c[2]})" for i, c in enumerate(_CENTRES))
    return f"""
  WITH {SQL_RFM_SCORES}, centres(i, r, f, m) AS (VALUES {rows}),
  ranked AS (SELECT i, row_number() OVER (ORDER BY CAST(r AS DOUBLE) + f + m {order}, i) - 1 AS rank FROM centres)
  SELECT uid, CAST(rank AS INTEGER) AS rank FROM rfm_scores JOIN ranked ON i = CAST(r_score AS INTEGER) - 1"""


def _by_rank(d: Data, descending: bool):
    ranks = clustering.ranked_centres(d.spark, _CENTRES, descending).select("prediction", "rank")
    predicted = rfm_scores(d).select("uid", (F.col("r_score") - 1).cast("int").alias("prediction"))
    return predicted.join(ranks, "prediction").select("uid", "rank")


@query("srt_cluster_rank", _rank_sql("DESC"))
def srt_cluster_rank(d: Data):
    """Users of given clusters by the rank of the cluster's centre."""
    return _by_rank(d, True)


@query("srt_cluster_rank_ascending", _rank_sql("ASC"))
def srt_cluster_rank_ascending(d: Data):
    return _by_rank(d, False)


def register_standard_models(d: Data) -> None:
    """Models over the raw columns that the catalogue's level-4 rules select."""
    registry.register_model("gender", lambda rows, r: tagging.match_tag(
        rows.select(F.col("c_custkey").alias("uid"), "c_mktsegment"), "c_mktsegment", r))
    registry.register_model("nationality", lambda rows, r: tagging.match_tag(
        rows.select(F.col("c_custkey").alias("uid"), "c_nationkey"), "c_nationkey", r))
    registry.register_model("consume_cycle", lambda rows, r: tagging.consume_cycle_tag(
        rows.select(F.col("o_custkey").alias("uid"), F.col("o_orderdate").alias("finish_time")), r, d.orders_as_of))
    registry.register_model("pay_type", lambda rows, r: tagging.pay_type_tag(
        rows.select(F.col("o_custkey").alias("uid"), F.col("o_orderpriority").alias("pay_code")), r))


@query("tag_model_run", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_CYCLE}, merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p
    WHERE NOT (p.tag_id BETWEEN 348 AND 355 AND p.uid IN (SELECT uid FROM cycle))
    UNION SELECT uid, tag_id FROM cycle)
  SELECT CAST(uid AS VARCHAR) AS user_id, string_agg(CAST(tag_id AS VARCHAR), ',' ORDER BY tag_id) AS tag_ids
  FROM merged GROUP BY uid
""")
def tag_model_run(d: Data):
    """Definitions -> rule -> source -> model -> merge -> the next profile table."""
    d.view("orders")
    register_standard_models(d)
    run = registry.Run(347, "consume_cycle")
    return render_profile(registry.run_models(d.spark, d.tags, [run], d.profile))


@query("prf_batch_merge", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_CYCLE}, {SQL_PAY},
  nation_tag AS (SELECT c_custkey AS uid, CAST(332 + c_nationkey AS BIGINT) AS tag_id FROM customer WHERE c_nationkey BETWEEN 1 AND 4),
  merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p
    WHERE NOT (p.tag_id BETWEEN 348 AND 355 AND p.uid IN (SELECT uid FROM cycle))
      AND NOT (p.tag_id BETWEEN 333 AND 336 AND p.uid IN (SELECT uid FROM nation_tag))
    UNION SELECT uid, tag_id FROM cycle UNION SELECT uid, tag_id FROM pay UNION SELECT uid, tag_id FROM nation_tag)
  SELECT CAST(uid AS VARCHAR) AS user_id, string_agg(CAST(tag_id AS VARCHAR), ',' ORDER BY tag_id) AS tag_ids
  FROM merged GROUP BY uid
""")
def prf_batch_merge(d: Data):
    d.view("orders"), d.view("customer")
    register_standard_models(d)
    runs = [registry.Run(347, "consume_cycle"), registry.Run(356, "pay_type"), registry.Run(332, "nationality")]
    return render_profile(registry.run_models(d.spark, d.tags, runs, d.profile))
