"""Aggregations, window, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import lists
from tagloom.operators import audience, clustering, metrics, pages, tagging
from tagloom.plans.book import query
from tagloom.plans.datasets import (
    RFM_COLUMNS, RFM_F, RFM_M, RFM_R, SQL_COMBINED, SQL_CYCLE, SQL_PAY, SQL_PROFILE_ROWS, SQL_PROFILE_TABLE,
    SQL_RFM, SQL_RFM_SCORES, SQL_TAGS, Data,
)
from tagloom.sources.keyed import sorted_by


@query("agg_max_per_key", "SELECT o_custkey AS uid, max(o_orderdate) AS last_time FROM orders GROUP BY o_custkey")
def agg_max_per_key(d: Data):
    return d.orders.groupBy("uid").agg(F.max("finish_time").alias("last_time"))


@query("agg_count_per_key", "SELECT user_id AS uid, count(props) AS views FROM events GROUP BY user_id")
def agg_count_per_key(d: Data):
    return d.visits.groupBy("uid").agg(F.count("url").alias("views"))


@query("agg_count_distinct", """
  SELECT user_id AS uid, count(DISTINCT event_type || '/' || regexp_extract(props, '[0-9]+')) AS pages FROM events GROUP BY user_id
  UNION ALL SELECT CAST(-1 AS BIGINT), count(DISTINCT o_custkey) FROM orders
""")
def agg_count_distinct(d: Data):
    per_user = d.visits.groupBy("uid").agg(F.countDistinct("url").alias("pages"))
    overall = d.orders.agg(F.countDistinct("uid").alias("pages"))
    return per_user.unionByName(overall.select(F.lit(-1).cast("bigint").alias("uid"), "pages"))


@query("agg_decimal_sum", """
  SELECT o_custkey AS uid, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS exact_sum,
    CAST(sum(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(10,0))) AS BIGINT) AS whole_sum
  FROM orders GROUP BY o_custkey
""")
def agg_decimal_sum(d: Data):
    return d.orders.groupBy("uid").agg(
        F.sum("amount").cast("double").alias("exact_sum"),
        F.sum(F.col("amount").cast("decimal(10,0)")).cast("bigint").alias("whole_sum"),
    )


@query("agg_two_key_count", "SELECT o_custkey AS uid, o_orderpriority AS pay_code, count(*) AS n FROM orders GROUP BY 1, 2")
def agg_two_key_count(d: Data):
    return d.orders.groupBy("uid", "pay_code").agg(F.count("*").alias("n"))


@query("agg_conditional_sums", """
  SELECT l_partkey AS part_id, CAST(sum(CASE WHEN l_discount > 0 THEN 1 ELSE 0 END) AS BIGINT) AS discounted,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned, count(*) AS total
  FROM lineitem GROUP BY l_partkey
""")
def agg_conditional_sums(d: Data):
    return d.table("lineitem").groupBy(F.col("l_partkey").alias("part_id")).agg(
        F.sum(F.when(F.col("l_discount") > 0, 1).otherwise(0)).alias("discounted"),
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"),
        F.count("*").alias("total"),
    )


@query("agg_ratios", """
  WITH s AS (SELECT o_custkey AS uid, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS closed,
    CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS closed_total
    FROM orders GROUP BY o_custkey)
  SELECT uid, CAST(closed AS DOUBLE) / n AS order_rate, closed_total / total AS amount_rate,
    CASE WHEN closed = 0 THEN NULL ELSE (closed_total / closed) / (total / n) END AS mean_rate FROM s
""")
def agg_ratios(d: Data):
    closed = F.col("status") == "F"
    sums = d.orders.groupBy("uid").agg(
        F.count("*").alias("n"), F.sum(F.when(closed, 1).otherwise(0)).alias("c"),
        F.sum("amount").cast("double").alias("total"),
        F.sum(F.when(closed, F.col("amount")).otherwise(0)).cast("double").alias("closed_total"),
    )
    mean_rate = F.try_divide(F.try_divide("closed_total", "c"), F.try_divide("total", "n"))
    return sums.select(
        "uid", F.try_divide("c", "n").alias("order_rate"), F.try_divide("closed_total", "total").alias("amount_rate"),
        mean_rate.alias("mean_rate"),
    )


@query("agg_first_per_group", """
  SELECT uid, code AS first_code, n FROM (
    SELECT o_custkey AS uid, o_orderpriority AS code, count(*) OVER (PARTITION BY o_custkey) AS n,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders WHERE o_orderpriority IS NOT NULL) WHERE rn = 1
""")
def agg_first_per_group(d: Data):
    return (
        d.orders.where(F.col("pay_code").isNotNull()).groupBy("uid").agg(
            F.min_by("pay_code", F.struct("finish_time", "order_id")).alias("first_code"),
            F.count("*").alias("n"),
        ).orderBy(F.desc("n"), "uid")
    )


@query("agg_cluster_min_max", f"""
  WITH {SQL_RFM_SCORES}
  SELECT CAST(r_score AS INTEGER) AS cluster, min(r_score + f_score + m_score) AS min_score,
    max(r_score + f_score + m_score) AS max_score FROM rfm_scores GROUP BY 1
""")
def agg_cluster_min_max(d: Data):
    scored = _rfm_scores(d).withColumn("cluster", F.col("r_score").cast("int"))
    return clustering.cluster_bounds(scored, RFM_COLUMNS, "cluster")


def _rfm_scores(d: Data):
    return metrics.rfm_scores(metrics.rfm_metrics(d.orders, d.orders_as_of, scale=2), RFM_R, RFM_F, RFM_M)


@query("agg_distinct_rows", """
  SELECT 'distinct' AS kind, l_partkey AS id, l_returnflag AS value FROM lineitem GROUP BY l_partkey, l_returnflag
  UNION ALL SELECT 'one per id', l_partkey, min(l_returnflag) FROM lineitem GROUP BY l_partkey
""")
def agg_distinct_rows(d: Data):
    rows = d.table("lineitem").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("value"))
    unique = rows.distinct().select(F.lit("distinct").alias("kind"), "id", "value")
    one = rows.groupBy("id").agg(F.min("value").alias("value"))
    return unique.unionByName(one.select(F.lit("one per id").alias("kind"), "id", "value"))


@query("agg_sum_or_zero", """
  SELECT CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12,2))) FILTER (WHERE o_totalprice < 0), 0) AS DOUBLE) AS none,
    CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(12,2))), 0) AS DOUBLE) AS everything FROM orders
""")
def agg_sum_or_zero(d: Data):
    def total(rows):
        return F.coalesce(F.sum(rows), F.lit(0)).cast("double")

    negative = F.when(F.col("amount") < 0, F.col("amount"))
    return d.orders.agg(total(negative).alias("none"), total(F.col("amount")).alias("everything"))


@query("agg_filtered_count", f"""
  WITH {SQL_TAGS}, {SQL_COMBINED}
  SELECT 'level' AS kind, CAST(level AS BIGINT) AS key, count(*) AS n FROM tags GROUP BY level
  UNION ALL SELECT 'combined', merge_tag_id, count(*) FROM combined GROUP BY merge_tag_id
  UNION ALL SELECT 'urgent', CAST(0 AS BIGINT), count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def agg_filtered_count(d: Data):
    n = F.count("*").alias("n")
    levels = d.tags.groupBy(F.col("level").cast("bigint").alias("key")).agg(n)
    members = d.combined.groupBy(F.col("merge_tag_id").alias("key")).agg(n)
    urgent = d.orders.where("pay_code = '1-URGENT'").agg(n).select(F.lit(0).cast("bigint").alias("key"), "n")
    named = [("level", levels), ("combined", members), ("urgent", urgent)]
    parts = [df.select(F.lit(kind).alias("kind"), "key", "n") for kind, df in named]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("agg_rfm_keyed_reduce", f"WITH {SQL_RFM} SELECT * FROM rfm")
def agg_rfm_keyed_reduce(d: Data):
    """Three reductions per user in a single aggregation."""
    out = metrics.rfm_metrics(d.orders, d.orders_as_of, scale=2)
    return out.withColumn("monetary", F.col("monetary").cast("double"))


@query("win_top1_per_group", f"WITH {SQL_PAY} SELECT uid, code AS pay_code, uses FROM pay_best")
def win_top1_per_group(d: Data):
    return tagging.favourite(d.orders)


@query("srt_multi_key", f"WITH {SQL_TAGS} SELECT level, id, name FROM tags ORDER BY level, id")
def srt_multi_key(d: Data):
    return d.tags.select("level", "id", "name").orderBy("level", "id")


@query("srt_page", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def srt_page(d: Data):
    rows = d.table("orders").select("o_orderkey", "o_custkey")
    return pages.numbered_page(rows, "o_orderkey", 3, 50, pages.page_directory(rows, "o_orderkey", 16))


@query("srt_page_deep", """
  SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey
  LIMIT 40 OFFSET ((SELECT count(*) FROM orders) // 40 - 3) * 40
""")
def srt_page_deep(d: Data):
    """The third page from the last full one: as cheap as the first."""
    rows = d.table("orders").select("o_orderkey", "o_totalprice")
    directory = pages.page_directory(rows, "o_orderkey")
    return pages.numbered_page(rows, "o_orderkey", sum(r.rows for r in directory) // 40 - 2, 40, directory)


@query("srt_page_after", """
  SELECT o_orderkey, o_custkey FROM orders
  WHERE o_orderkey > (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 99)
  ORDER BY o_orderkey LIMIT 50
""")
def srt_page_after(d: Data):
    rows = d.table("orders").select("o_orderkey", "o_custkey")
    last = rows.orderBy("o_orderkey").limit(100).agg(F.max("o_orderkey")).first()[0]
    return audience.page_after(rows, "o_orderkey", last, 50)


@query("srt_top_n", f"""
  WITH {SQL_PROFILE_ROWS}
  SELECT tag_id, uid, CAST(rn AS INTEGER) AS "rank" FROM (
    SELECT *, row_number() OVER (PARTITION BY tag_id ORDER BY uid) AS rn FROM profile_rows) WHERE rn <= 5
""")
def srt_top_n(d: Data):
    return audience.examples(d.profile, 5).select("tag_id", "uid", "rank")


@query("srt_global_by_key", "SELECT event_id, user_id FROM events ORDER BY event_id DESC")
def srt_global_by_key(d: Data):
    return sorted_by(d.table("events").select("event_id", "user_id"), ["event_id"], ascending=False)


@query("set_union_distinct", f"""
  WITH {SQL_TAGS}
  SELECT id, name FROM tags WHERE level = 4 UNION SELECT id, name FROM tags WHERE level >= 4
""")
def set_union_distinct(d: Data):
    own = d.tags.where("level = 4").select("id", "name")
    below = d.tags.where("level >= 4").select("id", "name")
    return own.union(below).distinct()


@query("set_union_all_dedup", f"""
  WITH {SQL_PROFILE_ROWS}
  SELECT DISTINCT principal, tag_id FROM (
    SELECT s_suppkey AS principal, CAST(348 + s_suppkey % 8 AS BIGINT) AS tag_id FROM supplier
    UNION ALL SELECT s_suppkey, CAST(333 + s_nationkey % 4 AS BIGINT) FROM supplier
    UNION ALL SELECT uid, tag_id FROM profile_rows)
""")
def set_union_all_dedup(d: Data):
    """Grants of suppliers, of their nation's role, and of profile owners, each pair once."""
    supplier = d.table("supplier")
    own = supplier.select(F.col("s_suppkey").alias("principal"), (F.lit(348) + F.col("s_suppkey") % 8).cast("bigint").alias("tag_id"))
    role = supplier.select(F.col("s_suppkey").alias("principal"), (F.lit(333) + F.col("s_nationkey") % 4).cast("bigint").alias("tag_id"))
    held = d.profile.select(F.col("uid").alias("principal"), F.explode("tag_ids").alias("tag_id"))
    return own.unionByName(role).unionByName(held).distinct()


@query("set_array_append_distinct", f"""
  WITH {SQL_PROFILE_TABLE}, {SQL_PAY}
  SELECT pay.uid, CASE WHEN tag_ids IS NULL THEN CAST(tag_id AS VARCHAR) ELSE tag_ids || ',' || CAST(tag_id AS VARCHAR) END AS tag_ids
  FROM pay LEFT JOIN profile_table ON user_id = CAST(pay.uid AS VARCHAR)
""")
def set_array_append_distinct(d: Data):
    new = tagging.pay_type_tag(d.orders, tagging.level5_rules(d.tags, 356))
    joined = new.join(d.profile, "uid", "left")
    return joined.select("uid", lists.join_list(lists.append_tag("tag_ids", "tag_id")).alias("tag_ids"))


@query("set_array_replace_siblings", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_CYCLE}, merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p JOIN cycle c ON c.uid = p.uid WHERE p.tag_id NOT BETWEEN 348 AND 355
    UNION SELECT uid, tag_id FROM cycle)
  SELECT uid, string_agg(CAST(tag_id AS VARCHAR), ',' ORDER BY tag_id) AS tag_ids FROM merged GROUP BY uid
""")
def set_array_replace_siblings(d: Data):
    new = tagging.consume_cycle_tag(d.orders, tagging.level5_rules(d.tags, 347), d.orders_as_of)
    family = lists.tag_array([*range(348, 356), 385, 386])
    joined = new.join(d.profile, "uid", "left")
    return joined.select(
        "uid", lists.join_list(lists.replace_siblings("tag_ids", family, "tag_id")).alias("tag_ids")
    )
