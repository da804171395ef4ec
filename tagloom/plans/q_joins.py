"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions.dates import date_digits
from tagloom.operators import joins, tagging, tree
from tagloom.plans.book import query
from tagloom.plans.datasets import (
    PART_BASE, SQL_LINES, SQL_PROFILE_ROWS, SQL_TAGS, SQL_USERS, Data,
)


@query("join_inner_equi", """
  SELECT c_custkey AS uid, CAST(332 + c_nationkey AS BIGINT) AS tag_id FROM customer WHERE c_nationkey BETWEEN 1 AND 4
""")
def join_inner_equi(d: Data):
    rules = tagging.level5_rules(d.tags, 332)
    users = d.users.select("uid", F.col("nationality").cast("string").alias("rule"))
    return users.join(rules, "rule").select("uid", "tag_id")


@query("join_broadcast_map", """
  SELECT c_custkey AS uid, c_mktsegment AS gender,
    CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 319 WHEN 'MACHINERY' THEN 320 END AS BIGINT) AS tag_id FROM customer
""")
def join_broadcast_map(d: Data):
    rules = tagging.level5_rules(d.tags, 318)
    users = d.users.select("uid", "gender")
    return joins.match_values(users, "gender", rules, unmatched="null")


@query("join_range_between", f"""
  WITH {SQL_USERS}
  SELECT uid, CAST(339 + (year(birthday) - 1950) // 10 AS BIGINT) AS tag_id FROM users
""")
def join_range_between(d: Data):
    digits = d.users.select("uid", date_digits("birthday").alias("digits"))
    ranges = tagging.ranged(tagging.level5_rules(d.tags, 338))
    return joins.match_ranges(digits, "digits", ranges).select("uid", "tag_id")


@query("join_left_outer", f"""
  WITH {SQL_PROFILE_ROWS}, p AS (SELECT uid, count(*) AS n_tags FROM profile_rows GROUP BY uid)
  SELECT c_custkey AS uid, n_tags FROM customer LEFT JOIN p ON p.uid = c_custkey
""")
def join_left_outer(d: Data):
    old = d.profile.select("uid", F.size("tag_ids").cast("bigint").alias("n_tags"))
    return d.users.select("uid").join(old, "uid", "left")


@query("join_using_key", f"WITH {SQL_LINES} SELECT order_id, colour, product, o_custkey AS uid FROM lines JOIN orders ON o_orderkey = order_id")
def join_using_key(d: Data):
    return d.lines.join(d.orders.select("order_id", "uid"), "order_id")


@query("join_dim_lookup_default", f"""
  WITH {SQL_LINES}
  SELECT order_id, colour, CASE colour WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3 WHEN 'NO' THEN 4
    WHEN 'RF' THEN 5 ELSE 0 END AS colour_id FROM lines
""")
def join_dim_lookup_default(d: Data):
    lines = d.lines.select("order_id", "colour")
    return joins.lookup_default(lines, "colour", d.colours, "name", "id", "colour_id")


@query("join_multiway_inner", f"""
  WITH {SQL_TAGS}
  SELECT DISTINCT p.p_brand AS merge_name, n.n_name AS owner, t.id AS basic_tag_id, t.name AS basic_tag_name
  FROM (SELECT DISTINCT p_brand, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS no FROM part) b
  JOIN nation n ON n.n_nationkey = b.no - 1
  JOIN part p ON p.p_brand = b.p_brand
  JOIN tags t ON t.id = {PART_BASE} + p.p_partkey
""")
def join_multiway_inner(d: Data):
    """Combined tag x owner map x tag map x basic tag: here one combined tag per brand."""
    part = d.table("part")
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    merge = part.select(number.alias("merge_tag_id"), F.col("p_brand").alias("merge_name")).distinct()
    owners = d.table("nation").select(
        (F.col("n_nationkey") + 1).alias("merge_tag_id"), F.col("n_name").alias("owner")
    )
    tag_map = part.select(number.alias("merge_tag_id"), (F.lit(PART_BASE) + F.col("p_partkey")).alias("basic_tag_id"))
    basic = d.tags.select(F.col("id").alias("basic_tag_id"), F.col("name").alias("basic_tag_name"))
    return (
        tag_map.join(basic, "basic_tag_id").join(merge, "merge_tag_id").join(owners, "merge_tag_id")
        .select("merge_name", "owner", "basic_tag_id", "basic_tag_name").distinct()
    )


@query("join_self_parent_child", f"""
  WITH {SQL_TAGS}
  SELECT t.id AS tag_id, t.name AS tag_name, t.level, c.id AS child_id, c.name AS child_name
  FROM tags t LEFT JOIN tags c ON c.pid = t.id
""")
def join_self_parent_child(d: Data):
    return tree.children(d.tags)


@query("join_semi_keys", """
  SELECT c_custkey, c_name, c_acctbal FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def join_semi_keys(d: Data):
    keys = d.table("orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.rows_with_keys(d.table("customer"), keys, "c_custkey").select("c_custkey", "c_name", "c_acctbal")


@query("join_interval_lookup", """
  WITH ranges AS (SELECT p_partkey * 1000 AS lo, p_partkey * 1000 + p_size * 19 AS hi, p_name AS place FROM part),
  points AS (SELECT event_id, event_id * 193 AS ip FROM events)
  SELECT event_id, ip, lo, place FROM points LEFT JOIN ranges ON ip BETWEEN lo AND hi
""")
def join_interval_lookup(d: Data):
    """Addresses of events looked up in disjoint address ranges."""
    ranges = d.table("part").select(
        (F.col("p_partkey") * 1000).alias("lo"), (F.col("p_partkey") * 1000 + F.col("p_size") * 19).alias("hi"),
        F.col("p_name").alias("place"),
    )
    points = d.table("events").select("event_id", (F.col("event_id") * 193).alias("ip"))
    return joins.interval_lookup(points, "ip", ranges, "lo", "hi").select("event_id", "ip", "lo", "place")
