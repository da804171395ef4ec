"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.functions import bins, conditions, rules
from tagloom.operators import metrics
from tagloom.operators.audience import matching_keys
from tagloom.operators.joins import rows_with_keys
from tagloom.plans.book import query
from tagloom.plans.datasets import LABEL_COLOURS, LABEL_PRODUCTS, SQL_LINES, SQL_TAGS, Data


@query("flt_condition_dsl", """
  SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
  WHERE c_mktsegment <> 'BUILDING' AND c_name >= 'Customer#00000002' AND CAST(c_acctbal AS VARCHAR) > '5'
""")
def flt_condition_dsl(d: Data):
    test = conditions.condition_filter("c_mktsegment[ne]BUILDING,c_name[ge]Customer#00000002,c_acctbal[GT]5")
    return d.table("customer").where(test).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("flt_condition_missing", """
  SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  WHERE quality = 1 OR quality IS NULL
""")
def flt_condition_missing(d: Data):
    """A row that lacks the column passes."""
    joined = d.table("documents").select("doc_id").join(d.table("labels"), "doc_id", "left")
    test = conditions.condition_filter("quality[eq]1", missing_passes=True)
    return joined.where(test).select("doc_id", "quality")


@query("flt_relative_window", """
  WITH a AS (SELECT CAST(max(o_orderdate) AS DATE) + 1 AS as_of FROM orders)
  SELECT 'day' AS unit, o_orderkey FROM orders, a WHERE CAST(o_orderdate AS DATE) BETWEEN as_of - 16 AND as_of - 1
  UNION ALL SELECT 'month', o_orderkey FROM orders, a WHERE CAST(o_orderdate AS DATE) BETWEEN as_of - 91 AND as_of - 1
  UNION ALL SELECT 'year', o_orderkey FROM orders, a WHERE CAST(o_orderdate AS DATE) BETWEEN as_of - 731 AND as_of - 1
""")
def flt_relative_window(d: Data):
    orders, out = d.table("orders"), None
    for text in ("o_orderdate#day#15", "o_orderdate#month#3", "o_orderdate#year#2"):
        hit = orders.where(conditions.relative_window(text, d.orders_as_of)).select(
            F.lit(text.split("#")[1]).alias("unit"), "o_orderkey"
        )
        out = hit if out is None else out.unionByName(hit)
    return out


@query("flt_tag_level", f"""
  WITH {SQL_TAGS}
  SELECT f.id AS tag_id, f.rule AS tag_rule, a.id AS attr_id, a.rule AS attr_rule
  FROM tags f JOIN tags a ON a.pid = f.id WHERE f.level = 4 AND a.level = 5
""")
def flt_tag_level(d: Data):
    tags = d.tags
    rule = tags.where("level = 4").select(F.col("id").alias("tag_id"), F.col("rule").alias("tag_rule"))
    attrs = tags.where("level = 5").select("pid", F.col("id").alias("attr_id"), F.col("rule").alias("attr_rule"))
    return rule.join(attrs, rule["tag_id"] == attrs["pid"]).drop("pid")


@query("flt_compare_typed", """
  SELECT p_partkey FROM part WHERE p_size = 10 OR p_size > 40 OR p_retailprice >= 1050
    OR p_size < 5 OR p_retailprice <= 905 OR p_brand <> 'Brand#17'
""")
def flt_compare_typed(d: Data):
    tests = [
        conditions.compare("p_size", "eq", 10), conditions.compare("p_size", "gt", 40),
        conditions.compare("p_retailprice", "ge", 1050.0), conditions.compare("p_size", "lt", 5),
        conditions.compare("p_retailprice", "le", 905.0), conditions.compare("p_brand", "ne", "Brand#17"),
    ]
    return d.table("part").where(conditions.any_of(tests)).select("p_partkey")


@query("flt_and_or", """
  SELECT o_orderkey FROM orders
  WHERE (o_orderstatus = 'F' AND o_totalprice > 100000) OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O')
""")
def flt_and_or(d: Data):
    c = conditions.compare
    left = conditions.all_of([c("o_orderstatus", "eq", "F"), c("o_totalprice", "gt", 100000)])
    right = conditions.all_of([c("o_orderpriority", "eq", "1-URGENT"), c("o_orderstatus", "eq", "O")])
    return d.table("orders").where(conditions.any_of([left, right])).select("o_orderkey")


@query("flt_null_checks", """
  SELECT 'null' AS kind, d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL
  UNION ALL SELECT 'not null', d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  WHERE quality IS NOT NULL AND toxic IS NOT NULL
""")
def flt_null_checks(d: Data):
    joined = d.table("documents").select("doc_id").join(d.table("labels"), "doc_id", "left")
    missing = joined.where(F.col("quality").isNull()).select(F.lit("null").alias("kind"), "doc_id")
    present = joined.dropna(subset=["quality", "toxic"]).select(F.lit("not null").alias("kind"), "doc_id")
    return missing.unionByName(present)


@query("flt_substring", "SELECT doc_id FROM documents WHERE contains(lower(text), 'tion the')")
def flt_substring(d: Data):
    return d.table("documents").where(conditions.contains_text("text", "TION the")).select("doc_id")


@query("flt_regex", "SELECT page_id FROM pages WHERE regexp_matches(url, '^https://[a-z.]+/(en|fr)/[0-9]+')")
def flt_regex(d: Data):
    return d.table("pages").where(F.col("url").rlike("^https://[a-z.]+/(en|fr)/[0-9]+")).select("page_id")


@query("flt_exact_value", "SELECT conv_id, turn FROM conversations WHERE role = 'assistant'")
def flt_exact_value(d: Data):
    return d.table("conversations").where(conditions.equals_all({"role": "assistant"})).select("conv_id", "turn")


@query("flt_multi_and", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def flt_multi_and(d: Data):
    test = conditions.equals_all({"o_orderstatus": "F", "o_orderpriority": "2-HIGH"})
    return matching_keys(d.table("orders"), "o_custkey", test)


@query("flt_multi_and_first", """
  SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' ORDER BY o_custkey LIMIT 10
""")
def flt_multi_and_first(d: Data):
    """The search for the first keys: the limit is what was asked for."""
    test = conditions.equals_all({"o_orderstatus": "F", "o_orderpriority": "2-HIGH"})
    return matching_keys(d.table("orders"), "o_custkey", test, first=10)


@query("flt_multi_or", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' OR o_orderpriority = '2-HIGH'")
def flt_multi_or(d: Data):
    test = conditions.equals_any({"o_orderstatus": "F", "o_orderpriority": "2-HIGH"})
    return matching_keys(d.table("orders"), "o_custkey", test)


@query("flt_has_column", "SELECT DISTINCT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic IS NOT NULL)")
def flt_has_column(d: Data):
    joined = d.table("documents").select("doc_id").join(d.table("labels"), "doc_id", "left")
    return matching_keys(joined, "doc_id", F.col("toxic").isNotNull())


@query("flt_has_column_first", """
  SELECT DISTINCT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic IS NOT NULL) ORDER BY doc_id LIMIT 10
""")
def flt_has_column_first(d: Data):
    joined = d.table("documents").select("doc_id").join(d.table("labels"), "doc_id", "left")
    return matching_keys(joined, "doc_id", F.col("toxic").isNotNull(), first=10)


@query("flt_key_lookup", """
  SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey IN (SELECT user_id FROM events)
""")
def flt_key_lookup(d: Data):
    keys = d.table("events").select(F.col("user_id").alias("c_custkey"))
    return rows_with_keys(d.table("customer"), keys, "c_custkey").select("c_custkey", "c_name", "c_mktsegment")


@query("flt_key_range", "SELECT p_partkey, p_name FROM part WHERE p_name >= 'cold' AND p_name < 'red'")
def flt_key_range(d: Data):
    return d.table("part").where(conditions.key_range("p_name", "cold", "red")).select("p_partkey", "p_name")


@query("flt_time_range", """
  SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20 12:00:00'
""")
def flt_time_range(d: Data):
    inside = conditions.key_range("ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00")
    return d.table("events").where(inside).select("event_id", "event_type")


@query("flt_name_like", f"WITH {SQL_TAGS} SELECT id, name FROM tags WHERE name LIKE '%ring%'")
def flt_name_like(d: Data):
    return d.tags.where(F.col("name").contains("ring")).select("id", "name")


@query("flt_in_subquery", f"""
  WITH {SQL_TAGS}
  SELECT id, name, level FROM tags WHERE pid IN (SELECT id FROM tags WHERE pid IN (4, 7))
""")
def flt_in_subquery(d: Data):
    tags = d.tags
    parents = tags.where(F.col("pid").isin(4, 7)).select(F.col("id").alias("pid"))
    return tags.join(parents, "pid", "left_semi").select("id", "name", "level")


@query("prj_select_rename_cast", """
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_orderkey AS VARCHAR) AS order_no,
    CAST(round(o_totalprice) AS BIGINT) AS whole_amount FROM orders
""")
def prj_select_rename_cast(d: Data):
    return d.table("orders").select(
        F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("order_no"),
        F.round("o_totalprice", 0).cast("bigint").alias("whole_amount"),
    )


@query("prj_range_buckets", """
  WITH u AS (SELECT o_custkey AS uid, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / 20 AS m
    FROM orders GROUP BY o_custkey)
  SELECT uid,
    CAST(CASE WHEN m >= 200000 THEN 5 WHEN m >= 100000 THEN 4 WHEN m >= 50000 THEN 3 WHEN m >= 10000 THEN 2 ELSE 1 END AS DOUBLE) AS closed,
    CAST(CASE WHEN m < 10000 THEN 1 WHEN m BETWEEN 10000 AND 49999 THEN 2 WHEN m BETWEEN 50000 AND 99999 THEN 3
      WHEN m BETWEEN 100000 AND 199999 THEN 4 WHEN m >= 200000 THEN 5 END AS DOUBLE) AS strict,
    CAST(CASE WHEN n <= 3 THEN 5 WHEN n <= 6 THEN 4 WHEN n <= 9 THEN 3 WHEN n <= 15 THEN 2 ELSE 1 END AS DOUBLE) AS days_closed,
    CAST(CASE WHEN n BETWEEN 1 AND 3 THEN 5 WHEN n BETWEEN 4 AND 6 THEN 4 WHEN n BETWEEN 7 AND 9 THEN 3
      WHEN n BETWEEN 10 AND 15 THEN 2 WHEN n > 16 THEN 1 END AS DOUBLE) AS days_strict
  FROM u
""")
def prj_range_buckets(d: Data):
    per_user = d.orders.groupBy("uid").agg(
        F.count("*").alias("n"), (F.sum("amount").cast("double") / 20).alias("m")
    )
    return per_user.select(
        "uid", bins.RFM_MONETARY.score("m").alias("closed"), bins.RFM_MONETARY.score("m", True).alias("strict"),
        bins.RFM_RECENCY.score("n").alias("days_closed"), bins.RFM_RECENCY.score("n", True).alias("days_strict"),
    )


@query("prj_value_map", """
  SELECT c_custkey AS uid, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 319 WHEN 'MACHINERY' THEN 320 END AS BIGINT) AS tag_id
  FROM customer
""")
def prj_value_map(d: Data):
    tag_of = F.create_map(*[F.lit(x) for x in ("BUILDING", 319, "MACHINERY", 320)])
    return d.users.select("uid", tag_of[F.col("gender")].cast("bigint").alias("tag_id"))


@query("prj_rule_range_struct", """
  SELECT p_partkey AS id, CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size * 1000 AS BIGINT) END AS lo,
    CASE WHEN p_size % 10 = 0 THEN NULL ELSE CAST(p_size * 1000 + p_partkey AS BIGINT) END AS hi FROM part
""")
def prj_rule_range_struct(d: Data):
    size = F.col("p_size") * 1000
    text = F.when(F.col("p_size") % 10 == 0, "no range").otherwise(
        F.concat(size.cast("string"), F.lit("-"), (size + F.col("p_partkey")).cast("string"))
    )
    parsed = d.table("part").select(F.col("p_partkey").alias("id"), rules.range_rule(text).alias("rules"))
    return parsed.select("id", "rules.lo", "rules.hi")


@query("prj_null_fill", """
  SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
    coalesce(CAST(quality AS DOUBLE), 0.00000001) AS score
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def prj_null_fill(d: Data):
    joined = d.table("documents").select("doc_id").join(d.table("labels"), "doc_id", "left")
    scored = joined.withColumn("score", F.coalesce(F.col("quality").cast("double"), F.lit(metrics.NO_DISCOUNT_SCORE)))
    return scored.na.fill(0, ["quality", "toxic"])


@query("prj_or_label", f"""
  WITH {SQL_LINES}
  SELECT order_id, colour, product, CASE WHEN colour IN ('RF', 'RO', 'NF') OR product IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS label
  FROM lines
""")
def prj_or_label(d: Data):
    label = metrics.weak_label("colour", "product", LABEL_COLOURS, LABEL_PRODUCTS)
    return d.lines.withColumn("label", label)
