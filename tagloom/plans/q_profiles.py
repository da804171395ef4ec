"""Profiles, audiences and the tag tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import audience, bitmaps, profiles, tagging, tree
from tagloom.plans.book import query
from tagloom.plans.datasets import (
    PART_BASE, SQL_CYCLE, SQL_PAY, SQL_PROFILE_ROWS, SQL_TAGS, Data,
)
from tagloom.plans.registry import definitions
from tagloom.session import cut_lineage
from tagloom.sources.bucketed import BucketedTable

_LISTED = "string_agg(CAST(tag_id AS VARCHAR), ',' ORDER BY tag_id)"

# Closure of the tree for the oracle: every node with its ancestors and itself.
_CLOSURE = SQL_TAGS + """, closure AS (
  SELECT t1.id AS id, t1.id AS up, 1 AS up_level FROM tags t1 WHERE t1.level = 1
  UNION ALL SELECT n.id, n.id, n.level FROM tags n WHERE n.level > 1
  UNION ALL SELECT n.id, p.id, p.level FROM tags n JOIN tags p ON p.id = n.pid
  UNION ALL SELECT n.id, g.id, g.level FROM tags n JOIN tags p ON p.id = n.pid JOIN tags g ON g.id = p.pid
  UNION ALL SELECT n.id, h.id, h.level FROM tags n JOIN tags p ON p.id = n.pid JOIN tags g ON g.id = p.pid JOIN tags h ON h.id = g.pid
  UNION ALL SELECT n.id, r.id, r.level FROM tags n JOIN tags p ON p.id = n.pid JOIN tags g ON g.id = p.pid
    JOIN tags h ON h.id = g.pid JOIN tags r ON r.id = h.pid)"""


def _cycle(d: Data):
    return tagging.consume_cycle_tag(d.orders, tagging.level5_rules(d.model_tags, 347), d.orders_as_of)


CYCLE_FAMILY = [*range(348, 356), 385, 386]


@query("prf_load", f"WITH {SQL_PROFILE_ROWS} SELECT uid, {_LISTED} AS tags, count(*) AS n FROM profile_rows GROUP BY uid")
def prf_load(d: Data):
    loaded = profiles.load_profile(d.profile_table)
    return loaded.select(
        "uid", F.array_join(F.array_sort("tag_ids"), ",").alias("tags"), F.size("tag_ids").cast("bigint").alias("n")
    )


@query("prf_merge_append", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_PAY}, merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p JOIN pay ON pay.uid = p.uid UNION SELECT uid, tag_id FROM pay)
  SELECT CAST(uid AS VARCHAR) AS user_id, {_LISTED} AS tag_ids FROM merged GROUP BY uid
""")
def prf_merge_append(d: Data):
    new = tagging.pay_type_tag(d.orders, tagging.level5_rules(d.model_tags, 356))
    return profiles.render_profile(profiles.merge_append(new, d.profile))


@query("prf_merge_replace", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_CYCLE}, merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p JOIN cycle c ON c.uid = p.uid WHERE p.tag_id NOT BETWEEN 348 AND 355
    UNION SELECT uid, tag_id FROM cycle)
  SELECT CAST(uid AS VARCHAR) AS user_id, {_LISTED} AS tag_ids FROM merged GROUP BY uid
""")
def prf_merge_replace(d: Data):
    return profiles.render_profile(profiles.merge_replace(_cycle(d), d.profile, CYCLE_FAMILY))


@query("prf_save", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_CYCLE}, narrow AS (SELECT * FROM cycle WHERE tag_id <= 355), merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p
    WHERE NOT (p.tag_id BETWEEN 348 AND 355 AND p.uid IN (SELECT uid FROM narrow))
    UNION SELECT uid, tag_id FROM narrow)
  SELECT CAST(uid AS VARCHAR) AS user_id, {_LISTED} AS tag_ids FROM merged GROUP BY uid
""")
def prf_save(d: Data):
    """Users the model did not see keep their row, and buckets without seen users their files."""
    path = d.folder_for("profile")
    store = BucketedTable(d.spark, f"profile_{path[-32:]}", "uid", 16).create(d.profile, path)
    narrow = _cycle(d).where(F.col("tag_id") <= 355)
    store.change(narrow, lambda rows, new: profiles.save_merged(profiles.merge_replace(new, rows, CYCLE_FAMILY), rows))
    return profiles.render_profile(store.read())


@query("prf_tag_index", f"WITH {SQL_PROFILE_ROWS} SELECT tag_id, uid FROM profile_rows")
def prf_tag_index(d: Data):
    return audience.tag_index(d.profile)


@query("prf_audience_all", f"""
  WITH {SQL_PROFILE_ROWS}, f AS (SELECT uid, bool_or(tag_id = 333) AS a, bool_or(tag_id IN (319, 320)) AS b,
    bool_or(tag_id IN (348, 349)) AS c FROM profile_rows GROUP BY uid)
  SELECT uid FROM f WHERE a AND b AND c
""")
def prf_audience_all(d: Data):
    """A basic and a combined tag, from bitmaps."""
    index = bitmaps.bitmap_index(d.profile)
    return bitmaps.members(bitmaps.having_all(index, bitmaps.asked_groups(index, [333], [1], d.combined)))


@query("prf_audience_page", f"""
  WITH {SQL_PROFILE_ROWS}, u AS (SELECT uid FROM profile_rows WHERE tag_id IN (319, 334) GROUP BY uid HAVING count(DISTINCT tag_id) = 2)
  SELECT uid FROM u WHERE uid > (SELECT min(uid) FROM u) ORDER BY uid LIMIT 10
""")
def prf_audience_page(d: Data):
    """The page after a user, here after the first one."""
    index = bitmaps.bitmap_index(d.profile)
    found = cut_lineage(bitmaps.having_all(index, bitmaps.asked_groups(index, [319, 334])), "page")
    first = bitmaps.members_page(found, None, 1).first()
    return bitmaps.members_page(found, first["uid"] if first else None, 10)


@query("prf_audience_all_basic", f"""
  WITH {SQL_PROFILE_ROWS} SELECT uid FROM profile_rows WHERE tag_id IN (319, 334) GROUP BY uid HAVING count(DISTINCT tag_id) = 2
""")
def prf_audience_all_basic(d: Data):
    """Read from the stored bitmaps: only the asked tags' row groups are scanned."""
    path = d.folder_for("bitmaps")
    bitmaps.write_index(d.profile, path)
    index = d.spark.read.parquet(path)
    return bitmaps.members(bitmaps.having_all(index, bitmaps.asked_groups(index, [319, 334])))


@query("prf_audience_any", f"WITH {SQL_PROFILE_ROWS} SELECT DISTINCT uid FROM profile_rows WHERE tag_id IN (319, 320) OR tag_id IN (348, 349)")
def prf_audience_any(d: Data):
    return bitmaps.members(bitmaps.below(bitmaps.bitmap_index(d.profile), d.tags, [318, 348, 349]))


@query("prf_audience_count", f"""
  WITH {SQL_PROFILE_ROWS}, u AS (SELECT uid FROM profile_rows WHERE tag_id IN (320, 335) GROUP BY uid HAVING count(DISTINCT tag_id) = 2)
  SELECT count(*) AS users FROM u
""")
def prf_audience_count(d: Data):
    index = bitmaps.bitmap_index(d.profile)
    return bitmaps.users(bitmaps.having_all(index, bitmaps.asked_groups(index, [320, 335])))


@query("prf_tag_counts", f"""
  WITH {SQL_PROFILE_ROWS}
  SELECT tag_id, count(*) AS user_count, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM profile_table) AS share FROM profile_rows GROUP BY tag_id
""")
def prf_tag_counts(d: Data):
    return audience.tag_counts(d.profile)


@query("prf_merge_tag_eval", f"""
  WITH {SQL_PROFILE_ROWS}, f AS (
    SELECT uid, list(tag_id) AS t FROM profile_rows GROUP BY uid)
  SELECT uid, CAST(1 AS BIGINT) AS merge_tag_id FROM f
    WHERE list_has_any(t, [319, 320]) AND list_has_any(t, [348, 349]) AND list_has_any(t, [333])
  UNION ALL SELECT uid, 2 FROM f WHERE list_has_any(t, [333, 334, 335]) AND list_has_any(t, [319])
  UNION ALL SELECT uid, 3 FROM f WHERE list_has_any(t, [350])
  UNION ALL SELECT uid, 4 FROM f WHERE list_has_any(t, [320]) AND list_has_any(t, [336, 351, 352])
""")
def prf_merge_tag_eval(d: Data):
    return audience.combined_members(d.profile, d.combined)


@query("prf_tag_closure", f"WITH {_CLOSURE} SELECT up AS tag_id, c.id AS leaf_id FROM closure c JOIN tags t ON t.id = c.id WHERE t.level = 5")
def prf_tag_closure(d: Data):
    return tree.leaf_closure(d.tags)


@query("prf_tag_path", f"""
  WITH {_CLOSURE}
  SELECT c.id, t.level, string_agg(u.name, ' --- ' ORDER BY c.up_level) AS path
  FROM closure c JOIN tags t ON t.id = c.id JOIN tags u ON u.id = c.up WHERE contains(t.name, 'ring') GROUP BY c.id, t.level
""")
def prf_tag_path(d: Data):
    return tree.paths(d.tags, "ring")


@query("prf_tag_tree", f"""
  WITH {_CLOSURE}, pos AS (
    SELECT id, string_agg(lpad(CAST(up AS VARCHAR), 12, '0'), '/' ORDER BY up_level) AS position FROM closure GROUP BY id),
  kids AS (SELECT pid AS id, count(*) AS n FROM tags GROUP BY pid),
  leaves AS (SELECT up AS id, count(*) AS n FROM closure c JOIN tags t ON t.id = c.id WHERE t.level = 5 GROUP BY up)
  SELECT t.id, t.name, t.level, position, coalesce(kids.n, 0) AS n_children, coalesce(leaves.n, 0) AS n_leaves
  FROM tags t JOIN pos ON pos.id = t.id LEFT JOIN kids ON kids.id = t.id LEFT JOIN leaves ON leaves.id = t.id
""")
def prf_tag_tree(d: Data):
    return tree.outline(d.tags)


@query("prf_user_portrait", f"""
  WITH {_CLOSURE}, {SQL_PROFILE_ROWS}, path AS (
    SELECT c.id, string_agg(u.name, ' --- ' ORDER BY c.up_level) AS path FROM closure c JOIN tags u ON u.id = c.up GROUP BY c.id)
  SELECT DISTINCT p.uid, CAST(c.up_level AS INTEGER) AS level, c.up AS id, t.pid, path.path
  FROM profile_rows p JOIN closure c ON c.id = p.tag_id JOIN tags t ON t.id = c.up JOIN path ON path.id = c.up
""")
def prf_user_portrait(d: Data):
    return audience.portraits(d.profile, d.tags)


@query("prf_entitled_tags", f"""
  WITH {SQL_PROFILE_ROWS}, grants AS (
    SELECT CAST(348 + s_suppkey % 8 AS BIGINT) AS tag_id FROM supplier WHERE s_suppkey = 7
    UNION SELECT CAST(333 + n_regionkey AS BIGINT) FROM nation WHERE n_regionkey IN (2, 3)
    UNION SELECT CAST(319 + n_regionkey % 2 AS BIGINT) FROM nation WHERE n_regionkey IN (2, 3))
  SELECT uid, tag_id FROM profile_rows WHERE tag_id IN (SELECT tag_id FROM grants)
""")
def prf_entitled_tags(d: Data):
    """Supplier 7 with the roles of regions 2 and 3, over all profiles."""
    own = d.table("supplier").select(
        F.col("s_suppkey").alias("principal"), (F.lit(348) + F.col("s_suppkey") % 8).cast("bigint").alias("tag_id")
    )
    region = F.col("n_regionkey")
    role = d.table("nation").select(
        region.alias("role"),
        F.explode(F.array(F.lit(333) + region, F.lit(319) + region % 2).cast("array<bigint>")).alias("tag_id"),
    )
    return audience.entitled(d.profile, own, role, 7, [2, 3])


@query("prf_tag_catalog", f"""
  WITH {SQL_TAGS}, {SQL_PROFILE_ROWS}, n AS (SELECT tag_id, count(*) AS c FROM profile_rows GROUP BY tag_id)
  SELECT a.id AS attr_id, f.id AS tag_id, f.name AS tag_name, f.rule AS tag_rule, f.name || ' model' AS model,
    a.name AS attr_name, coalesce(n.c, 0) AS user_count
  FROM tags f LEFT JOIN tags a ON a.pid = f.id LEFT JOIN n ON n.tag_id = a.id WHERE f.level = 4
""")
def prf_tag_catalog(d: Data):
    tags = d.tags
    models = tags.where("level = 4").select(
        F.col("id").alias("tag_id"), F.concat("name", F.lit(" model")).alias("model")
    )
    return audience.catalogue(tags, models, audience.tag_counts(d.profile).drop("share"))


@query("prf_lookup_user", """
  WITH contacts AS (
    SELECT c_custkey AS uid, c_name AS name, '13' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS phone,
      lower(c_mktsegment) || '.' || c_custkey || '@example.com' AS email, '9' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS qq,
      '11010119500101' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || 'X' AS id_card FROM customer),
  asked AS (
    SELECT DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN phone WHEN '2-HIGH' THEN email WHEN '3-MEDIUM' THEN qq
      WHEN '4-NOT SPECIFIED' THEN id_card ELSE name END AS v FROM orders JOIN contacts ON uid = o_custkey),
  found AS (
    SELECT uid, 'phone' AS kind, name, phone AS v FROM contacts JOIN asked ON v = phone
    UNION ALL SELECT uid, 'email', name, email FROM contacts JOIN asked ON v = email
    UNION ALL SELECT uid, 'qq', name, qq FROM contacts JOIN asked ON v = qq
    UNION ALL SELECT uid, 'id_card', name, id_card FROM contacts JOIN asked ON v = id_card)
  SELECT uid, kind, substr(name, 1, 1) || '**' AS name,
    left(v, 3) || repeat('*', length(v) - 6) || right(v, 3) AS value FROM found
""")
def prf_lookup_user(d: Data):
    """Identifiers of any kind, as they come with orders, looked up among all users."""
    people = d.contacts
    carried = d.orders.select("uid", "pay_code").join(people, "uid")
    code = F.col("pay_code")
    value = (
        F.when(code == "1-URGENT", F.col("phone")).when(code == "2-HIGH", F.col("email"))
        .when(code == "3-MEDIUM", F.col("qq")).when(code == "4-NOT SPECIFIED", F.col("id_card")).otherwise(F.col("name"))
    )
    return audience.find_users(carried.select(value.alias("probe")), people)


@query("prf_merge_families", f"""
  WITH {SQL_PROFILE_ROWS}, {SQL_CYCLE},
  bought AS (SELECT DISTINCT o_custkey AS uid, 1000000 + l_partkey AS tag_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
  merged AS (
    SELECT p.uid, p.tag_id FROM profile_rows p
    WHERE NOT (p.tag_id BETWEEN 348 AND 355 AND p.uid IN (SELECT uid FROM cycle))
    UNION SELECT uid, tag_id FROM cycle UNION SELECT uid, tag_id FROM bought)
  SELECT CAST(uid AS VARCHAR) AS user_id, {_LISTED} AS tag_ids FROM merged GROUP BY uid
""")
def prf_merge_families(d: Data):
    """Every part a user bought as a tag: many tags a user, and a family as large as the part table."""
    bought = d.table("lineitem").join(
        d.orders.select("order_id", "uid"), F.col("l_orderkey") == F.col("order_id")
    ).select("uid", (F.lit(PART_BASE) + F.col("l_partkey")).alias("tag_id")).distinct()
    results = [(347, _cycle(d)), (PART_BASE - 1, bought)]
    return profiles.render_profile(profiles.merge_results(results, d.profile, definitions(d.tags)))
