"""The five-level tag tree ``(id, name, rule, level, pid)``; a root has ``pid`` -1.

The tree is walked with one join per level: five levels need four joins, all of them distributed,
and no row limit applies.  The levels above the leaves are joined with one another first; the
leaves, which are by far the most numerous, are joined once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import cut_lineage

DEPTH = 5
PATH_SEPARATOR = " --- "


def level_lineages(tags: DataFrame, level: int) -> DataFrame:
    """Tags of one level with the ids and names from the root down to them: ``(id, line, names)``."""
    node = tags.where(F.col("level") == level)
    if level == 1:
        return node.select("id", F.array("id").alias("line"), F.array("name").alias("names"))
    return _one_down(node, level_lineages(tags, level - 1))


def _one_down(node: DataFrame, above: DataFrame) -> DataFrame:
    step = node.alias("n").join(above.alias("p"), F.col("n.pid") == F.col("p.id"))
    return step.select(
        F.col("n.id").alias("id"),
        F.concat("p.line", F.array("n.id")).alias("line"),
        F.concat("p.names", F.array("n.name")).alias("names"),
    )


def lineages(tags: DataFrame) -> DataFrame:
    """Every tag of the tree with its line of ids and names, root first."""
    return reduce(DataFrame.unionByName, [level_lineages(tags, n) for n in range(1, DEPTH + 1)])


def leaf_closure(tags: DataFrame) -> DataFrame:
    """``(tag_id, leaf_id)`` for every tag and every level-5 tag below it (a leaf is its own)."""
    leaves = level_lineages(tags, DEPTH)
    return leaves.select(F.explode("line").alias("tag_id"), F.col("id").alias("leaf_id"))


def leaves_of(tags: DataFrame, tag_ids: list[int]) -> DataFrame:
    """Level-5 tags below any of the given tags, each once: walks down from the asked tags only."""
    asked = tags.where(F.col("id").isin(list(tag_ids))).select("id", "level")
    found = asked.where(F.col("level") == DEPTH).select("id")
    for level in range(1, DEPTH):
        below = asked.where(F.col("level") == level).select("id")
        for step in range(level, DEPTH):
            parents = below.withColumnRenamed("id", "pid")
            below = tags.where(F.col("level") == step + 1).join(parents, "pid", "left_semi").select("id")
        found = found.unionByName(below)
    return found.distinct().withColumnRenamed("id", "leaf_id")


def paths(tags: DataFrame, name_part: str | None = None) -> DataFrame:
    """``level 1 --- … --- tag`` for the tags whose name contains ``name_part``."""
    found = lineages(tags)
    if name_part is not None:
        found = found.where(F.element_at("names", -1).contains(name_part))
    return found.select(
        "id", F.size("line").alias("level"), F.array_join("names", PATH_SEPARATOR).alias("path")
    )


def children(tags: DataFrame) -> DataFrame:
    """Every tag with each of its children; a tag without children once, with NULLs.

    Written as an inner join plus the childless tags: the many children of one parent can then be
    split over tasks, which an outer join does not allow.
    """
    parent = tags.select(F.col("id").alias("tag_id"), F.col("name").alias("tag_name"), "level")
    child = tags.select(F.col("pid").alias("tag_id"), F.col("id").alias("child_id"),
                        F.col("name").alias("child_name"))
    found = child.join(parent, "tag_id")
    childless = parent.join(child.select("tag_id").distinct(), "tag_id", "left_anti")
    return found.unionByName(childless, allowMissingColumns=True).select(*parent.columns, "child_id", "child_name")


def outline(tags: DataFrame) -> DataFrame:
    """The tree as rows in depth-first order: ``position`` sorts, children follow their parent.

    Lines above the leaves are written once.  Children are counted by parent before they are joined, and only
    ids and counts go up the lines.  Names and positions are grouped once a node, dealt by id beforehand, so a
    task sorts a part of the nodes only; no node's children are gathered into one row.
    """
    above = cut_lineage(reduce(DataFrame.unionByName, [level_lineages(tags, n) for n in range(1, DEPTH)]), "lineages")
    depth = F.size("line")
    leaves = _one_down(tags.where(F.col("level") == DEPTH), above.where(depth == DEPTH - 1))
    position = F.array_join(F.transform("line", lambda i: F.lpad(i.cast("string"), 12, "0")), "/")
    own = above.unionByName(leaves).select(
        "id", F.element_at("names", -1).alias("name"), depth.alias("level"), position.alias("position"),
        F.lit(0).cast("bigint").alias("n_children"), F.when(depth == DEPTH, 1).otherwise(0).cast("bigint").alias("n_leaves"),
    )
    below = tags.groupBy(F.col("pid").alias("id"), (F.col("level") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n"))
    met = above.select("id", "line", depth.alias("depth")).join(below, ["id", "depth"])
    up = met.select("n", "depth", F.posexplode("line").alias("at", "id"))
    counted = up.groupBy("id").agg(
        F.sum(F.when(F.col("at") + 1 == F.col("depth"), F.col("n")).otherwise(0)).alias("n_children"),
        F.sum(F.when(F.col("depth") + 1 == DEPTH, F.col("n")).otherwise(0)).alias("n_leaves"),
    )
    return own.unionByName(counted, allowMissingColumns=True).repartition("id").groupBy("id").agg(
        F.max("name").alias("name"), F.max("level").alias("level"), F.max("position").alias("position"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
    )
