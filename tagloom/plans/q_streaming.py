"""Index upkeep.  Orders serve as the stream of profile changes of their customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.lists import join_list
from tagloom.plans.book import query
from tagloom.plans.datasets import Data
from tagloom.streaming import index

_LAST = """WITH last AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders)
  SELECT o_custkey AS uid, CAST(348 + o_orderkey % 8 AS VARCHAR) || ',' || CAST(356 + CAST(left(o_orderpriority, 1) AS INTEGER) AS VARCHAR) AS tag_ids
  FROM last WHERE rn = 1"""


def changes(d: Data, deletes: bool) -> DataFrame:
    op = F.when((F.col("o_orderstatus") == "F") & F.lit(deletes), "delete").otherwise("put")
    tags = F.array(
        (F.lit(348) + F.col("o_orderkey") % 8).cast("bigint"),
        (F.lit(356) + F.substring("o_orderpriority", 1, 1).cast("int")).cast("bigint"),
    )
    return d.table("orders").select(
        F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("seq"), op.alias("op"), "o_orderstatus",
        tags.alias("tag_ids"),
    )


def _shown(df: DataFrame) -> DataFrame:
    return df.select("uid", join_list("tag_ids").alias("tag_ids"))


@query("stm_index_upsert", _LAST)
def stm_index_upsert(d: Data):
    root = d.folder_for("stream")
    changes(d, deletes=False).drop("o_orderstatus").repartition(4).write.parquet(f"{root}/changes")
    index.follow_changes(d.spark, f"{root}/changes", f"{root}/index").awaitTermination()
    return _shown(index.current_profiles(d.spark, f"{root}/index"))


@query("stm_index_delete", _LAST + " AND o_orderstatus <> 'F'")
def stm_index_delete(d: Data):
    root = d.folder_for("stream")
    changes(d, deletes=True).drop("o_orderstatus").repartition(4).write.parquet(f"{root}/changes")
    index.follow_changes(d.spark, f"{root}/changes", f"{root}/index").awaitTermination()
    return _shown(index.current_profiles(d.spark, f"{root}/index"))


@query("stm_batched_commit", _LAST + " AND o_orderstatus <> 'F'")
def stm_batched_commit(d: Data):
    """Two files per commit; compacted between two runs of the stream, the second of which also
    brings changes older than those already folded in."""
    root = d.folder_for("stream")
    feed = changes(d, deletes=True)
    feed.where("o_orderstatus <> 'O'").drop("o_orderstatus").repartition(4).write.mode("append").parquet(f"{root}/changes")
    index.follow_changes(d.spark, f"{root}/changes", f"{root}/index", files_per_batch=2).awaitTermination()
    index.compact(d.spark, f"{root}/index")
    feed.where("o_orderstatus = 'O'").drop("o_orderstatus").repartition(4).write.mode("append").parquet(f"{root}/changes")
    index.follow_changes(d.spark, f"{root}/changes", f"{root}/index", files_per_batch=2).awaitTermination()
    return _shown(index.current_profiles(d.spark, f"{root}/index"))
