"""The profile table ``(uid, tag_ids array<bigint>)`` and how model results enter it.

Model results are ``(uid, tag_id)``; a row without a tag says nothing about its user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.bounds import small_copy
from tagloom.functions import lists


def load_profile(table: DataFrame, user: str = "user_id", tags: str = "tag_ids") -> DataFrame:
    """Stored comma text -> arrays."""
    return table.select(
        F.col(user).cast("bigint").alias("uid"), lists.split_list(tags).alias("tag_ids")
    )


def render_profile(profile: DataFrame) -> DataFrame:
    """Arrays -> the comma text that is stored."""
    return profile.select(
        F.col("uid").cast("string").alias("user_id"), lists.join_list("tag_ids").alias("tag_ids")
    )


def _per_user(model: DataFrame) -> DataFrame:
    """All new tags of a user in one row, sorted."""
    rows = model.where(F.col("tag_id").isNotNull())
    return rows.groupBy("uid").agg(F.array_sort(F.collect_set(F.col("tag_id").cast("bigint"))).alias("_add"))


def merge_append(model: DataFrame, profile: DataFrame) -> DataFrame:
    """Users of ``model`` with their new tags added, one row each; a user without a profile starts one."""
    old = profile.select("uid", F.col("tag_ids").alias("_old"))
    return _per_user(model).join(old, "uid", "left").select("uid", lists.append_tags("_old", "_add").alias("tag_ids"))


def merge_replace(model: DataFrame, profile: DataFrame, siblings: Sequence[int]) -> DataFrame:
    """As ``merge_append``, but earlier tags of the same family give way to the new ones."""
    old = profile.select("uid", F.col("tag_ids").alias("_old"))
    family = lists.tag_array(siblings)
    return _per_user(model).join(old, "uid", "left").select(
        "uid", lists.replace_family("_old", family, "_add").alias("tag_ids")
    )


def merge_results(results: Sequence[tuple[int, DataFrame]], profile: DataFrame, definitions: DataFrame) -> DataFrame:
    """Merge the results of many runs in one pass and keep every user of either side.

    ``results`` pairs the family of a run (its level-4 tag) with ``(uid, tag_id)``; ``definitions``
    has ``tag_id, family``.  One rule for any size: for the users a run saw, the tags that the
    definitions place in the run's family give way; then every tag of the run is added, also one
    that the definitions do not know or place elsewhere.

    Everything is joined by user.  Families of a measured size are masks on the array in the user's row, so that
    the profile is read once and shuffled only if it is not stored by user; larger families meet the old tags by
    an inner join that Spark broadcasts or splits by size.  The lists gathered are a user's own tags.
    """
    fresh = None
    for family, result in results:
        rows = result.where(F.col("tag_id").isNotNull()).select(
            "uid", F.lit(family).cast("bigint").alias("_family"), F.col("tag_id").cast("bigint").alias("_tag")
        )
        fresh = rows if fresh is None else fresh.unionByName(rows)
    per_user = fresh.groupBy("uid").agg(F.collect_set("_tag").alias("_add"), F.collect_set("_family").alias("_families"))
    asked = definitions.where(F.col("family").isin([family for family, _ in results])).select("tag_id", "family")
    old = profile.select("uid", F.col("tag_ids").alias("_old"))
    none = F.array().cast(lists.EMPTY)
    few = small_copy(asked)
    if few is not None:
        members: dict[int, set[int]] = {}
        for tag, family in few.collect():  # a local relation is collected without a job
            members.setdefault(family, set()).add(tag)
        joined = old.join(per_user, "uid", "full")
        kept = F.coalesce("_old", none)
        for family, tags in members.items():
            seen = F.coalesce(F.array_contains("_families", F.lit(family).cast("bigint")), F.lit(False))
            kept = F.when(seen, F.array_except(kept, lists.tag_array(sorted(tags)))).otherwise(kept)
    else:
        placed = profile.select("uid", F.explode("tag_ids").alias("tag_id")).join(asked, "tag_id")
        held = placed.groupBy("uid").agg(F.collect_set(F.struct("tag_id", "family")).alias("_held"))
        joined = old.join(per_user, "uid", "full").join(held, "uid", "left")
        gone = F.transform(
            F.filter("_held", lambda x: F.array_contains(F.col("_families"), x["family"])), lambda x: x["tag_id"]
        )
        kept = F.array_except(F.coalesce("_old", none), F.coalesce(gone, none))
    return joined.select("uid", F.array_sort(F.array_union(kept, F.coalesce("_add", none))).alias("tag_ids"))


def save_merged(merged: DataFrame, profile: DataFrame) -> DataFrame:
    """The next state of the whole table: merged rows win, all other users stay."""
    new = merged.select("uid", F.col("tag_ids").alias("_new"))
    old = profile.select("uid", F.col("tag_ids").alias("_old"))
    return old.join(new, "uid", "full").select("uid", F.coalesce("_new", "_old").alias("tag_ids"))


def exploded(profile: DataFrame, tags: Column | str = "tag_ids") -> DataFrame:
    """One row per user and tag."""
    return profile.select("uid", F.explode(tags).alias("tag_id"))
