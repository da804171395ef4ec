"""Tag models: business rows and level-5 rules in, ``(uid, tag_id)`` out.

``rules`` is always ``(tag_id, rule)``, the level-5 rows of one level-4 tag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions.dates import date_digits, days_since
from tagloom.functions.rules import range_rule
from tagloom.operators.joins import match_ranges, match_values
from tagloom.operators.learning import counted_rows
from tagloom.operators.metrics import gender_by_share, usg_shares
from tagloom.operators.trees import search_trees
from tagloom.session import cut_lineage


def level5_rules(tags: DataFrame, tag_id: int) -> DataFrame:
    """The attribute rules below one level-4 tag."""
    return tags.where((F.col("level") == 5) & (F.col("pid") == tag_id)).select(
        F.col("id").alias("tag_id"), "rule"
    )


def ranged(rules: DataFrame) -> DataFrame:
    """Rules ``lo-hi`` -> ``(tag_id, lo, hi)``; rules of any other kind are left out."""
    parsed = rules.select("tag_id", range_rule("rule").alias("range"))
    return parsed.where(F.col("range").isNotNull()).select("tag_id", "range.lo", "range.hi")


def match_tag(users: DataFrame, field: str, rules: DataFrame, unmatched: str = "drop") -> DataFrame:
    """Field value equals rule: gender, job, nationality, political face, marriage, …"""
    return match_values(users, field, rules, unmatched=unmatched).select("uid", "tag_id")


def age_range_tag(users: DataFrame, rules: DataFrame, birthday: str = "birthday") -> DataFrame:
    digits = users.select("uid", date_digits(birthday).alias("_digits"))
    return match_ranges(digits, "_digits", ranged(rules)).select("uid", "tag_id")


def consume_cycle_tag(
    orders: DataFrame, rules: DataFrame, as_of: Column, time: str = "finish_time"
) -> DataFrame:
    """Days since the user's last finished order, as a range."""
    last = orders.groupBy("uid").agg(F.max(time).alias("_last"))
    aged = last.select("uid", days_since("_last", as_of).alias("_days"))
    return match_ranges(aged, "_days", ranged(rules)).select("uid", "tag_id")


def favourite(orders: DataFrame, code: str = "pay_code") -> DataFrame:
    """Each user's most used code; of equally used codes the smallest.

    Rows are counted per (user, code) first, so the window only sorts a user's distinct codes.
    """
    counted = orders.groupBy("uid", code).agg(F.count("*").alias("uses"))
    best = Window.partitionBy("uid").orderBy(F.desc("uses"), F.asc(code))
    ranked = counted.withColumn("_rank", F.row_number().over(best))
    return ranked.where("_rank = 1").drop("_rank")


def pay_type_tag(orders: DataFrame, rules: DataFrame, code: str = "pay_code") -> DataFrame:
    return match_tag(favourite(orders, code), code, rules)


def gender_share_tag(items: DataFrame, rules: DataFrame, label: str = "label") -> DataFrame:
    """Shopping gender from labelled (or predicted) items."""
    return gender_counts_tag(usg_shares(items, label=label), rules)


def gender_counts_tag(counts: DataFrame, rules: DataFrame) -> DataFrame:
    """The same from ``uid, total, male, female``."""
    named = counts.select("uid", gender_by_share(F.col("total"), F.col("male"), F.col("female")).alias("_class"))
    return match_tag(named, "_class", rules)


def gender_model_tag(
    items: DataFrame, rules: DataFrame, folds: int = 3, depths=(5,), impurities=("gini", "entropy"),
    bins=(32,), key: str | Sequence[str] = "key",
) -> DataFrame:
    """Shopping gender from item labels that a tuned tree predicts.

    ``items`` has the columns of ``key`` and ``uid, label, colour_id, product_id``.  They are counted once per user and
    combination and written; the tree is tuned on the few combinations, weighted, and every user's
    shares are sums of those counts.
    """
    features = ["colour_id", "product_id"]
    counted = cut_lineage(counted_rows(items, ["uid", *features, "label"], key, folds), "items")
    combos = cut_lineage(
        counted.groupBy(*features, F.col("label").cast("double").alias("label"), "fold").agg(
            F.sum("weight").alias("weight")
        ),
        "combinations",
    )
    tree, depth, _ = search_trees(combos, features, range(folds), depths, impurities, bins, features, weight="weight")
    shares = tree.transform(counted, depth=depth).groupBy("uid").agg(
        F.sum("weight").alias("total"),
        F.sum(F.when(F.col("prediction") == 0, F.col("weight")).otherwise(0)).alias("male"),
        F.sum(F.when(F.col("prediction") == 1, F.col("weight")).otherwise(0)).alias("female"),
    )
    return gender_counts_tag(shares, rules)
