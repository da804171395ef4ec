"""Tag models by name, and whole model runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import profiles
from tagloom.operators.tagging import level5_rules
from tagloom.sources.bucketed import BucketedTable
from tagloom.sources.readers import open_source, tag_rule

Model = Callable[[DataFrame, DataFrame], DataFrame]

_models: dict[str, Model] = {}


def register_model(name: str, fn: Model) -> None:
    """``fn(business rows, (tag_id, rule) rows)`` returns ``(uid, tag_id)``."""
    _models[name] = fn


def model(name: str) -> Model:
    if name not in _models:
        raise LookupError(f"no model {name!r}; known: {sorted(_models)}")
    return _models[name]


@dataclass(frozen=True)
class Run:
    tag_id: int
    model: str


def model_result(
    spark: SparkSession, tags: DataFrame, run: Run, as_of: Column | None = None,
    sources: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Definitions -> rule -> source -> model.  ``sources`` replaces the rule's source by tag id."""
    if sources and run.tag_id in sources:
        business = sources[run.tag_id]
    else:
        business = open_source(spark, tag_rule(tags, run.tag_id), as_of)
    return model(run.model)(business, level5_rules(tags, run.tag_id))


def definitions(tags: DataFrame) -> DataFrame:
    """``tag_id, family``: every attribute with the level-4 tag it belongs to."""
    return tags.where("level = 5").select(F.col("id").alias("tag_id"), F.col("pid").alias("family"))


def run_models(
    spark: SparkSession, tags: DataFrame, runs: list[Run], profile: DataFrame, as_of: Column | None = None,
) -> DataFrame:
    """The next profile table after running all models; errors are not swallowed."""
    results = [(run.tag_id, model_result(spark, tags, run, as_of)) for run in runs]
    return profiles.merge_results(results, profile, definitions(tags))


def run_models_into(
    store: BucketedTable, spark: SparkSession, tags: DataFrame, runs: list[Run], as_of: Column | None = None,
) -> list[int]:
    """Run all models and merge their results into stored profiles ``(uid, tag_ids)``; returns the touched buckets.

    Only the buckets of users that a model saw are read and written, without a shuffle of the stored side.
    """
    results = [(run.tag_id, model_result(spark, tags, run, as_of)) for run in runs]
    rows = reduce(DataFrame.unionByName, [
        result.where(F.col("tag_id").isNotNull()).select("uid", F.lit(family).cast("bigint").alias("family"), F.col("tag_id").cast("bigint").alias("tag_id"))
        for family, result in results
    ])

    def merge(profile: DataFrame, changes: DataFrame) -> DataFrame:
        parts = [(family, changes.where(F.col("family") == family).select("uid", "tag_id")) for family, _ in results]
        return profiles.merge_results(parts, profile, definitions(tags))

    return store.change(rows, merge)
