"""The book of registered queries: a key, a plan over the given tables, and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.plans.datasets import Data

PLANS: dict[str, Callable[[Data], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    def keep(plan: Callable[[Data], DataFrame]):
        if key in PLANS:
            raise ValueError(f"query {key} is registered twice")
        PLANS[key] = plan
        if oracle is not None:
            ORACLES[key] = oracle
        return plan

    return keep


def run(key: str, spark: SparkSession, folder: str) -> DataFrame:
    return PLANS[key](Data(spark, folder))
