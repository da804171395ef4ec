"""Keeping trained models: load what is stored, else train and store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from tagloom.session import path_exists


def load_or_train(spark: SparkSession, path: str, loader: Callable, train: Callable):
    """``loader`` is a model class (``KMeansModel``, ``PipelineModel``); ``train`` makes one."""
    if path_exists(spark, f"{path}/metadata/_SUCCESS"):
        return loader.load(path)
    model = train()
    model.write().overwrite().save(path)
    return model
