"""Intermediate tables of one run, in the folder that the whole cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import fresh_folder


class Scratch:
    """Tables below one folder of ``spark.checkpoint.dir``.

    ``keep`` writes a step and reads it back, so that a lost executor never restarts what came
    before it; ``drop`` removes steps that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = fresh_folder(spark, purpose)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
