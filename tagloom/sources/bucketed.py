"""Tables stored in buckets of a key: changes read and write only the buckets they touch.

Each bucket is a partition folder with a sorted bucket file of its own.  Joins on the key need no exchange of the
stored side, and a change replaces only the folders of its keys; all other files stay as they are.  The
number of buckets is fixed when a table is made and bounds what the driver hears of a change.

A change is staged as a table of its own before folders are replaced, so a lost executor repeats a task and not the
change, and a change that was broken off is completed by making it again.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import cut_lineage, fresh_folder, remove_path

PART = "bucket_part"


@dataclass(frozen=True)
class BucketedTable:
    """A table ``name`` of the session's catalogue, in ``buckets`` folders by the hash of ``key``."""

    spark: SparkSession
    name: str
    key: str
    buckets: int

    def _part(self) -> Column:
        """The bucket of a key, as Spark's own bucketing numbers it."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets)).alias(PART)

    def create(self, df: DataFrame, path: str) -> BucketedTable:
        """Store ``df`` below ``path``; rows without a key are in the bucket that the hash of null falls into."""
        dealt = df.select("*", self._part()).repartition(self.buckets, F.col(self.key))
        writer = dealt.write.partitionBy(PART).bucketBy(self.buckets, self.key).sortBy(self.key)
        writer.format("parquet").option("path", path).saveAsTable(self.name)
        return self

    def attach(self, columns: str, path: str) -> BucketedTable:
        """Name a table again that an earlier session stored below ``path``; ``columns`` as in SQL, the key among them."""
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}, {PART} INT) USING parquet PARTITIONED BY ({PART}) "
            f"CLUSTERED BY ({self.key}) SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def touched(self, changes: DataFrame) -> list[int]:
        """The buckets of the keys of ``changes``; at most ``buckets`` numbers reach the driver."""
        return sorted(row[0] for row in changes.select(self._part()).distinct().collect())

    def rows_of(self, parts: list[int]) -> DataFrame:
        """The rows of some buckets; the other folders are not listed."""
        return self.spark.table(self.name).where(F.col(PART).isin(parts)).drop(PART)

    def replace(self, parts: list[int], rows: DataFrame) -> None:
        """Put ``rows``, all of which belong to ``parts``, in the place of everything in these buckets."""
        path = fresh_folder(self.spark, "staged")
        rows.select("*", self._part()).select(*self.spark.table(self.name).columns).write.parquet(path)
        # a session of its own, so that the setting holds for this write only; the catalogue is shared
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        staged = session.read.parquet(path)
        staged.repartition(self.buckets, F.col(self.key)).write.mode("overwrite").insertInto(self.name)
        filled = {row[0] for row in staged.select(PART).distinct().collect()}
        for part in sorted(set(parts) - filled):
            folder = f"{self._location()}/{PART}={part}"
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PART} = {part})")
            remove_path(self.spark, folder)  # an external table keeps the files of a dropped partition
        self.spark.catalog.refreshTable(self.name)

    def _location(self) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Location'")
        return described.first()["data_type"].rstrip("/")

    def change(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """``merge(current rows, changes)`` for the touched buckets only; returns these.

        ``merge`` gives the next rows of the users of both sides, and none of other keys.
        """
        held = cut_lineage(changes, "changes")
        parts = self.touched(held)
        if parts:
            self.replace(parts, merge(self.rows_of(parts), held))
        return parts

    def delete(self, keys: DataFrame) -> list[int]:
        return self.change(keys.select(self.key).distinct(), lambda rows, gone: rows.join(gone, self.key, "left_anti"))
