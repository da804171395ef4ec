"""Keeping the tag index in step with a stream of profile changes.

A change is ``(uid, seq, op, tag_ids)``; ``op`` is ``put`` or ``delete`` and ``seq`` orders the
changes of a user.  A micro-batch is reduced to the last change per user and written as one delta
folder named after the batch, so its cost follows the batch and not the index, and a batch that
runs again after a failure overwrites its own folder.  Readers take the last change per user over
base and deltas; ``compact`` folds deltas into a new base.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import path_exists, remove_path
from tagloom.small import small_table
from tagloom.sources.keyed import latest_per_key, read_version, versions

CHANGE = "uid bigint, seq bigint, op string, tag_ids array<bigint>"


def _write_delta(root: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        folded = _folded(batch.sparkSession, root)
        if batch_id < folded - 1:  # the last folded batch may run again, an older one cannot
            raise RuntimeError(f"batch {batch_id} after batch {folded - 1} was folded: the progress folder was lost")
        last = latest_per_key(batch, "uid", ["seq"])
        last.write.mode("overwrite").parquet(f"{root}/delta/batch={batch_id}")

    return write


def follow_changes(
    spark: SparkSession, source: str, root: str, files_per_batch: int = 1000,
    every: str | None = None,
):
    """Start following a folder of change files.

    ``files_per_batch`` bounds a commit by size and ``every`` by time; without ``every`` the query
    takes what is there and stops.
    """
    changes = (
        spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    writer = changes.writeStream.foreachBatch(_write_delta(root)).option(
        "checkpointLocation", f"{root}/progress"
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _folded(spark: SparkSession, root: str) -> int:
    """Batches below this number are in the base already."""
    known = versions(spark, f"{root}/base")
    return known[-1] if known else 0


def current_changes(spark: SparkSession, root: str) -> DataFrame:
    """The last change of every user, deletions included: base plus the deltas after it."""
    folded = _folded(spark, root)
    parts = [read_version(spark, f"{root}/base", folded)] if folded else []
    if path_exists(spark, f"{root}/delta"):
        deltas = spark.read.schema(f"{CHANGE}, batch bigint").parquet(f"{root}/delta")
        parts.append(deltas.where(F.col("batch") >= folded).drop("batch"))
    if not parts:
        return small_table(spark, [], CHANGE)
    together = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_per_key(together, "uid", ["seq"])


def current_profiles(spark: SparkSession, root: str) -> DataFrame:
    """Users as they stand now; deleted ones are gone."""
    return current_changes(spark, root).where(F.col("op") == "put").select("uid", "tag_ids")


def compact(spark: SparkSession, root: str) -> int:
    """Fold all deltas into a new base, numbered one above the last batch in it, and remove them.

    Run it while no batch is being written.  Tombstones stay in the base, so that an older change
    arriving late cannot bring a user back.  Without a new batch nothing is written.  A failed write
    leaves the old base and all deltas; deltas go only once the new base is complete.
    """
    folded = _folded(spark, root)
    if not path_exists(spark, f"{root}/delta"):
        return folded
    batches = [r["batch"] for r in spark.read.schema(f"{CHANGE}, batch bigint").parquet(f"{root}/delta").select("batch").distinct().collect()]
    new = [b for b in batches if b >= folded]
    if not new:
        return folded
    number = max(new) + 1
    current_changes(spark, root).write.mode("overwrite").parquet(f"{root}/base/v={number}")
    for batch in batches:
        remove_path(spark, f"{root}/delta/batch={batch}")
    return number
