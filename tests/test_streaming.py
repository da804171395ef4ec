import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.plans.all_queries import run
from tagloom.streaming import index

SMALL = "/root/testdata/sf0.001"


def put(spark, changes, source):
    spark.createDataFrame(changes, index.CHANGE).coalesce(1).write.mode("append").parquet(source)


def follow(spark, root, **options):
    index.follow_changes(spark, f"{root}/in", f"{root}/index", **options).awaitTermination()


def now(spark, root):
    return {r["uid"]: r["tag_ids"] for r in index.current_profiles(spark, f"{root}/index").collect()}


def test_puts_deletes_and_late_changes(spark, folder):
    put(spark, [(1, 1, "put", [10]), (2, 1, "put", [20]), (1, 3, "put", [11])], f"{folder}/in")
    follow(spark, folder)
    assert now(spark, folder) == {1: [11], 2: [20]}
    put(spark, [(2, 5, "delete", None), (3, 1, "put", [30])], f"{folder}/in")
    put(spark, [(1, 2, "put", [99])], f"{folder}/in")  # older than what is known
    follow(spark, folder, files_per_batch=1)
    assert now(spark, folder) == {1: [11], 3: [30]}
    index.compact(spark, f"{folder}/index")
    assert now(spark, folder) == {1: [11], 3: [30]}
    put(spark, [(2, 4, "put", [21]), (3, 2, "delete", None)], f"{folder}/in")  # 2 stays deleted
    follow(spark, folder)
    assert now(spark, folder) == {1: [11]}
    index.compact(spark, f"{folder}/index")
    assert now(spark, folder) == {1: [11]}


def test_a_batch_that_runs_again_changes_nothing(spark, folder):
    write = index._write_delta(f"{folder}/index")
    batch = spark.createDataFrame([(1, 1, "put", [10]), (1, 2, "put", [11])], index.CHANGE)
    write(batch, 0)
    before = now(spark, folder)
    write(batch, 0)
    assert now(spark, folder) == before == {1: [11]}


def test_compaction_leaves_folded_deltas_unread(spark, folder):
    put(spark, [(u, 1, "put", [u]) for u in range(20)], f"{folder}/in")
    follow(spark, folder)
    number = index.compact(spark, f"{folder}/index")
    current = index.current_changes(spark, f"{folder}/index")
    assert number == 1 and any("base/v=1" in f for f in current.inputFiles())
    assert not any("delta" in f for f in current.inputFiles())
    assert len(now(spark, folder)) == 20


def test_timed_commits(spark, folder):
    put(spark, [(1, 1, "put", [10])], f"{folder}/in")
    query = index.follow_changes(spark, f"{folder}/in", f"{folder}/index", files_per_batch=1, every="1 second")
    try:
        query.processAllAvailable()
        assert now(spark, folder) == {1: [10]}
        put(spark, [(1, 2, "delete", None), (2, 1, "put", [20])], f"{folder}/in")
        query.processAllAvailable()
        assert now(spark, folder) == {2: [20]}
    finally:
        query.stop()


def test_empty_index(spark, folder):
    assert now(spark, folder) == {}


@pytest.mark.parametrize("key", ["stm_index_delete", "stm_batched_commit"])
def test_stream_equals_batch(spark, key):
    from tagloom.plans.datasets import Data
    from tagloom.plans.q_streaming import changes

    last = changes(Data(spark, SMALL), deletes=True).groupBy("uid").agg(F.max_by(F.struct("op", "tag_ids"), "seq").alias("c"))
    batch = last.where("c.op = 'put'").select("uid", F.array_join("c.tag_ids", ",").alias("tag_ids"))
    assert rows(run(key, spark, SMALL)) == rows(batch)


def _changes(spark, rows, path):
    spark.createDataFrame(rows, index.CHANGE).coalesce(1).write.mode("append").parquet(path)


def test_compact_without_delta_twice_and_after_a_lost_progress(spark, folder):
    root, source = f"{folder}/index", f"{folder}/changes"
    assert index.compact(spark, root) == 0
    _changes(spark, [(1, 1, "put", [5]), (2, 1, "put", [6])], source)
    index.follow_changes(spark, source, root).awaitTermination()
    first = index.compact(spark, root)
    assert first == 1 and index.compact(spark, root) == 1
    assert rows(index.current_profiles(spark, root)) == [(1, [5]), (2, [6])]
    _changes(spark, [(2, 2, "delete", None)], source)
    index.follow_changes(spark, source, root).awaitTermination()
    _changes(spark, [(3, 1, "put", [7])], source)
    index.follow_changes(spark, source, root).awaitTermination()
    assert index.compact(spark, root) == 3
    assert rows(index.current_profiles(spark, root)) == [(1, [5]), (3, [7])]
    with pytest.raises(RuntimeError):
        index._write_delta(root)(spark.createDataFrame([(9, 1, "put", [1])], index.CHANGE), 0)
