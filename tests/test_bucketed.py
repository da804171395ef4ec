"""Tables in buckets of a key: results against sets, untouched files, and plans without an exchange of the stored side."""

import glob
import os
import uuid

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from tagloom.operators import profiles
from tagloom.plans import registry
from tagloom.small import small_table
from tagloom.sources.bucketed import PART, BucketedTable

SCHEMA = "uid bigint, tag_ids array<bigint>"


@pytest.fixture()
def store(spark, folder):
    made = BucketedTable(spark, f"t_{uuid.uuid4().hex}", "uid", 16)
    people = [(u, [u % 5, 10 + u % 3]) for u in range(300)] + [(None, [1])]
    yield made.create(small_table(spark, people, SCHEMA), folder), folder
    spark.sql(f"DROP TABLE {made.name}")


def files(folder):
    return {path: os.stat(path).st_mtime_ns for path in glob.glob(f"{folder}/*/*.parquet")}


def test_changes_touch_their_buckets_only(spark, store):
    table, folder = store
    before = files(folder)
    assert len(before) == 16 and table.read().columns == ["uid", "tag_ids"] and table.read().count() == 301
    new = small_table(spark, [(7, 99), (8, 98), (1_000, 97), (7, 96)], "uid bigint, tag_id bigint")
    parts = table.change(new, lambda old, held: profiles.save_merged(profiles.merge_append(held, old), old))
    assert 1 <= len(parts) <= 3
    after = files(folder)
    touched = {path for path in before if any(f"{PART}={p}/" in path for p in parts)}
    assert {p: t for p, t in before.items() if p not in touched}.items() <= after.items() and not touched & after.keys()
    want = {u: [u % 5, 10 + u % 3] for u in range(300)} | {None: [1], 1_000: [97]}
    want[7], want[8] = [2, 11, 96, 99], [3, 12, 98]
    assert {r.uid: list(r.tag_ids) for r in table.read().collect()} == want
    assert table.change(new.limit(0), lambda old, held: old) == []


def test_deletes_and_empty_buckets(spark, store):
    table, folder = store
    gone = table.touched(small_table(spark, [(7,)], "uid bigint"))
    whole = table.rows_of(gone).select("uid")
    assert table.delete(whole.unionByName(small_table(spark, [(55_555,), (12,)], "uid bigint")))
    left = {r.uid for r in table.read().collect()}
    assert 7 not in left and 12 not in left and len(files(folder)) in (15, 16)
    assert table.rows_of(gone).count() == 0
    again = BucketedTable(spark, f"t_{uuid.uuid4().hex}", "uid", 16).attach(SCHEMA, folder)
    assert {r.uid for r in again.read().collect()} == left
    spark.sql(f"DROP TABLE {again.name}")


def test_the_stored_side_is_not_exchanged(spark, store):
    table, _ = store
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        changes = spark.range(100).select(F.col("id").alias("uid"), F.lit(5).cast("bigint").alias("tag_id"))
        fam = small_table(spark, [(5, 350), (6, 350)], "tag_id bigint, family bigint")
        for merged in (profiles.save_merged(profiles.merge_append(changes, table.read()), table.read()), profiles.merge_results([(350, changes)], table.read(), fam)):
            plan = plan_text(merged)
            assert "Bucketed: true" in plan
            tree = plan.split("(1)")[0]
            for line in tree.splitlines():
                if "Exchange" in line:
                    below = tree.splitlines()[tree.splitlines().index(line) + 1 :]
                    assert not any("Scan parquet" in x for x in below[:3])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bound", [2_000, 0])
def test_families_as_masks_and_as_joins(spark, table, monkeypatch, bound):
    small = profiles.small_copy
    monkeypatch.setattr(profiles, "small_copy", lambda df: small(df, bound))
    profile = table([(1, [10, 20]), (2, [11, 21]), (3, None), (4, [10, 11, 99])], SCHEMA)
    fam = table([(10, 1), (11, 1), (20, 2), (21, 2), (99, 3)], "tag_id bigint, family bigint")
    results = [(1, table([(1, 11), (3, 10), (5, 10), (4, None)], "uid bigint, tag_id bigint")), (2, table([(2, 20), (2, 500)], "uid bigint, tag_id bigint"))]
    got = {r.uid: list(r.tag_ids) for r in profiles.merge_results(results, profile, fam).collect()}
    assert got == {1: [11, 20], 2: [11, 20, 500], 3: [10], 4: [10, 11, 99], 5: [10]}


def test_model_runs_into_the_store(spark, store, table):
    kept, folder = store
    registry.register_model("sevens", lambda rows_, rules: rows_.select("uid", F.lit(3).cast("bigint").alias("tag_id")))
    tags = table([(350, "f", "inType=hive\nhiveTable=bucketed_people\nselectFieldNames=uid", 4, 1), (3, "a", "x", 5, 350), (4, "b", "y", 5, 350)],
                 "id bigint, name string, rule string, level int, pid bigint")
    table([(7,), (14,), (70_000,)], "uid bigint").createOrReplaceTempView("bucketed_people")
    before = files(folder)
    parts = registry.run_models_into(kept, spark, tags, [registry.Run(350, "sevens")])
    got = {r.uid: list(r.tag_ids) for r in kept.read().collect()}
    assert got[7] == [2, 3, 11] and got[14] == [3, 12] and got[70_000] == [3] and got[8] == [3, 12] and len(got) == 302
    assert len(before.items() & files(folder).items()) >= 16 - len(parts) >= 13
