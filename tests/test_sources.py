import os

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from tagloom import session
from tagloom.plans.datasets import Data
from tagloom.sources import keyed, readers
from tagloom.sources.appends import append_batch, appended

SMALL = "/root/testdata/sf0.001"


def test_unknown_source_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown source"):
        readers.open_source(spark, "inType=ftp\nselectFieldNames=a")
    with pytest.raises(ValueError, match="unknown source"):
        readers.open_source(spark, "selectFieldNames=a")


def test_relative_window_needs_a_date(spark):
    text = f"inType=parquet\npath={SMALL}/events.parquet\nselectFieldNames=ts\nwhereCondition=ts#day#3"
    with pytest.raises(ValueError, match="as_of"):
        readers.open_source(spark, text)


def test_typed_wide_table_pushes_filters_and_columns(spark):
    text = (f"inType=parquet\npath={SMALL}/orders.parquet\nselectFieldNames=o_orderkey,o_totalprice\n"
            "filterConditions=o_totalprice[gt]1000,o_orderstatus[eq]F\ntyped=true")
    df = readers.open_source(spark, text)
    plan = plan_text(df)
    assert "GreaterThan(o_totalprice,1000.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan
    assert df.dtypes == [("o_orderkey", "bigint"), ("o_totalprice", "double")]


def test_relative_window_reaches_the_scan(spark):
    data = Data(spark, SMALL)
    text = f"inType=parquet\npath={SMALL}/events.parquet\nselectFieldNames=event_id\nwhereCondition=ts#day#3\ntyped=true"
    plan = plan_text(readers.open_source(spark, text, data.events_as_of))
    # the bounds are evaluated first and handed to the scan (operator 1) as well as to the filter
    assert "PushedFilters: [IsNotNull(ts)]" in plan and "Hosting operator id = 1 " in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_missing_column_passes_only_on_request(table):
    df = table([(1, None), (2, "b")], "k int, v string")
    assert rows(readers.wide_table(df, ["k"], "v[eq]a")) == []
    assert rows(readers.wide_table(df, ["k"], "v[eq]a", missing_passes=True)) == [("1",)]


def test_lines_with_other_field_counts_are_left_out(spark, folder):
    spark.createDataFrame([("1\ta",), ("2\tb\tc",), ("3",), ("4\t",)], "value string").write.text(folder)
    assert rows(readers.typed_lines(spark, folder, ["id", "v"])) == [("1", "a"), ("4", "")]


def test_partitioned_jdbc_options_are_passed_on(spark):
    with pytest.raises(Exception, match="(?i)driver|jdbc|partition"):
        readers.relational(spark, "t", "jdbc:none://x", numPartitions="4").collect()


@pytest.mark.parametrize("kind", ["bigint", "date", "decimal(10,2)", "timestamp_ntz"])
def test_every_row_is_in_one_part_of_the_key(spark, kind):
    shown = {"date": "date_add(DATE '2020-01-01', CAST(k AS INT))", "timestamp_ntz": "CAST(date_add(DATE '2020-01-01', CAST(k AS INT)) AS TIMESTAMP_NTZ)"}
    base = spark.range(900).selectExpr("IF(id % 3 = 0, 7, id * id % 1009) AS k", "id").selectExpr(
        f"IF(id % 50 = 1, NULL, CAST({shown.get(kind, 'k')} AS {kind})) AS k", "id")
    base.createOrReplaceTempView("tagloom_ranged")
    bounds = readers.key_bounds(lambda text: spark.sql(f"SELECT * FROM {text}"), "tagloom_ranged", "k", 8)
    predicates = readers.range_predicates("k", bounds)
    parts = [[r["id"] for r in base.where(p).select("id").collect()] for p in predicates]
    assert 5 <= len(parts) <= 8 and sorted(i for part in parts for i in part) == list(range(900))
    assert max(map(len, parts)) < 900 / 3 + 300  # a third of the rows share a key


def test_parts_of_empty_constant_and_unorderable_keys(spark):
    def bounds(text):
        spark.sql(text).createOrReplaceTempView("tagloom_keys")
        return readers.key_bounds(lambda t: spark.sql(f"SELECT * FROM {t}"), "tagloom_keys", "k", 4)

    assert readers.range_predicates("k", bounds("SELECT 1 AS k FROM range(9)")) == ["1 = 1"]
    assert readers.range_predicates("k", bounds("SELECT 1 AS k FROM range(0)")) == ["1 = 1"]
    with pytest.raises(ValueError):
        readers.range_predicates("k", bounds("SELECT CAST(id AS STRING) AS k FROM range(9)"))


def test_a_large_table_is_not_read_by_one_task(spark, monkeypatch):
    spark.range(20).createOrReplaceTempView("tagloom_counted")
    ask = lambda text: spark.sql(f"SELECT * FROM {text}")
    readers.refuse_large(ask, "tagloom_counted")
    monkeypatch.setattr(readers, "ONE_TASK_ROWS", 19)
    with pytest.raises(ValueError, match="20 rows"):
        readers.refuse_large(ask, "tagloom_counted")


def test_a_batch_is_appended_once(spark, table, folder):
    with pytest.raises(FileNotFoundError):
        appended(spark, folder)
    append_batch(table([(1, "a"), (2, "b")], "k int, s string"), folder, 0)
    append_batch(table([(3, "c")], "k int, s string").repartition(3), folder, 1)
    append_batch(table([(1, "a"), (2, "b")], "k int, s string"), folder, 0)
    assert rows(appended(spark, folder)) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(ValueError):
        append_batch(table([], "k int, s string"), folder, -1)


def test_upsert_replaces_cells_and_keeps_the_rest(table):
    now = table([(1, "a", 10), (2, "b", 20)], "k int, s string, n int")
    new = table([(2, None, 21), (3, "c", None)], "k int, s string, n int")
    once = keyed.upsert(now, new, "k")
    assert rows(once) == [(1, "a", 10), (2, "b", 21), (3, "c", None)]
    assert rows(keyed.upsert(once, new, "k")) == rows(once)
    one_cell = table([(1, 11)], "k int, n int")
    assert rows(keyed.upsert(now, one_cell, "k")) == [(1, "a", 11), (2, "b", 20)]


def test_versions_are_only_visible_when_complete(spark, table, folder):
    with pytest.raises(FileNotFoundError):
        keyed.read_version(spark, folder)
    assert keyed.write_version(table([(1,)], "k int"), folder) == 1
    assert keyed.write_version(keyed.read_version(spark, folder).union(table([(2,)], "k int")), folder) == 2
    os.makedirs(f"{folder}/v=3")  # a write that died
    assert keyed.versions(spark, folder) == [1, 2]
    assert rows(keyed.read_version(spark, folder)) == [(1,), (2,)]
    assert rows(keyed.read_version(spark, folder, 1)) == [(1,)]
    assert keyed.write_version(table([(9,)], "k int"), folder) == 3
    assert rows(keyed.read_version(spark, folder)) == [(9,)]


def test_cells_drop_blanks_and_are_globally_sorted(spark, folder, table):
    wide = table([(i, f"n{i}", " " if i % 2 else "x") for i in range(500)], "id int, Name string, flag string")
    keyed.write_cells(keyed.to_cells(wide, "id", family="detail"), folder)
    back = spark.read.parquet(folder)
    assert back.count() == 750 and back.where("qualifier = 'Name'").count() == 0
    parts = (
        back.groupBy(F.input_file_name().alias("f"))
        .agg(F.min("row_key").alias("lo"), F.max("row_key").alias("hi")).orderBy("lo").collect()
    )
    assert all(a["hi"] <= b["lo"] for a, b in zip(parts, parts[1:]))


def test_global_sort_descending(spark):
    got = [r[0] for r in keyed.sorted_by(spark.range(1000), ["id"], ascending=False).collect()]
    assert got == list(range(999, -1, -1))


def test_latest_change_per_key(table):
    changes = table([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "k int, seq int, v string")
    assert rows(keyed.latest_per_key(changes, "k", ["seq"])) == [(1, 3, "c"), (2, 1, None)]


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert session.fresh_folder(spark, "x").startswith(configured.rstrip("/") + "/")

    class Unset:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "spark://cluster:7077"

    with pytest.raises(RuntimeError):
        session.shared_root(Unset)


def test_sizing_grows_with_the_input():
    small, large = session.sizing(10 << 30, 8), session.sizing(100 << 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "40"
    assert large["spark.sql.shuffle.partitions"] == "50000"


def test_cut_lineage_keeps_rows_and_types(table):
    df = table([(1, [1, 2], "x"), (2, None, None)], "a int, b array<bigint>, c string")
    again = session.cut_lineage(df)
    assert again.dtypes == df.dtypes and rows(again) == rows(df)
    assert "LocalTableScan" not in plan_text(again)
