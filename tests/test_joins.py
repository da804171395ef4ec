import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from tagloom import bounds
from tagloom.operators import joins


def test_gender_fixture(table):
    users = table([(1, "2"), (10, "2"), (100, "2"), (102, "2"), (101, "1"), (103, "1"), (104, "1")], "uid int, gender string")
    rules = table([(319, "1"), (320, "2")], "tag_id bigint, rule string")
    got = rows(joins.match_values(users, "gender", rules), "uid", "tag_id")
    assert got == sorted([(u, 320) for u in (1, 10, 100, 102)] + [(u, 319) for u in (101, 103, 104)], key=repr)


def test_unmatched_modes(table):
    users = table([(1, "1"), (2, "9"), (3, None)], "uid int, v string")
    rules = table([(319, "1")], "tag_id bigint, rule string")
    assert rows(joins.match_values(users, "v", rules), "uid", "tag_id") == [(1, 319)]
    assert rows(joins.match_values(users, "v", rules, unmatched="null"), "uid", "tag_id") == [(1, 319), (2, None), (3, None)]
    with pytest.raises(Exception, match="no rule for value"):
        joins.match_values(users, "v", rules, unmatched="fail").collect()
    with pytest.raises(ValueError):
        joins.match_values(users, "v", rules, unmatched="maybe")


def _brute(points, intervals):
    return sorted(((p, lo, hi) for p in points for lo, hi in intervals if lo <= p <= hi), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interval_lookup_equals_brute_force(table, seed):
    draw = random.Random(seed)
    points = [draw.randint(-3000, 3000) for _ in range(300)] + [7] * 150
    intervals = []
    for width in (1, 1, 2, 3, 5, 64, 65, 1000, 4000):
        for _ in range(8):
            lo = draw.randint(-3500, 3000)
            intervals.append((lo, lo + width - 1))
    left = table([(p,) for p in points], "p bigint")
    right = table(intervals, "lo bigint, hi bigint")
    inner = joins.interval_lookup(left, "p", right, "lo", "hi", how="inner")
    assert rows(inner) == _brute(points, intervals)


def test_interval_lookup_keeps_points_outside(table):
    left = table([(1, 5), (2, 50), (3, None), (4, 20)], "id int, p bigint")
    right = table([(0, 9, "a"), (10, 20, "b")], "lo bigint, hi bigint, name string")
    got = rows(joins.interval_lookup(left, "p", right, "lo", "hi"), "id", "name")
    assert got == [(1, "a"), (2, None), (3, None), (4, "b")]
    nothing = right.where("lo > 100")
    assert rows(joins.interval_lookup(left, "p", nothing, "lo", "hi"), "id", "name") == [(i, None) for i in (1, 2, 3, 4)]


def test_ranges_above_the_bound_do_not_broadcast_blindly(table, monkeypatch):
    points = table([(i, i * 3) for i in range(200)], "uid int, days int")
    rules = table([(1000 + n, n * 10, n * 10 + 9) for n in range(50)], "tag_id bigint, lo bigint, hi bigint")
    small = joins.match_ranges(points, "days", rules)
    assert "BroadcastHashJoin" in plan_text(small) and "NestedLoop" not in plan_text(small)
    monkeypatch.setattr(joins, "small_copy", lambda df: None)
    large = joins.match_ranges(points, "days", rules)
    assert "NestedLoop" not in plan_text(large)
    assert rows(small) == rows(large)


def test_placed_intervals_are_broadcast_only_when_counted_few(spark):
    """Spark takes the placed intervals, with their cells and salts, for as small as the ones it reads."""
    points = spark.range(9000).select("id", (F.col("id") * 7 % 5000).alias("p"))
    ranges = spark.range(2500).select((F.col("id") * 2).alias("lo"), (F.col("id") * 2 + F.col("id") % 2).alias("hi"))
    many = joins.interval_lookup(points, "p", ranges, "lo", "hi", how="inner")
    assert "BroadcastExchange" not in plan_text(many)
    want = sorted((i, i * 7 % 5000) for i in range(9000) if i * 7 % 5000 % 2 == 0 or (i * 7 % 5000) // 2 % 2)
    assert rows(many, "id", "p") == sorted(want, key=repr)
    few = joins.interval_lookup(points, "p", ranges.where("lo < 4000"), "lo", "hi", how="inner")
    assert "BroadcastHashJoin" in plan_text(few) and "_salt" not in plan_text(few)
    assert rows(few, "id", "p") == sorted([(i, p) for i, p in want if p < 4000], key=repr)


def test_small_copy(spark):
    assert rows(bounds.small_copy(spark.range(10), 10)) == [(i,) for i in range(10)]
    assert "LocalTableScan" in plan_text(bounds.small_copy(spark.range(3), 10))
    assert bounds.small_copy(spark.range(11), 10) is None


def test_lookup_default(table):
    df = table([("a",), ("z",), (None,)], "name string")
    dim = table([(1, "a")], "id int, name string")
    assert rows(joins.lookup_default(df, "name", dim, "name", "id", "out"), "name", "out") == [("a", 1), ("z", 0), (None, 0)]


def test_semi_join_does_not_multiply(table):
    df = table([(1, "x"), (2, "y")], "k int, v string")
    keys = table([(1,), (1,), (3,)], "k int")
    assert rows(joins.rows_with_keys(df, keys, "k"), "k", "v") == [(1, "x")]
