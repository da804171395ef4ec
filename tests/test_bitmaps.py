"""Bitmap audiences against sets, and the plans they make."""

import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from tagloom.operators import audience, bitmaps
from tagloom.small import small_table

EDGES = [0, -1, 1, 32_768, 32_769, -32_767, -32_768, -32_769, 65_536, 65_537, 10**12, -(10**12)]


@pytest.fixture(scope="module")
def people():
    rng = random.Random(5)
    ids = EDGES + sorted({rng.randrange(-100_000, 100_000) for _ in range(1_500)} - set(EDGES))
    return {uid: {t for t in range(12) if rng.random() < 0.35} for uid in ids}


def frame(spark, people):
    return small_table(spark, [(u, sorted(t)) for u, t in people.items()], "uid bigint, tag_ids array<bigint>")


@pytest.fixture(scope="module")
def index(spark, people):
    from tagloom.session import fresh_folder

    folder = fresh_folder(spark, "bitmaps")
    none = small_table(spark, [(None, [1, 2]), (7_000_000, None), (7_000_001, [])], "uid bigint, tag_ids array<bigint>")
    bitmaps.write_index(frame(spark, people).unionByName(none), folder, 4)
    return spark.read.parquet(folder)


def ids(df):
    return [r[0] for r in rows(df)]


def test_all_any_and_counts(spark, people, index):
    for basic in ([1], [1, 2], [0, 3, 5], [1, 99]):
        want = sorted(u for u, t in people.items() if set(basic) <= t)
        found = bitmaps.having_all(index, bitmaps.asked_groups(index, basic))
        assert sorted(ids(bitmaps.members(found))) == want and bitmaps.users(found).collect() == [(len(want),)]
    some = small_table(spark, [(3,), (4,), (4,), (99,)], "tag_id bigint")
    assert sorted(ids(bitmaps.members(bitmaps.having_any(index, some)))) == sorted(u for u, t in people.items() if t & {3, 4})
    assert bitmaps.users(bitmaps.having_any(index, some.limit(0))).collect() == [(0,)]


def test_groups_of_basic_and_combined_tags(spark, people, index):
    tag_map = small_table(spark, [(1, 1, 2, "or"), (1, 2, 3, "and"), (1, 3, 5, None), (2, 1, 7, None)], "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string")
    found = bitmaps.having_all(index, bitmaps.asked_groups(index, [0], [1, 2], tag_map))
    want = sorted(u for u, t in people.items() if 0 in t and t & {2, 3} and 5 in t and 7 in t)
    assert sorted(ids(bitmaps.members(found))) == want
    profile = frame(spark, people)
    assert sorted(ids(audience.audience_all(profile, [0], [1, 2], tag_map))) == want


def test_pages(people, index, spark):
    found = bitmaps.having_any(index, small_table(spark, [(3,), (4,)], "tag_id bigint"))
    want = sorted(u for u, t in people.items() if t & {3, 4})
    for after, size in ((None, 5), (want[0], 7), (want[100], 50), (want[-3], 10), (want[-1], 5), (-32_768, 40), (0, 3), (32_768, 4), (10**13, 4)):
        got = [r[0] for r in bitmaps.members_page(found, after, size).collect()]
        assert got == [u for u in want if after is None or u > after][:size]


def test_update_of_some_users(spark, people, index):
    rng = random.Random(6)
    changed = {u: (people.get(u, set()), {t for t in range(14) if rng.random() < 0.3}) for u in [*rng.sample(sorted(people), 200), 5_000_000, 5_000_001]}
    before, after = (frame(spark, {u: x[i] for u, x in changed.items()}) for i in (0, 1))
    whole = {**people, **{u: x[1] for u, x in changed.items()}}
    got = rows(bitmaps.updated(index, before, after), "tag_id", "bucket", "bits")
    assert got == rows(bitmaps.bitmap_index(frame(spark, whole)), "tag_id", "bucket", "bits")


@pytest.mark.parametrize("bound", [2_000, 0])
def test_masks_and_bitmaps_agree(spark, people, monkeypatch, bound):
    """Combined tags and grants on both sides of the bound."""
    small = audience.small_copy
    monkeypatch.setattr(audience, "small_copy", lambda df: small(df, bound))
    profile = frame(spark, people)
    made = [(1, 1, 2, "or"), (1, 2, 3, "and"), (1, 3, 5, None), (2, 1, 7, None), (3, 1, 99, "or"), (3, 2, 1, None), (4, 1, 99, None)]
    tag_map = small_table(spark, made, "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string")
    tests = {1: lambda t: t & {2, 3} and 5 in t, 2: lambda t: 7 in t, 3: lambda t: 1 in t, 4: lambda t: False}
    want = sorted(((u, m) for u, t in people.items() for m, test in tests.items() if test(t)), key=repr)
    assert rows(audience.combined_members(profile, tag_map)) == want
    assert rows(audience.combined_members(profile, tag_map.limit(0))) == []
    own = small_table(spark, [(7, 3), (7, None), (8, 4)], "principal bigint, tag_id bigint")
    role = small_table(spark, [(2, 5), (3, 6), (2, 3)], "role bigint, tag_id bigint")
    repeated = profile.withColumn("tag_ids", F.concat("tag_ids", "tag_ids"))
    assert rows(audience.entitled(repeated, own, role, 7, [2])) == sorted(((u, x) for u, t in people.items() for x in t & {3, 5}), key=repr)


def test_plans_have_no_row_a_user(spark, people, index):
    """With broadcasts off: masks shuffle nothing, bitmaps only rows of a tag and bucket."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        profile = frame(spark, people)
        tag_map = small_table(spark, [(1, 1, 2, "or"), (1, 2, 3, None)], "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string")
        own = small_table(spark, [(7, 3)], "principal bigint, tag_id bigint")
        role = small_table(spark, [(2, 5)], "role bigint, tag_id bigint")
        assert "Exchange" not in plan_text(audience.combined_members(profile, tag_map))
        assert "Exchange" not in plan_text(audience.entitled(profile, own, role, 7, [2]))
        plan = plan_text(bitmaps.users(bitmaps.having_all(index, bitmaps.asked_groups(index, [1, 2]))))
        assert "uid" not in plan and "PushedFilters: [" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
