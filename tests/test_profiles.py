import random

import pytest
from conftest import plan_text, rows
from pyspark.sql import functions as F

from tagloom.functions import conditions
from tagloom.operators import audience, bitmaps, profiles, tree
from tagloom.operators.tagging import level5_rules
from tagloom.plans import registry


@pytest.fixture()
def profile(table):
    stored = table([("1", "319,322,329,333,354"), ("2", "320,348"), ("3", "")], "user_id string, tag_ids string")
    return profiles.load_profile(stored)


def shown(df):
    return rows(profiles.render_profile(df))


def test_append_starts_new_profiles(table, profile):
    model = table([(1, 348), (9, 349)], "uid bigint, tag_id bigint")
    assert shown(profiles.merge_append(model, profile)) == [("1", "319,322,329,333,354,348"), ("9", "349")]


def test_replace_clears_the_family(table, profile):
    model = table([(1, 348), (2, 348), (9, 349)], "uid bigint, tag_id bigint")
    merged = profiles.merge_replace(model, profile, range(348, 356))
    assert shown(merged) == [("1", "319,322,329,333,348"), ("2", "320,348"), ("9", "349")]
    saved = profiles.save_merged(merged, profile)
    assert shown(saved) == [("1", "319,322,329,333,348"), ("2", "320,348"), ("3", ""), ("9", "349")]
    again = profiles.save_merged(profiles.merge_replace(model, saved, range(348, 356)), saved)
    assert shown(again) == shown(saved)


def _reference_merge(old, results, families):
    out = {u: set(t) for u, t in old.items()}
    for result, family in zip(results, families):
        for uid, tag in result:
            out[uid] = (out.get(uid, set()) - set(family)) | {tag}
    return {u: sorted(t) for u, t in out.items()}


def test_one_pass_equals_one_model_after_another(table):
    draw = random.Random(5)
    families = [list(range(10, 15)), list(range(20, 25)), list(range(30, 33))]
    old = {u: sorted({draw.choice(draw.choice(families)) for _ in range(draw.randint(0, 3))} | {99}) for u in range(60)}
    results = [[(u, draw.choice(f)) for u in draw.sample(range(80), 40)] for f in families]
    profile = table([(u, ",".join(map(str, t))) for u, t in old.items()], "user_id bigint, tag_ids string")
    profile = profiles.load_profile(profile)
    frames = [table(r, "uid bigint, tag_id bigint") for r in results]
    expected = _reference_merge(old, results, families)
    family = table([(t, i) for i, f in enumerate(families) for t in f], "tag_id bigint, family bigint")
    merged = profiles.merge_results(list(enumerate(frames)), profile, family)
    assert {r["uid"]: r["tag_ids"] for r in merged.collect()} == expected


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_unknown_foreign_and_repeated_tags(spark, table, broadcast):
    """What a run gives is added, whatever the definitions say; only the run's own family gives way."""
    profile = table([(1, [10, 20]), (2, [10]), (3, None), (4, [])], "uid bigint, tag_ids array<bigint>")
    family = table([(10, 1), (11, 1), (20, 2), (21, 2)], "tag_id bigint, family bigint")
    first = table([(1, 11), (1, 777), (1, 11), (2, 21), (5, 10), (3, None)], "uid bigint, tag_id bigint")
    second = table([(2, 10)], "uid bigint, tag_id bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = {r["uid"]: r["tag_ids"] for r in profiles.merge_results([(1, first), (2, second)], profile, family).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {1: [11, 20, 777], 2: [10, 21], 3: [], 4: [], 5: [10]}


def test_a_user_with_several_new_tags_is_one_row(table):
    profile = table([(1, [10, 20])], "uid bigint, tag_ids array<bigint>")
    model = table([(1, 12), (1, 11), (1, 12), (2, 11), (2, None)], "uid bigint, tag_id bigint")
    assert shown(profiles.merge_append(model, profile)) == [("1", "10,20,11,12"), ("2", "11")]
    assert shown(profiles.merge_replace(model, profile, [10, 11, 12])) == [("1", "11,12,20"), ("2", "11")]


def test_a_bad_tag_id_ends_the_load(table):
    from pyspark.errors import PySparkException

    assert profiles.load_profile(table([(1, " 5, ,7,")], "user_id bigint, tag_ids string")).first()["tag_ids"] == [5, 7]
    for text in ("319,abc", "99999999999999999999"):
        with pytest.raises(PySparkException):
            profiles.load_profile(table([(1, text)], "user_id bigint, tag_ids string")).collect()


def test_a_result_without_a_tag_changes_nothing(table, profile):
    model = table([(1, None), (2, 349)], "uid bigint, tag_id bigint")
    family = table([(t, 347) for t in range(348, 356)], "tag_id bigint, family bigint")
    expected = [("1", "319,322,329,333,354"), ("2", "320,349"), ("3", "")]
    assert shown(profiles.merge_results([(347, model)], profile, family)) == expected
    assert shown(profiles.save_merged(profiles.merge_replace(model, profile, range(348, 356)), profile)) == expected


def test_family_merge_keeps_users_without_tags(table, profile):
    family = table([(348, 347)], "tag_id bigint, family bigint")
    none = table([], "uid bigint, tag_id bigint")
    got = {r["uid"]: r["tag_ids"] for r in profiles.merge_results([(347, none)], profile, family).collect()}
    assert got[3] == [] and got[2] == [320, 348]


TAGS = [
    (1, "root", None, 1, -1), (2, "shop", None, 2, 1), (3, "people", None, 3, 2), (4, "money", None, 3, 2),
    (10, "gender", "inType=none", 4, 3), (11, "male", "1", 5, 10), (12, "female", "2", 5, 10),
    (20, "spending", "inType=none", 4, 4), (21, "high", "0", 5, 20), (22, "low", "1", 5, 20),
    (30, "empty", "inType=none", 4, 4),
]


@pytest.fixture()
def tags(table):
    return table(TAGS, "id bigint, name string, rule string, level int, pid bigint")


def test_closure_and_paths(tags):
    closure = rows(tree.leaf_closure(tags))
    assert (1, 21) in closure and (20, 21) in closure and (21, 21) in closure and (3, 21) not in closure
    assert len(closure) == 4 * 5
    assert rows(tree.leaves_of(tags, [3, 21])) == [(11,), (12,), (21,)]
    assert rows(tree.paths(tags, "high"), "id", "path") == [(21, "root --- shop --- money --- spending --- high")]


def test_outline_carries_texts_once_a_node(table):
    """Only ids and counts go up the lines; equal and null ids are one node each, as grouping has them."""
    made = [(1, "a", 1, -1), (2, "b", 2, 1), (2, "bb", 2, 1), (3, "c", 3, 2), (4, "d", 4, 3), (None, "n", 4, 3), (5, "e", 5, 4),
            (5, "e", 5, 4), (6, None, 5, 4), (None, "m", 5, 4), (7, "lost", 5, None), (8, "high", 3, 1)]
    tags = table([(i, name, None, level, pid) for i, name, level, pid in made], "id bigint, name string, rule string, level int, pid bigint")
    lines = [[(i, name)] for i, name, level, pid in made if level == 1]
    every = list(lines)
    for at in range(2, tree.DEPTH + 1):
        lines = [[*line, (i, name)] for line in lines for i, name, level, pid in made if level == at and pid is not None and pid == line[-1][0]]
        every += lines
    want = {}
    for line in every:
        position = "/".join(f"{i:012d}" for i, _ in line if i is not None)
        for at, (i, _) in enumerate(line, 1):
            node = want.setdefault(i, [[], [], [], 0, 0])
            if at == len(line):
                for held, value in zip(node, (line[-1][1], at, position)):
                    held.append(value)
            node[3] += at == len(line) - 1
            node[4] += len(line) == tree.DEPTH
    most = lambda held: max((x for x in held if x is not None), default=None)
    out = tree.outline(tags)
    assert rows(out) == sorted(((i, *map(most, node[:3]), *node[3:]) for i, node in want.items()), key=repr)
    blocks = [block for block in plan_text(out).split("\n\n") if ") Generate\nInput" in block]
    assert blocks and not any(text in block for block in blocks for text in ("name#", "names#", "position#"))


def test_outline_is_depth_first(tags):
    out = tree.outline(tags).orderBy("position").collect()
    assert [r["id"] for r in out] == [1, 2, 3, 10, 11, 12, 4, 20, 21, 22, 30]
    by_id = {r["id"]: (r["level"], r["n_children"], r["n_leaves"]) for r in out}
    assert by_id[1] == (1, 1, 4) and by_id[4] == (3, 2, 2) and by_id[30] == (4, 0, 0) and by_id[21] == (5, 0, 1)


COMBINED = [(1, 1, 97, "or"), (1, 2, 98, "and"), (1, 3, 132, "or"), (1, 4, 133, "and"), (1, 5, 214, "and"), (2, 1, 55, "and")]


def test_combined_tags_against_all_subsets(table):
    import itertools

    ids = [97, 98, 132, 133, 214, 55]
    people = []
    for n, subset in enumerate(itertools.chain.from_iterable(itertools.combinations(ids, k) for k in range(7))):
        people.append((n, ",".join(map(str, subset))))
    profile = profiles.load_profile(table(people, "user_id int, tag_ids string"))
    tag_map = table(COMBINED, "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string")
    expected = []
    for n, text in people:
        s = {int(x) for x in text.split(",") if x}
        if s & {97, 98} and s & {132, 133} and 214 in s:
            expected.append((n, 1))
        if 55 in s:
            expected.append((n, 2))
    assert rows(audience.combined_members(profile, tag_map)) == sorted(expected, key=repr)
    both = audience.audience_all(profile, [97], [1, 2], tag_map)
    assert rows(both) == sorted([(n,) for n, t in people if "97" in t and (n, 1) in expected and (n, 2) in expected], key=repr)


def test_index_and_audiences_agree(spark, table, profile, tags):
    assert rows(audience.audience_all(profile, [319, 333])) == [(1,)]
    assert rows(audience.audience_from_index(audience.tag_index(profile), [319, 333])) == [(1,)]
    tagged = profiles.load_profile(table([(1, "11,21"), (2, "12"), (3, "22"), (4, "99")], "user_id int, tag_ids string"))
    assert rows(bitmaps.members(bitmaps.below(bitmaps.bitmap_index(tagged), tags, [10, 21]))) == [(1,), (2,)]


def test_counts_and_share(profile):
    counts = {r["tag_id"]: (r["user_count"], r["share"]) for r in audience.tag_counts(profile).collect()}
    assert counts[319] == (1, pytest.approx(1 / 3)) and len(counts) == 7


def test_pages(spark):
    df = spark.range(95)
    assert [r[0] for r in audience.page_after(df, "id", 89, 10).collect()] == list(range(90, 95))
    assert [r[0] for r in audience.page_after(df, "id", None, 2).collect()] == [0, 1]


def test_first_matching_keys(table):
    df = table([(3, "a"), (1, "a"), (2, "b"), (1, "a"), (4, "a")], "k int, v string")
    test = conditions.equals_any({"v": "a"})
    assert rows(audience.matching_keys(df, "k", test)) == [(1,), (3,), (4,)]
    assert rows(audience.matching_keys(df, "k", test, first=2)) == [(1,), (3,)]


@pytest.mark.parametrize("kind", ["bigint", "string", "decimal(20,2)", "date", "double"])
def test_first_keys_are_those_of_a_full_sort(spark, kind):
    number = F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") * 37 % 211 - 100)
    key = F.date_add(F.lit("2020-01-01"), number.cast("int")) if kind == "date" else number.cast(kind)
    df = spark.range(0, 3000, 1, 7).select("id", key.alias("k"))
    for n in (0, 1, 5, 400):
        expected = df.where("id % 3 = 0").select("k").distinct().orderBy("k").limit(n)
        got = audience.matching_keys(df, "k", F.col("id") % 3 == 0, first=n)
        assert got.schema == expected.schema and [tuple(r) for r in got.collect()] == [tuple(r) for r in expected.collect()]
    assert audience.matching_keys(df, "k", F.lit(False), first=5).count() == 0


def test_first_keys_send_on_no_more_than_was_asked_for(spark):
    keys = spark.range(0, 90_000, 1, 6).select((F.col("id") * 7919 % 40_000).alias("k"))
    sent = audience.least_keys(keys, 10).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert [r["count"] for r in sent] == [10] * 6
    plan = plan_text(audience.matching_keys(keys, "k", F.lit(True), first=10))
    assert plan.index("Exchange") < plan.index("MapInArrow")  # the tree of the plan is read from below


def test_entitlement(table, profile):
    own = table([(7, 319)], "principal bigint, tag_id bigint")
    role = table([(2, 348), (3, 333)], "role bigint, tag_id bigint")
    assert rows(audience.entitled(profile, own, role, 7, [2])) == [(1, 319), (2, 348)]
    assert audience.entitled(profile, own, role, 8, [1]).count() == 7


def test_portrait_shares_parents(table, tags):
    tagged = profiles.load_profile(table([(1, "11,21,22")], "user_id int, tag_ids string"))
    got = rows(audience.portraits(tagged, tags), "id", "path")
    assert [i for i, _ in got].count(1) == 1 and (22, "root --- shop --- money --- spending --- low") in got
    assert len(got) == 9


def test_lookup_masks_what_it_finds(table):
    people = table([(1, "Anna", "13912345678", "anna.b@example.com", "123456", "110101195001010123")],
                   "uid int, name string, phone string, email string, qq string, id_card string")
    probes = table([("13912345678",), ("123456",), ("unknown",), ("13900000000",), ("13912345678",)], "probe string")
    assert rows(audience.find_users(probes, people)) == [(1, "phone", "A**", "139*****678"), (1, "qq", "A**", "123456")]


def test_model_runs(spark, table, tags, profile):
    table([(1, "1"), (9, "2"), (5, "3")], "uid bigint, g string").createOrReplaceTempView("people_of_test")
    real = tags.withColumn("rule", F.when(F.col("id") == 10, "inType=hive\nhiveTable=people_of_test\nselectFieldNames=uid,g").otherwise(F.col("rule")))
    from tagloom.operators.tagging import match_tag

    registry.register_model("test_gender", lambda business, r: match_tag(business, "g", r))
    run = [registry.Run(10, "test_gender")]
    inline = registry.run_models(spark, real, run, profile)
    assert shown(inline) == [("1", "11,319,322,329,333,354"), ("2", "320,348"), ("3", ""), ("9", "12")]
    assert rows(level5_rules(real, 10)) == [(11, "1"), (12, "2")]
    with pytest.raises(LookupError):
        registry.run_models(spark, real, [registry.Run(10, "unknown")], profile)
    with pytest.raises(ValueError):
        registry.run_models(spark, tags, run, profile)  # inType=none
