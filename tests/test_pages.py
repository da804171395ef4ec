"""Numbered pages against a sorted list, and what they read."""

import random

import pytest
from conftest import plan_text

from tagloom.operators import pages
from tagloom.small import small_table


@pytest.mark.parametrize("kind", ["whole numbers", "texts", "repeated keys"])
def test_pages_against_a_sorted_list(spark, monkeypatch, kind):
    monkeypatch.setattr(pages, "RANGE_ROWS", 20)
    rng = random.Random(3)
    keys = {"whole numbers": rng.sample(range(-10_000, 10_000), 1_000), "texts": [f"k{rng.randrange(10**6)}" for _ in range(700)],
            "repeated keys": [7] * 300 + [rng.randrange(20) for _ in range(300)]}[kind]
    frame = small_table(spark, [(k, i) for i, k in enumerate(keys)] + [(None, -1)], f"key {'string' if kind == 'texts' else 'bigint'}, _place int").repartition(5)
    directory = pages.page_directory(frame, "key", 8)
    assert sum(r.rows for r in directory) == len(keys) and [r.before for r in directory] == [sum(x.rows for x in directory[:i]) for i in range(len(directory))]
    assert all(a.high < b.low for a, b in zip(directory, directory[1:]))
    for size in (1, 30, 333):
        last = -(-len(keys) // size)
        for number in {0, 1, 2, last // 2, last, last + 1}:
            got = [r["key"] for r in pages.numbered_page(frame, "key", number, size, directory).collect()]
            start = (max(number, 1) - 1) * size
            assert got == sorted(keys)[start : start + size]
    everything = [r["_place"] for n in range(1, 4) for r in pages.numbered_page(frame, "key", n, -(-len(keys) // 3), directory).collect()]
    assert len(everything) == len(keys)


def test_empty_table(spark):
    none = small_table(spark, [], "key bigint, x int")
    assert pages.page_directory(none, "key") == []
    assert pages.numbered_page(none, "key", 1, 10, []).collect() == []


def test_a_deep_page_reads_one_range(spark, folder):
    spark.range(100_000).repartition(4, "id").sortWithinPartitions("id").write.parquet(folder)
    frame = spark.read.parquet(folder)
    directory = pages.page_directory(frame, "id", 50)
    page = pages.numbered_page(frame, "id", 901, 100, directory)
    plan = plan_text(page)
    low = next(r.low for r in reversed(directory) if r.before <= 90_000)
    assert "Offset" not in plan.replace("offset: ", "") and f"GreaterThanOrEqual(id,{low})" in plan and "TakeOrderedAndProject" in plan
    assert [r[0] for r in page.collect()] == list(range(90_000, 90_100))
