"""Audiences from compressed bitmaps: one bitmap of users for each tag and bucket of 32,768 user ids.

The index is built once from the profiles and stored; AND, OR and count then work on whole bitmaps.  What is
shuffled is one bitmap a tag and bucket, never a row a user, and a tag that most users have is as many
rows as any other: one a bucket.  User ids are whole numbers; a user's rows count together, and a row without an id
takes no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.operators.tree import leaves_of
from tagloom.small import small_table

#: Users of a bucket, and the bytes of its bitmap; fixed by Spark's bitmap functions.
BUCKET = 32_768
_BYTES = BUCKET // 8


def combined_groups(tag_map: DataFrame) -> DataFrame:
    """Combined-tag rows with the OR group each belongs to and the number of groups.

    ``tag_map`` has ``merge_tag_id, seq, basic_tag_id, connector``; a connector joins a row to the
    next one.  Runs of ``or`` bind first, so a new group starts after each ``and``.
    """
    in_order = Window.partitionBy("merge_tag_id").orderBy("seq")
    whole = Window.partitionBy("merge_tag_id")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    ands = F.coalesce(F.sum(F.when(F.col("connector") == "and", 1).otherwise(0)).over(before), F.lit(0))
    grouped = tag_map.withColumn("or_group", ands)
    return grouped.withColumn("n_groups", F.max("or_group").over(whole) + 1)


def bitmap_index(profile: DataFrame) -> DataFrame:
    """``(tag_id, bucket, bits)`` from the profiles ``(uid, tag_ids)``."""
    held = profile.where(F.col("uid").isNotNull()).select("uid", F.explode("tag_ids").alias("tag_id"))
    placed = held.select("tag_id", F.bitmap_bucket_number("uid").alias("bucket"), F.bitmap_bit_position("uid").alias("bit"))
    return placed.groupBy("tag_id", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def write_index(profile: DataFrame, path: str, partitions: int | None = None) -> None:
    """The index as files in ranges of (tag, bucket), so that a question reads the row groups of its tags only."""
    index = bitmap_index(profile)
    order = ["tag_id", "bucket"]
    ranged = index.repartitionByRange(partitions, *order) if partitions else index.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.parquet(path)


def updated(index: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The index after the profiles of some users changed: ``before`` and ``after`` hold the rows of these users only.

    Users that lost a tag are taken out of its bitmaps, those that gained one are put in; bitmaps of other tags and
    buckets pass through.
    """
    old, new = (bitmap_index(df).withColumnRenamed("bits", name) for df, name in ((before, "_old"), (after, "_new")))
    keys = ["tag_id", "bucket"]
    joined = index.join(old, keys, "full").join(new, keys, "full")
    empty = F.unhex(F.lit("00" * _BYTES))
    rest = _without(F.coalesce("bits", empty), "_old")
    bits = F.when(F.col("_old").isNull() & F.col("_new").isNull(), F.col("bits")).otherwise(_either(rest, F.coalesce("_new", empty)))
    return joined.select(*keys, bits.alias("bits")).where(F.bitmap_count("bits") > 0)


def _words(bits: Column) -> Column:
    """A bitmap as 512 whole numbers; only whole bitmaps of changed buckets are taken apart."""
    starts = F.sequence(F.lit(0), F.lit(_BYTES // 8 - 1))
    return F.transform(starts, lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))


def _bytes(words: Column) -> Column:
    return F.unhex(F.array_join(F.transform(words, lambda w: F.lpad(F.hex(w), 16, "0")), ""))


def _either(one: Column, two: Column) -> Column:
    return _bytes(F.zip_with(_words(one), _words(two), lambda a, b: a.bitwiseOR(b)))


def _without(bits: Column, gone: str) -> Column:
    taken = F.zip_with(_words(bits), _words(F.col(gone)), lambda a, b: a.bitwiseAND(F.bitwise_not(b)))
    return F.when(F.col(gone).isNull(), bits).otherwise(_bytes(taken))


def having_all(index: DataFrame, groups: DataFrame) -> DataFrame:
    """``(bucket, bits)`` of the users that have a tag of every group; ``groups`` holds ``group, tag_id``.

    Tags of a group are ORed, groups are ANDed.  Any number of groups and tags goes the same way: both sides are
    joined by tag, whichever Spark broadcasts, and bitmaps are combined in the tasks that read them first.
    """
    wanted = groups.select(F.col("group").alias("_group"), "tag_id").distinct()
    n = wanted.agg(F.countDistinct("_group")).scalar()
    each = index.join(wanted, "tag_id").groupBy("bucket", "_group").agg(F.bitmap_or_agg("bits").alias("bits"))
    met = each.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("_n"))
    return met.where(F.col("_n") == n).select("bucket", "bits").where(F.bitmap_count("bits") > 0)


def having_any(index: DataFrame, tag_ids: DataFrame) -> DataFrame:
    """``(bucket, bits)`` of the users that have one of the tags in ``tag_ids``, a column ``tag_id``."""
    asked = index.join(tag_ids.select("tag_id"), "tag_id", "left_semi")
    return asked.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def below(index: DataFrame, tags: DataFrame, tag_ids: Sequence[int]) -> DataFrame:
    """``(bucket, bits)`` of the users that have a level-5 tag below one of the given tags, however many there are."""
    return having_any(index, leaves_of(tags, list(tag_ids)).withColumnRenamed("leaf_id", "tag_id"))


def combined(index: DataFrame, groups: DataFrame) -> DataFrame:
    """``(uid, merge_tag_id)`` from the rows of ``combined_groups`` with the basic tag as ``tag_id``."""
    wanted = groups.select("merge_tag_id", "tag_id", "or_group", "n_groups").distinct()
    each = index.join(wanted, "tag_id").groupBy("merge_tag_id", "bucket", "or_group", "n_groups").agg(F.bitmap_or_agg("bits").alias("bits"))
    met = each.groupBy("merge_tag_id", "bucket", "n_groups").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("_n"))
    return members(met.where("_n = n_groups"), "merge_tag_id").select("uid", F.col("merge_tag_id").cast("bigint").alias("merge_tag_id"))


def asked_groups(index: DataFrame, basic: Sequence[int], combined: Sequence[int] = (), tag_map: DataFrame | None = None) -> DataFrame:
    """``group, tag_id`` of a question for all of the basic tags and all of the combined tags of ``tag_map``.

    Every basic tag is a group of its own, and so is every OR group of a combined tag.
    """
    own = small_table(index.sparkSession, [(f"b{tag}", int(tag)) for tag in sorted(set(basic))], "group string, tag_id bigint")
    if not combined:
        return own
    named = combined_groups(tag_map.where(F.col("merge_tag_id").isin(list(combined))))
    group = F.concat(F.lit("c"), "merge_tag_id", F.lit("/"), "or_group")
    return own.unionByName(named.select(group.alias("group"), F.col("basic_tag_id").cast("bigint").alias("tag_id")))


def members(found: DataFrame, *more: str) -> DataFrame:
    """The users of ``(bucket, bits)``, one row each, with the columns ``more``: bytes that are not zero are taken apart."""
    byte = F.conv(F.hex(F.substring("bits", F.col("_byte") + 1, F.lit(1))), 16, 10).cast("int")
    parts = found.select(*more, "bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(_BYTES - 1))).alias("_byte"))
    some = parts.select(*more, "bucket", "_byte", byte.alias("_value")).where("_value <> 0")
    bits = some.select(*more, "bucket", "_byte", "_value", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("_bit"))
    place = (F.col("_byte") * 8 + F.col("_bit")).cast("bigint")
    uid = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * BUCKET + place + 1).otherwise(F.col("bucket") * BUCKET - place)
    return bits.where(F.getbit("_value", F.col("_bit")) == 1).select(*more, uid.alias("uid"))


def users(found: DataFrame) -> DataFrame:
    """How many users ``(bucket, bits)`` stands for, as a row ``users``."""
    return found.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("users"))


def members_page(found: DataFrame, after: int | None, size: int) -> DataFrame:
    """The next ``size`` users by id after ``after`` (None: from the first).

    Bitmaps say how many users a bucket has, so only the buckets that hold the page are taken apart.
    """
    bucket = F.col("bucket")
    if after is not None:
        number = 1 + (after - 1) // BUCKET if after > 0 else -(-after // BUCKET)
        found = found.where(bucket >= number)
    sizes = found.select("bucket", F.bitmap_count("bits").alias("n")).orderBy("bucket")
    # the bucket of ``after`` may hold smaller users only, and every later bucket at least one user
    wanted = [row["bucket"] for row in _enough(sizes.limit(size + 1).collect(), size)]
    rows = members(found.where(bucket.isin(wanted)))
    return (rows if after is None else rows.where(F.col("uid") > after)).orderBy("uid").limit(size)


def _enough(rows: list, size: int) -> list:
    """The first buckets, up to the one with which those after the first hold ``size`` users."""
    out, total = [], 0
    for i, row in enumerate(rows):
        out.append(row)
        total += row["n"] if i else 0
        if total >= size:
            break
    return out
