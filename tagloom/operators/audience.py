"""Questions about tagged users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType

from tagloom.bounds import small_copy
from tagloom.functions import lists, text
from tagloom.operators import bitmaps
from tagloom.operators.bitmaps import combined_groups
from tagloom.operators.profiles import exploded
from tagloom.operators.tree import PATH_SEPARATOR, lineages
from tagloom.session import cut_lineage


def tag_index(profile: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(tag_id, uid)`` clustered by tag for pruned reads.

    Range partitioning on both columns cuts a tag that most users have into many partitions, and
    sorting inside them lets a reader skip row groups by tag.
    """
    rows = exploded(profile).select("tag_id", "uid")
    ranged = (
        rows.repartitionByRange(partitions, "tag_id", "uid")
        if partitions
        else rows.repartitionByRange("tag_id", "uid")
    )
    return ranged.sortWithinPartitions("tag_id", "uid")


def combined_members(profile: DataFrame, tag_map: DataFrame) -> DataFrame:
    """``(uid, merge_tag_id)`` for users that satisfy a combined tag; a profile has one row a user.

    A measured number of definitions is compiled into group masks that are tested on the array in the user's row:
    nothing is shuffled.  More definitions are met by bitmaps, with the same result.
    """
    groups = combined_groups(tag_map).select("merge_tag_id", F.col("basic_tag_id").cast("bigint").alias("tag_id"), "or_group", "n_groups")
    few = small_copy(groups)
    if few is None:
        return bitmaps.combined(bitmaps.bitmap_index(profile), groups)
    masks: dict[int, dict[int, set[int]]] = {}
    for tag, basic, group, _ in few.collect():  # a local relation is collected without a job
        masks.setdefault(tag, {}).setdefault(group, set()).add(basic)
    if not masks:
        return profile.select("uid", F.lit(None).cast("bigint").alias("merge_tag_id")).limit(0)
    literal = F.array(*[
        F.struct(F.lit(tag).cast("bigint").alias("id"), F.array(*[lists.tag_array(sorted(x for x in group if x is not None)) for group in wanted.values()]).alias("groups"))
        for tag, wanted in masks.items()
    ])
    met = F.filter(literal, lambda mask: F.forall(mask["groups"], lambda group: F.arrays_overlap("tag_ids", group)))
    return profile.where(F.col("uid").isNotNull()).select("uid", F.explode(F.transform(met, lambda mask: mask["id"])).alias("merge_tag_id"))


def audience_all(
    profile: DataFrame, basic: Sequence[int], combined: Sequence[int] = (), tag_map: DataFrame | None = None,
    after=None, size: int | None = None,
) -> DataFrame:
    """Users that have every basic tag and every combined tag given; ``size`` asks for a page.

    A page starts after the user id ``after`` (None: at the first), so a deep page costs no more.

    Basic tags are tested on the array in the scan, without a shuffle; combined tags are only
    evaluated for the users left.
    """
    wanted = lists.tag_array(basic)
    users = profile.where(F.size(F.array_intersect("tag_ids", wanted)) == len(set(basic)))
    if combined:
        asked = tag_map.where(F.col("merge_tag_id").isin(list(combined)))
        met = combined_members(users, asked).groupBy("uid").agg(F.count("*").alias("_met"))
        met = met.where(F.col("_met") == len(set(combined))).select("uid")
        users = users.join(met, "uid", "left_semi")
    return users.select("uid") if size is None else page_after(users.select("uid"), "uid", after, size)


def audience_from_index(index: DataFrame, basic: Sequence[int]) -> DataFrame:
    """The same for basic tags, read from the tag index; only the asked tags are scanned."""
    hits = index.where(F.col("tag_id").isin(list(basic))).groupBy("uid").agg(
        F.countDistinct("tag_id").alias("_n")
    )
    return hits.where(F.col("_n") == len(set(basic))).select("uid")


#: Keys that Arrow and Spark order and tell apart alike.
_ALIKE = (ByteType, ShortType, IntegerType, LongType, DateType, DecimalType)


def least_keys(keys: DataFrame, n: int) -> DataFrame:
    """At most the ``n`` smallest different keys of each partition of a single column, NULL first.

    A task keeps ``n`` keys and one batch, however many rows it reads and however often they repeat a key.
    """
    name = keys.columns[0]

    def least(batches):
        import pyarrow as pa  # the function travels to the tasks by value
        import pyarrow.compute as pc

        kept = None
        for batch in batches:
            found = batch.column(0).unique()
            found = found if kept is None else pa.concat_arrays([kept, found]).unique()
            order = pc.array_sort_indices(found, null_placement="at_start")
            kept = found.take(order.slice(0, n))
        if kept is not None:
            yield pa.RecordBatch.from_arrays([kept], names=[name])

    return keys.mapInArrow(least, keys.schema)


def matching_keys(df: DataFrame, key: str, test: Column, first: int | None = None) -> DataFrame:
    """Distinct keys of the rows that pass; ``first`` asks for the smallest keys only, NULL before all.

    Then a task sends on at most ``first`` keys; keys of other types than whole numbers, decimals, plain
    texts and dates are made distinct as a whole.
    """
    keys = df.where(test).select(key)
    if first is None:
        return keys.distinct()
    kind = keys.schema[0].dataType
    if first > 0 and (isinstance(kind, _ALIKE) or kind == StringType()):
        keys = least_keys(keys, first)
    return keys.distinct().orderBy(key).limit(first)


def page_after(df: DataFrame, key: str, last_key, size: int) -> DataFrame:
    """The page after ``last_key``: deep pages cost no more than the first."""
    rest = df if last_key is None else df.where(F.col(key) > F.lit(last_key))
    return rest.orderBy(key).limit(size)


def tag_counts(profile: DataFrame) -> DataFrame:
    """Users per tag, and their share of all users."""
    everyone = profile.agg(F.count("*")).scalar()
    per_tag = exploded(profile.select("uid", F.array_distinct("tag_ids").alias("tag_ids")))
    counted = per_tag.groupBy("tag_id").agg(F.count("*").alias("user_count"))
    return counted.withColumn("share", F.col("user_count") / everyone)


def examples(profile: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` users of each tag.

    The rank filter is applied before the shuffle too, so at most ``n`` rows per tag and input
    partition are exchanged.
    """
    first = Window.partitionBy("tag_id").orderBy("uid")
    ranked = exploded(profile).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= n)


def portraits(profile: DataFrame, tags: DataFrame) -> DataFrame:
    """Each user's tags spread over the tree: distinct ``(uid, level, id, pid, path)`` rows.

    A user's lines are made distinct inside the user's row; what an id stands for is joined afterwards.
    """
    lines = cut_lineage(lineages(tags).select("id", "line", "names"), "lineages")
    upward = lines.select(F.col("id").alias("tag_id"), "line")
    parent = F.when(F.size("line") > 1, F.element_at("line", -2)).otherwise(F.lit(-1))
    named = lines.select(
        "id", F.size("line").alias("level"), parent.alias("pid"),
        F.array_join("names", PATH_SEPARATOR).alias("path"),
    )
    held = exploded(profile).join(upward, "tag_id").groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("line"))).alias("ids"))
    pairs = held.select("uid", F.explode("ids").alias("id"))
    return pairs.join(named, "id").select("uid", "level", "id", "pid", "path")


def entitled(
    profile: DataFrame, user_grants: DataFrame, role_grants: DataFrame, principal: int,
    roles: Sequence[int], all_seeing_role: int = 1,
) -> DataFrame:
    """``(uid, tag_id)`` rows a principal may see: own grants and role grants together, each tag of a row once.

    A measured number of grants is a mask on the array in the user's row, without a shuffle; more are joined.
    ``user_grants`` has ``principal, tag_id``; ``role_grants`` has ``role, tag_id``.
    """
    held = profile.select("uid", F.array_distinct("tag_ids").alias("tag_ids"))
    if all_seeing_role in roles:
        return exploded(held)
    own = user_grants.where(F.col("principal") == principal).select("tag_id")
    shared = role_grants.where(F.col("role").isin(list(roles))).select("tag_id")
    grants = own.unionByName(shared).where(F.col("tag_id").isNotNull()).distinct()
    few = small_copy(grants)
    if few is None:
        return exploded(held).join(grants, "tag_id", "left_semi").select("uid", "tag_id")
    return exploded(held, F.array_intersect("tag_ids", lists.tag_array([row[0] for row in few.collect()])))


def catalogue(tags: DataFrame, models: DataFrame, counts: DataFrame) -> DataFrame:
    """Level-4 tags with model and rule, one row per attribute, with the users each has."""
    tag = tags.where("level = 4").select(F.col("id").alias("tag_id"), F.col("name").alias("tag_name"),
                                         F.col("rule").alias("tag_rule")).join(models, "tag_id")
    leaf = tags.where("level = 5").select(F.col("pid").alias("tag_id"), F.col("id").alias("attr_id"),
                                          F.col("name").alias("attr_name"))
    counted = counts.select(F.col("tag_id").alias("attr_id"), "user_count")
    attributes = leaf.join(tag, "tag_id").join(counted, "attr_id", "left").na.fill(0, ["user_count"])
    bare = tag.join(leaf.select("tag_id").distinct(), "tag_id", "left_anti").withColumn("user_count", F.lit(0).cast("bigint"))
    return attributes.unionByName(bare, allowMissingColumns=True)


def find_users(probes: DataFrame, people: DataFrame, probe: str = "probe") -> DataFrame:
    """People by an identifier of unknown type; found values are masked.

    ``people`` has ``uid, name, phone, email, qq, id_card``.
    """
    kinds = ("phone", "email", "qq", "id_card")
    asked = probes.select(F.col(probe).alias("value"), text.identifier_type(probe).alias("kind"))
    asked = asked.where(F.col("kind").isNotNull()).distinct()
    known = people.select(
        "uid", "name",
        F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in kinds])),
    )
    return asked.join(known, ["kind", "value"]).select(
        "uid", "kind", text.mask_name("name").alias("name"), text.mask_value("value").alias("value")
    )
