"""Preparing raw business data: repairing ids and codes, filling keys, synthetic users.

Pseudo-random choices are hashes of a key and a salt.  They do not change when a task is
run again or the data is partitioned differently.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.text import portable_hash
from tagloom.session import cut_lineage
from tagloom.small import small_table

# Payment codes and the names shown for them, and the shift of finish times.
PAY_NAMES = {"alipay": "支付宝", "wxpay": "微信支付", "chinapay": "银联支付", "cod": "货到付款"}
FINISH_SHIFT_DAYS = 300


def pick(n: int, *key, salt: int = 0) -> Column:
    """A number in ``0 .. n-1`` that depends only on the key."""
    return (portable_hash(*key, salt=salt) % n).cast("int")


def choose(values: Sequence[str], *key, salt: int = 0) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), pick(len(values), *key, salt=salt) + 1)


def normalize_orders(
    orders: DataFrame, user_bound: int, pay_names: Mapping[str, str] = PAY_NAMES,
    shift_days: int = FINISH_SHIFT_DAYS,
) -> DataFrame:
    """Users at or above the bound become one of 1 … bound, unknown payment codes a known one.

    ``orders`` has ``order_id, uid, pay_code, finish_date``.
    """
    codes = list(pay_names)
    names = F.create_map(*[F.lit(x) for pair in pay_names.items() for x in pair])
    uid = F.when(F.col("uid") >= user_bound, pick(user_bound, "order_id") + 1).otherwise(F.col("uid"))
    code = F.when(F.col("pay_code").isin(codes), F.col("pay_code")).otherwise(
        choose(codes, "order_id", salt=1)
    )
    fixed = orders.withColumn("uid", uid.cast("bigint")).withColumn("pay_code", code)
    return fixed.withColumn("pay_name", names[F.col("pay_code")]).withColumn(
        "finish_date", F.date_add("finish_date", shift_days)
    )


def numbered(df: DataFrame, key: str) -> DataFrame:
    """``df`` sorted by ``key`` with ``place`` 0, 1, 2, … and no single-task window.

    Rows are range-partitioned, each partition is counted, and the offsets of the partitions (one
    small row each) are added to the row numbers inside them.
    """
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    # ids are partition number << 33 plus the position inside the partition
    marked = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id()))
    marked = marked.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_row", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = {r["_part"]: r["n"] for r in marked.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    offsets, total = [], 0
    for part in sorted(sizes):
        offsets.append((part, total))
        total += sizes[part]
    table = small_table(df.sparkSession, offsets, "_part bigint, _offset bigint")
    placed = marked.join(table, "_part")
    return placed.withColumn("place", F.col("_row") + F.col("_offset")).drop("_id", "_part", "_row", "_offset")


def fill_missing_users(orders: DataFrame, users: DataFrame, missing: int = 0) -> DataFrame:
    """Orders without a user (``uid = missing``) get one of the real users, chosen by hash."""
    real = numbered(users.select("uid").where(F.col("uid") != missing).distinct(), "uid")
    real = real.withColumnRenamed("uid", "_uid")
    n = real.agg(F.count("*")).scalar()
    lost = orders.where(F.col("uid") == missing).withColumn(
        "_place", portable_hash("order_id") % F.nullif(n, F.lit(0))
    )
    found = lost.join(real, F.col("_place") == F.col("place"), "left").withColumn(
        "uid", F.coalesce("_uid", "uid")
    )
    kept = orders.where(~F.coalesce(F.col("uid") == missing, F.lit(False)))
    return kept.unionByName(found.select(*orders.columns))


# Small word lists of our own for synthetic users.
_FAMILY = ("Alder", "Birch", "Cedar", "Dogwood", "Elm", "Fir", "Gorse", "Hazel", "Ivy", "Juniper")
_GIVEN = ("Amber", "Basil", "Coral", "Dune", "Ember", "Flint", "Gale", "Heath", "Iris", "Jasper")
_ROADS = ("River Road", "Hill Street", "Station Lane", "Garden Way", "Harbour Walk")
_DOMAINS = ("example.com", "example.org", "example.net")
_MOBILE_HEADS = ("130", "136", "139", "150", "158", "177", "186")


def synthetic_users(ids: DataFrame | SparkSession, count: int | None = None) -> DataFrame:
    """Name, sex, address, phone, e-mail and IP for each id (or for ids ``0 .. count-1``)."""
    frame = ids.range(count).withColumnRenamed("id", "uid") if isinstance(ids, SparkSession) else ids
    ip = [(pick(254, "uid", salt=10 + i) + 1).cast("string") for i in range(4)]
    return frame.select(
        "uid",
        F.concat_ws(" ", choose(_GIVEN, "uid", salt=3), choose(_FAMILY, "uid", salt=2)).alias("name"),
        pick(2, "uid", salt=4).alias("sex"),
        F.concat_ws(" ", (pick(300, "uid", salt=5) + 1).cast("string"), choose(_ROADS, "uid", salt=6)).alias("address"),
        F.concat(choose(_MOBILE_HEADS, "uid", salt=7), F.lpad(pick(100_000_000, "uid", salt=8).cast("string"), 8, "0")).alias("phone"),
        F.concat(F.lit("user"), F.col("uid").cast("string"), F.lit("@"), choose(_DOMAINS, "uid", salt=9)).alias("email"),
        F.concat_ws(".", *ip).alias("ip"),
    )
