"""Fixity of web archives: Merkle trees over records and offset ranges, and the audit of a replica."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tagloom.llm.scratch import Scratch

#: Records of one archive file, by id; records that are ranked together.
FILE_IDS = 4_096
CHUNK_IDS = 256
#: Bytes of a lowest range, and how many ranges make one of the next level.
RANGE_BYTES = 1 << 16
FAN = 16


def warc_records(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", body_column: str = "html") -> DataFrame:
    """``file_id, chunk, record_id, record``: each page as the bytes of a WARC/1.1 resource record.

    A file holds the pages of ``FILE_IDS`` consecutive ids.  Null urls and bodies count as empty.
    Pages without an id go to files of negative number by a hash of their content, with id -1.
    """
    content = F.concat_ws("\n", F.coalesce(F.col(url_column).cast("string"), F.lit("")), F.coalesce(F.col(body_column).cast("string"), F.lit("")))
    number = F.col(id_column).cast("long")
    spread = -1 - F.conv(F.substring(F.md5(content), 1, 3), 16, 10).cast("long")
    body = F.encode(F.coalesce(F.col(body_column).cast("string"), F.lit("")), "UTF-8")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(number.cast("string"), F.lit("-1")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(F.col(url_column).cast("string"), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select(
        F.coalesce(F.floor(number / FILE_IDS), spread).alias("file_id"), F.coalesce(F.floor(number / CHUNK_IDS), F.lit(0)).alias("chunk"),
        F.coalesce(number, F.lit(-1)).alias("record_id"), F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8")).alias("record"),
    )


def leaves(records: DataFrame) -> DataFrame:
    """``file_id, chunk, record_id, length, digest``: what a record adds to the tree; the bytes go no further."""
    return records.select("file_id", "chunk", "record_id", F.octet_length("record").cast("long").alias("length"), F.sha2(F.col("record"), 256).alias("digest"))


def index(leaf: DataFrame) -> DataFrame:
    """``leaves`` with the ``offset`` of each record in its file, in the order of ids, ties by digest.

    Offsets are sums over chunks and then inside chunks, so that no task orders a whole hot file.
    """
    inside = Window.partitionBy("file_id", "chunk").orderBy("record_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = leaf.groupBy("file_id", "chunk").agg(F.sum("length").alias("bytes")).select(
        "file_id", "chunk", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")
    )
    placed = leaf.withColumn("inside", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(starts, ["file_id", "chunk"])
    return placed.select("file_id", "record_id", (F.col("start") + F.col("inside")).alias("offset"), "length", "digest")


def _levels(furthest: int) -> int:
    levels, width = 1, RANGE_BYTES
    while width <= furthest:
        levels, width = levels + 1, width * FAN
    return levels


def tree(indexed: DataFrame, levels: int, scratch: Scratch, name: str) -> DataFrame:
    """``level, file_id, node, digest`` of every non-empty node.

    A node of level 0 hashes, in order, offset, length and digest of the records that start in a
    range of ``RANGE_BYTES``; a node above hashes the numbers and digests of ``FAN`` ranges below.
    The one node of the highest level is the file's root.
    """

    def hashed(items: Column) -> Column:
        return F.sha2(F.array_join(F.transform(F.sort_array(items), lambda x: F.concat_ws(":", x["at"].cast("string"), x["what"])), ","), 256)

    row = F.struct(F.col("offset").alias("at"), F.concat_ws(":", "length", "digest").alias("what"))
    level = indexed.groupBy("file_id", F.floor(F.col("offset") / RANGE_BYTES).alias("node")).agg(hashed(F.collect_list(row)).alias("digest"))
    level = scratch.keep(level, f"{name}-0")
    found = level.select(F.lit(0).alias("level"), "file_id", "node", "digest")
    for number in range(1, levels):
        child = F.struct(F.col("node").alias("at"), F.col("digest").alias("what"))
        level = scratch.keep(level.groupBy("file_id", F.floor(F.col("node") / FAN).alias("node")).agg(hashed(F.collect_list(child)).alias("digest")), f"{name}-{number}")
        found = found.union(level.select(F.lit(number).alias("level"), "file_id", "node", "digest"))
    return found


def audit(original: DataFrame, replica: DataFrame, scratch: Scratch) -> DataFrame:
    """``file_id, record_id, offset, length, fault`` for every record of a replica that is not as it was.

    Both sides are ``leaves``.  The original's offsets are the index that both trees use: a replica's
    record that the index knows takes its place there, so a lost record does not shift the others.
    Roots are compared first; below a root that differs only the branches that differ are followed,
    down to the lowest ranges, where records are compared: ``changed``, ``missing`` or ``extra`` (one
    that the index does not know, or one more copy, without an offset).
    Repeated ids are told apart by their order; a changed one counts as its number among the copies.
    """
    number = F.row_number().over(Window.partitionBy("file_id", "chunk", "record_id").orderBy("digest"))
    places = index(original).withColumn("copy", F.row_number().over(Window.partitionBy("file_id", "record_id").orderBy("offset")))
    held = scratch.keep(places, "index")
    theirs = replica.withColumn("copy", number).join(held.select("file_id", "record_id", "copy", "offset"), ["file_id", "record_id", "copy"], "left")
    other = scratch.keep(theirs.select("file_id", "record_id", "copy", "offset", "length", "digest"), "replica")
    levels = _levels(held.agg(F.max("offset")).first()[0] or 0)
    one, two = tree(held, levels, scratch, "one"), tree(other.where("offset IS NOT NULL"), levels, scratch, "two")

    def level_of(whole: DataFrame, level: int, digest: str) -> DataFrame:
        return whole.where(F.col("level") == level).select("file_id", "node", F.col("digest").alias(digest))

    wrong = None
    for level in range(levels - 1, -1, -1):
        left, right = level_of(one, level, "a"), level_of(two, level, "b")
        if wrong is not None:
            parent = F.floor(F.col("node") / FAN).alias("parent")
            up = wrong.withColumnRenamed("node", "parent")
            left, right = (x.select("*", parent).join(up, ["file_id", "parent"], "left_semi").drop("parent") for x in (left, right))
        wrong = scratch.keep(left.join(right, ["file_id", "node"], "full").where("NOT (a <=> b)").select("file_id", "node"), f"wrong-{level}")
    node = F.floor(F.col("offset") / RANGE_BYTES).alias("node")

    def suspects(side: DataFrame, length: str, digest: str) -> DataFrame:
        rows = side.where("offset IS NOT NULL").select("file_id", "record_id", "copy", "offset", F.col("length").alias(length), F.col("digest").alias(digest), node)
        return rows.join(wrong, ["file_id", "node"], "left_semi").drop("node")

    both = suspects(held, "length", "a").join(suspects(other, "length_b", "b").drop("offset"), ["file_id", "record_id", "copy"], "left").where("NOT (a <=> b)")
    faults = both.select("file_id", "record_id", "offset", "length", F.when(F.col("b").isNull(), "missing").otherwise("changed").alias("fault"))
    extra = other.where("offset IS NULL").select("file_id", "record_id", "offset", "length", F.lit("extra").alias("fault"))
    result = scratch.keep(faults.union(extra), "result")
    scratch.drop("index", "replica", *(f"{side}-{i}" for side in ("one", "two", "wrong") for i in range(levels)))
    return result


def damaged(records: DataFrame) -> DataFrame:
    """A replica with known damage, to audit: by id, one record in 97 has its last byte changed, one in 211 is lost, one in 307 is there twice."""
    at = F.col("record_id")
    last = F.octet_length("record")
    cut = F.concat(F.substring("record", F.lit(1), last - 1), F.encode(F.lit("#"), "UTF-8"))
    broken = records.where(at % 211 != 5).withColumn("record", F.when(at % 97 == 3, cut).otherwise(F.col("record")))
    return broken.withColumn("_", F.explode(F.when(at % 307 == 7, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_")
