"""Tag lists: comma text at the edges, sorted ``array<bigint>`` inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<bigint>"


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_list(text) -> Column:
    """``"319,322"`` as ``[319, 322]``; blank parts vanish, NULL stays NULL.

    A part that is no tag id ends the job: dropping it would delete the tag when the list is stored.
    """
    parts = F.filter(F.transform(F.split(_col(text), ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.transform(parts, lambda p: F.coalesce(
        p.try_cast("bigint"), F.raise_error(F.concat(F.lit("not a tag id: "), p)).cast("bigint")
    ))


def join_list(tags) -> Column:
    return F.array_join(_col(tags), ",")


def _or_empty(tags) -> Column:
    return F.coalesce(_col(tags), F.array().cast(EMPTY))


def append_tag(tags, tag) -> Column:
    """Add one tag; order of first occurrence is kept and nothing appears twice."""
    return append_tags(tags, F.array_compact(F.array(_col(tag).cast("bigint"))))


def append_tags(tags, added) -> Column:
    """The same for a list of tags."""
    return F.array_distinct(F.concat(_or_empty(tags), _or_empty(added)))


def replace_siblings(tags, siblings, tag) -> Column:
    """Drop every tag of the same family, then add the new one; sorted."""
    return replace_family(tags, siblings, F.array_compact(F.array(_col(tag).cast("bigint"))))


def replace_family(tags, siblings, added) -> Column:
    """The same for a list of tags."""
    return F.array_sort(F.array_union(F.array_except(_or_empty(tags), siblings), _or_empty(added)))


def tag_array(ids) -> Column:
    return F.array(*[F.lit(int(i)) for i in ids]).cast(EMPTY)
