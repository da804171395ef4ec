"""Broadcast only what has been measured.

Equi-joins between tables carry no hint: Catalyst and AQE compare the size of a side with
``spark.sql.autoBroadcastJoinThreshold`` themselves.  Rule tables come out of a filter whose
result Catalyst cannot size, and a range join has no equi-key to fall back on; their size is
measured here first, and callers keep another way for when the bound fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagloom.small import small_table

RULE_ROWS = 2_000


def small_copy(df: DataFrame, rows: int = RULE_ROWS) -> DataFrame | None:
    """``df`` as a local relation if it has at most ``rows`` rows, else None.

    Never fetches more than ``rows + 1`` rows.  A local relation has a known size, so joins with
    it are broadcast, and what it was made from is not computed again.
    """
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        return None
    return small_table(df.sparkSession, [tuple(r) for r in found], df.schema)
