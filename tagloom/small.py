"""Small tables made on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Literal rows as a local relation.

    Unlike rows that go through an RDD, a local relation has a known size, so Catalyst plans a
    broadcast join with it at once instead of a shuffle that AQE might repair later.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow))
