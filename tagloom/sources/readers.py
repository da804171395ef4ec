"""Opening the business data a level-4 rule names."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.functions.conditions import condition_filter, relative_window
from tagloom.functions.rules import parse_rule

Params = Mapping[str, str]

#: Rows of a relational table that one task may read.
ONE_TASK_ROWS = 5_000_000


def fields(text: str) -> list[str]:
    return [name.strip() for name in text.split(",") if name.strip()]


def wide_table(
    table: DataFrame, select: list[str], conditions: str | None = None, row_key: str | None = None,
    stringify: bool = True, missing_passes: bool = False,
) -> DataFrame:
    """Chosen columns of a wide table, as text unless ``stringify`` is off.

    With ``row_key`` the key comes first, as column ``row``.  Conditions apply before the
    projection, on text or typed values as ``stringify`` says, and reach the scan when typed.
    """
    if conditions:
        table = table.where(condition_filter(conditions, as_text=stringify, missing_passes=missing_passes))
    out = [F.col(c).cast("string").alias(c) if stringify else F.col(c) for c in select]
    if row_key:
        out = [F.col(row_key).cast("string").alias("row"), *out]
    return table.select(*out)


def row_keys(table: DataFrame, key: str) -> DataFrame:
    return table.select(key).distinct()


def delimited(
    spark: SparkSession, path: str, separator: str = "\t", select: list[str] | None = None,
    schema: StructType | str | None = None, header: bool = True,
) -> DataFrame:
    """Delimited text; with a schema nothing is inferred, without one all columns are text."""
    reader = spark.read.option("sep", separator).option("header", header)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", True)
    df = reader.csv(path)
    return df.select(*select) if select else df


def json_lines(
    spark: SparkSession, path: str, select: list[str] | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """JSON lines; give a schema (or the columns) for large data, or the reader scans it twice."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.json(path)
    return df.select(*select) if select else df


def catalog_table(
    spark: SparkSession, name: str, select: list[str] | None = None, condition: Column | None = None
) -> DataFrame:
    df = spark.table(name)
    if condition is not None:
        df = df.where(condition)
    return df.select(*select) if select else df


def key_bounds(ask: Callable[[str], DataFrame], table: str, key: str, parts: int) -> list:
    """Where about equal parts of a table begin in key order, the first part left out; equal keys are in one part.

    ``ask`` runs a subquery where the table lives, so only the bounds, at most ``parts``, come back.
    """
    dealt = f"( SELECT {key} AS low, NTILE({parts}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL ) AS dealt"
    found = ask(f"( SELECT part, MIN(low) AS low FROM {dealt} GROUP BY part ) AS bounds").collect()
    return sorted({row["low"] for row in found})[1:]


def _sql_literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    raise ValueError(f"cannot cut a key of type {type(value).__name__} into ranges")


def range_predicates(key: str, bounds: Sequence) -> list[str]:
    """One condition a part; every row meets exactly one, rows without a key the first.

    Keys are numbers without rounding, dates or timestamps: texts may be ordered otherwise in the database.
    """
    marks = [_sql_literal(b) for b in bounds]
    if not marks:
        return ["1 = 1"]
    inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(marks, marks[1:])]
    return [f"{key} < {marks[0]} OR {key} IS NULL", *inner, f"{key} >= {marks[-1]}"]


def relational(
    spark: SparkSession, table: str, url: str | None = None, select: list[str] | None = None,
    key: str | None = None, parts: int = 32, **options,
) -> DataFrame:
    """A table, or a subquery ``( SELECT … ) AS name``, of a relational database.

    Without a URL the same text is resolved by the session itself.  With ``key`` the database is asked for the
    bounds of ``parts`` equal parts of it, and each part is read by a task of its own; ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` do so by even steps.  With neither, one task reads
    everything, so the table is counted first and one of more than ``ONE_TASK_ROWS`` rows is refused.
    """
    if url is None:
        df = spark.sql(f"SELECT * FROM {table}")
        return df.select(*select) if select else df

    def ask(text: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=url, dbtable=text, **options).load()

    if key:
        predicates = range_predicates(key, key_bounds(ask, table, key, parts))
        df = spark.read.jdbc(url, table, predicates=predicates, properties=options)
    else:
        if "partitionColumn" not in options:
            refuse_large(ask, table)
        df = ask(table)
    return df.select(*select) if select else df


def refuse_large(ask: Callable[[str], DataFrame], table: str) -> None:
    """An error if ``table`` has too many rows for one task; the database counts them."""
    rows = ask(f"( SELECT COUNT(*) AS n FROM {table} ) AS counted").first()["n"]
    if rows > ONE_TASK_ROWS:
        raise ValueError(f"{rows} rows in one task: name a key, or partitionColumn with its bounds, for {table}")


def typed_lines(
    spark: SparkSession, path: str, columns: list[str], separator: str = "\t"
) -> DataFrame:
    """Text lines split into exactly ``len(columns)`` fields; other lines are left out."""
    parts = F.split("value", separator, -1)
    lines = spark.read.text(path).select(parts.alias("f")).where(F.size("f") == len(columns))
    return lines.select(*[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def sparse_vectors(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """libsvm lines as ``(label, features)``."""
    return spark.read.format("libsvm").option("numFeatures", n_features).load(path)


def definition_sets(tags: DataFrame) -> DataFrame:
    """For every level-4 tag, the tag itself and its direct children: ``(tag_id, id, …)``."""
    four = tags.where("level = 4")
    own = four.select(F.col("id").alias("tag_id"), "id", "name", "rule", "level")
    five = tags.where("level = 5")
    below = five.join(four.select(F.col("id").alias("_id")), F.col("pid") == F.col("_id"), "left_semi")
    return own.unionByName(below.select(F.col("pid").alias("tag_id"), "id", "name", "rule", "level"))


def definition_set(tags: DataFrame, tag_id: int) -> DataFrame:
    """One tag and its children, ordered by level and id."""
    own = tags.where((F.col("id") == tag_id) | (F.col("pid") == tag_id))
    return own.select("id", "name", "rule", "level").orderBy("level", "id")


def tag_rule(tags: DataFrame, tag_id: int) -> dict[str, str]:
    """The parsed rule of a level-4 tag: one small row on the driver."""
    row = tags.where((F.col("id") == tag_id) & (F.col("level") == 4)).select("rule").first()
    if row is None:
        raise LookupError(f"no level-4 tag {tag_id}")
    return parse_rule(row["rule"] or "")


def _window(params: Params, as_of: Column | None) -> Column | None:
    text = params.get("whereCondition")
    if not text:
        return None
    if "#" not in text:
        return condition_filter(text, as_text=False)
    if as_of is None:
        raise ValueError("a relative window needs as_of")
    return relative_window(text, as_of)


def _read_wide(spark, params, as_of):
    """A Parquet path, or a catalog table under the wide table's name."""
    table = spark.read.parquet(params["path"]) if "path" in params else spark.table(params["hbaseTable"])
    window = _window(params, as_of)
    table = table if window is None else table.where(window)
    typed = params.get("typed", "false") == "true"
    return wide_table(table, fields(params["selectFieldNames"]), params.get("filterConditions"),
                      params.get("rowKey"), stringify=not typed)


def _read_relational(spark, params, as_of):
    select = fields(params.get("selectFieldNames", ""))
    extra = {k: params[k] for k in ("driver", "user", "password", "partitionColumn", "lowerBound",
                                    "upperBound", "numPartitions") if k in params}
    table = f"( {params['sql']} ) AS tmp" if "sql" in params else params["dbTable"]
    return relational(spark, table, params.get("url"), select or None, params.get("partitionKey"), **extra)


def _read_catalog(spark, params, as_of):
    return catalog_table(spark, params["hiveTable"], fields(params["selectFieldNames"]), _window(params, as_of))


def _read_delimited(spark, params, as_of):
    separator = params.get("sperator") or params.get("separator") or "\t"
    return delimited(spark, params["inPath"], separator.replace("\\t", "\t"),
                     fields(params["selectFieldNames"]), params.get("schema"))


def _read_json(spark, params, as_of):
    return json_lines(spark, params["inPath"], fields(params["selectFieldNames"]), params.get("schema"))


# The source types a rule may name.
READERS: dict[str, Callable] = {
    "hbase": _read_wide,
    "parquet": _read_wide,
    "mysql": _read_relational,
    "hive": _read_catalog,
    "hdfs": _read_delimited,
    "json": _read_json,
}


def open_source(spark: SparkSession, params: Params | str, as_of: Column | None = None) -> DataFrame:
    """The data frame a rule (text or parsed) describes; an unknown ``inType`` is an error."""
    params = parse_rule(params) if isinstance(params, str) else params
    kind = params.get("inType", "").lower()
    if kind not in READERS:
        raise ValueError(f"unknown source type {kind!r}")
    return READERS[kind](spark, params, as_of)
