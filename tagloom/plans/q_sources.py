"""Sources and sinks.  Files are first written by Spark from the given tables, then read back."""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tagloom.functions import rules
from tagloom.functions.text import mask_name
from tagloom.operators import clustering, metrics
from tagloom.plans.book import query
from tagloom.plans.datasets import RFM_COLUMNS, RFM_F, RFM_M, RFM_R, SQL_TAGS, Data
from tagloom.session import cut_lineage
from tagloom.sources import keyed, readers
from tagloom.sources.appends import append_batch, appended
from tagloom.sources.models import load_or_train

@query("src_rule_dispatch", """
  SELECT 'hdfs' AS source, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer
  UNION ALL SELECT 'json', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
  UNION ALL SELECT 'hive', CAST(n_nationkey AS VARCHAR), n_name FROM nation
  UNION ALL SELECT 'mysql', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_size > 25
  UNION ALL SELECT 'hbase', CAST(o_orderkey AS VARCHAR), o_orderpriority FROM orders WHERE o_orderstatus = 'F'
""")
def src_rule_dispatch(d: Data):
    root = d.folder_for("dispatch")
    d.table("customer").write.option("header", True).option("sep", "\t").csv(f"{root}/customer")
    d.table("supplier").select("s_suppkey", "s_name").write.json(f"{root}/supplier")
    for name in ("nation", "part", "orders"):
        d.view(name)
    texts = {
        "hdfs": f"inType=hdfs\ninPath={root}/customer\nsperator=\\t\nselectFieldNames=c_custkey,c_name",
        "json": f"inType=json\ninPath={root}/supplier\nselectFieldNames=s_suppkey,s_name\n"
                "schema=s_suppkey bigint, s_name string",
        "hive": "inType=hive\nhiveTable=tagloom_nation\nselectFieldNames=n_nationkey,n_name",
        "mysql": "inType=mysql\nsql=SELECT p_partkey, p_name FROM tagloom_part WHERE p_size > 25",
        "hbase": "inType=hbase\nhbaseTable=tagloom_orders\nselectFieldNames=o_orderkey,o_orderpriority\n"
                 "filterConditions=o_orderstatus[eq]F",
    }
    out = None
    for kind, text in texts.items():
        df = readers.open_source(d.spark, text)
        rows = df.select(
            F.lit(kind).alias("source"), F.col(df.columns[0]).cast("string").alias("id"),
            F.col(df.columns[1]).alias("name"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query("src_rule_params", """
  SELECT p_partkey AS id, 'mysql' AS in_type,
    'jdbc:mysql://db.example.com/shop?useUnicode=true&brand=' || p_brand AS url,
    'part_' || CAST(p_size AS VARCHAR) AS db_table, CAST(3 AS INTEGER) AS n_params FROM part
""")
def src_rule_params(d: Data):
    text = F.concat(
        F.lit("inType=mysql\n url = jdbc:mysql://db.example.com/shop?useUnicode=true&brand="), "p_brand",
        F.lit("\ndbTable=part_"), F.col("p_size").cast("string"), F.lit("\n\nno separator here"),
    )
    params = d.table("part").select(F.col("p_partkey").alias("id"), rules.rule_params(text).alias("p"))
    return params.select(
        "id", F.col("p")["inType"].alias("in_type"), F.col("p")["url"].alias("url"),
        F.col("p")["dbTable"].alias("db_table"), F.size("p").alias("n_params"),
    )


@query("src_wide_table", """
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal
  FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def src_wide_table(d: Data):
    return readers.wide_table(
        d.table("customer"), ["c_custkey", "c_name", "c_acctbal"], "c_mktsegment[eq]BUILDING"
    )


@query("src_wide_table_rowkey", """
  SELECT CAST(o_orderkey AS VARCHAR) AS "row", CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority
  FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority >= '3'
""")
def src_wide_table_rowkey(d: Data):
    return readers.wide_table(
        d.table("orders"), ["o_custkey", "o_orderpriority"], "o_orderstatus[ne]F,o_orderpriority[GE]3",
        row_key="o_orderkey",
    )


@query("src_jdbc_table", """
  SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey
""")
def src_jdbc_table(d: Data):
    d.view("orders")
    return readers.relational(
        d.spark,
        "( SELECT o_custkey, count(*) AS n FROM tagloom_orders WHERE o_orderstatus = 'O' GROUP BY o_custkey ) AS t",
    )


@query("src_catalog_table", """
  SELECT event_id, user_id, event_type FROM events
  WHERE CAST(ts AS DATE) BETWEEN (SELECT CAST(max(ts) AS DATE) - 10 FROM events)
    AND (SELECT CAST(max(ts) AS DATE) FROM events)
""")
def src_catalog_table(d: Data):
    view = d.view("events")
    text = (
        f"inType=hive\nhiveTable={view}\nselectFieldNames=event_id,user_id,event_type\nwhereCondition=ts#day#10"
    )
    return readers.open_source(d.spark, text, d.events_as_of)


@query("src_delimited", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier")
def src_delimited(d: Data):
    path = d.folder_for("delimited")
    d.table("supplier").write.option("header", True).option("sep", "|").csv(path)
    return readers.delimited(d.spark, path, "|", ["s_suppkey", "s_name", "s_acctbal"])


@query("src_json", "SELECT event_id, user_id, event_type, value FROM events")
def src_json(d: Data):
    path = d.folder_for("json")
    d.table("events").select("event_id", "user_id", "event_type", "value", "props").write.json(path)
    return readers.json_lines(
        d.spark, path, ["event_id", "user_id", "event_type", "value"],
        "event_id bigint, user_id bigint, event_type string, value double",
    )


@query("src_typed_csv", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def src_typed_csv(d: Data):
    path = d.folder_for("typed")
    d.table("part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.csv(path)
    return readers.delimited(
        d.spark, path, ",", schema="p_partkey bigint, p_name string, p_size int, p_retailprice double",
        header=False,
    )


@query("src_libsvm", "SELECT CAST(label AS DOUBLE) AS label, count(*) AS n, CAST(64 AS INTEGER) AS n_features FROM embeddings GROUP BY label")
def src_libsvm(d: Data):
    path = d.folder_for("libsvm")
    vectors = d.table("embeddings").select(
        F.col("label").cast("double"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    vectors.write.format("libsvm").save(path)
    back = readers.sparse_vectors(d.spark, path, 64)
    sized = back.select("label", F.size(vector_to_array("features")).alias("n_features"))
    return sized.groupBy("label", "n_features").agg(F.count("*").alias("n"))


def _event_lines(d: Data, path: str) -> None:
    """Tab-separated events; lines of type ``error`` lack the last field."""
    event = d.table("events")
    full = F.concat_ws("\t", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                       "event_type", F.col("value").cast("string"))
    short = F.concat_ws("\t", F.col("event_id").cast("string"), F.col("user_id").cast("string"), "event_type")
    event.select(F.when(F.col("event_type") == "error", short).otherwise(full).alias("value")).write.text(path)


@query("src_text_lines", """
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
    CAST(value AS VARCHAR) AS value FROM events WHERE event_type <> 'error'
""")
def src_text_lines(d: Data):
    path = d.folder_for("lines")
    _event_lines(d, path)
    return readers.typed_lines(d.spark, path, ["event_id", "user_id", "event_type", "value"])


@query("src_tag_definitions", f"""
  WITH {SQL_TAGS}
  SELECT f.id AS tag_id, c.id, c.name, c.rule, c.level
  FROM tags f JOIN tags c ON c.id = f.id OR c.pid = f.id WHERE f.level = 4
""")
def src_tag_definitions(d: Data):
    return readers.definition_sets(d.tags)


@query("src_row_keys", "SELECT DISTINCT user_id FROM events")
def src_row_keys(d: Data):
    return readers.row_keys(d.table("events"), "user_id")


def _last_priorities(d: Data):
    """Cells to change: each customer's latest order priority; suppliers are new keys."""
    last = d.table("orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("segment")
    )
    changed = last.select("id", "segment", F.lit(None).cast("double").alias("balance"))
    added = d.table("supplier").select(
        (-1 - F.col("s_suppkey")).alias("id"), F.lit("SUPPLIER").alias("segment"),
        F.col("s_acctbal").alias("balance"),
    )
    return changed.unionByName(added)


def _customer_rows(d: Data):
    return d.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
    )


@query("sink_keyed_upsert", """
  WITH last AS (
    SELECT o_custkey AS id, o_orderpriority AS segment FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1)
  SELECT coalesce(c_custkey, l.id) AS id, coalesce(l.segment, c_mktsegment) AS segment, c_acctbal AS balance
  FROM customer FULL JOIN last l ON l.id = c_custkey
  UNION ALL SELECT -1 - s_suppkey, 'SUPPLIER', s_acctbal FROM supplier
""")
def sink_keyed_upsert(d: Data):
    root = d.folder_for("upsert")
    keyed.write_version(_customer_rows(d), root)
    current = keyed.read_version(d.spark, root)
    keyed.write_version(keyed.upsert(current, _last_priorities(d), "id"), root)
    return keyed.read_version(d.spark, root)


@query("sink_delete_by_key", """
  SELECT c_custkey AS id, c_mktsegment AS segment,
    CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN 0.0 ELSE c_acctbal END AS balance
  FROM customer WHERE c_acctbal >= 0
""")
def sink_delete_by_key(d: Data):
    root = d.folder_for("delete")
    keyed.write_version(_customer_rows(d), root)
    current = keyed.read_version(d.spark, root)
    left = keyed.delete_keys(current, current.where("balance < 0"), "id")
    keyed.write_version(left, root)
    current = keyed.read_version(d.spark, root)
    big = d.table("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("id")).distinct()
    one_cell = big.join(current.select("id"), "id", "left_semi").withColumn("balance", F.lit(0.0))
    keyed.write_version(keyed.upsert(current, one_cell, "id"), root)
    return keyed.read_version(d.spark, root)


@query("sink_append", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def sink_append(d: Data):
    path = d.folder_for("append")
    rows = d.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    append_batch(rows.where("o_orderstatus = 'F'"), path, 0)
    append_batch(rows.where("o_orderstatus <> 'F'"), path, 1)
    append_batch(rows.where("o_orderstatus = 'F'"), path, 0)  # a batch that runs again adds nothing
    return appended(d.spark, path)


@query("sink_stringify_sync", """
  SELECT CAST(doc_id AS VARCHAR) AS row_key, 'lang' AS qualifier, lang AS value FROM documents WHERE trim(lang) <> ''
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'source', source FROM documents WHERE trim(source) <> ''
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'n_chars', CAST(n_chars AS VARCHAR) FROM documents WHERE n_chars IS NOT NULL
  UNION ALL SELECT CAST(d.doc_id AS VARCHAR), 'quality', CAST(quality AS VARCHAR)
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL
""")
def sink_stringify_sync(d: Data):
    wide = d.table("documents").select("doc_id", "lang", "source", "n_chars").join(
        d.table("labels").select("doc_id", F.col("quality").alias("QUALITY")), "doc_id", "left"
    )
    return keyed.to_cells(wide, "doc_id")


@query("sink_cell_bulk_load", """
  SELECT CAST(event_id AS VARCHAR) AS row_key, 'detail' AS family, q AS qualifier,
    CASE q WHEN 'event_id' THEN CAST(event_id AS VARCHAR) WHEN 'user_id' THEN CAST(user_id AS VARCHAR)
      WHEN 'event_type' THEN event_type ELSE CAST(value AS VARCHAR) END AS value
  FROM events, (VALUES ('event_id'), ('user_id'), ('event_type'), ('value')) v(q)
  WHERE event_type <> 'error'
""")
def sink_cell_bulk_load(d: Data):
    root = d.folder_for("cells")
    _event_lines(d, f"{root}/lines")
    columns = ["event_id", "user_id", "event_type", "value"]
    rows = readers.typed_lines(d.spark, f"{root}/lines", columns)
    keyed.write_cells(keyed.to_cells(rows, "event_id", columns, family="detail"), f"{root}/cells")
    return d.spark.read.parquet(f"{root}/cells")


@query("sink_audience_export", """
  SELECT CAST(c_custkey AS VARCHAR) AS member, substr(c_name, 1, 1) || '**' AS masked_name, c_mktsegment AS segment
  FROM customer WHERE c_acctbal > 5000
""")
def sink_audience_export(d: Data):
    path = d.folder_for("export")
    people = d.table("customer").where("c_acctbal > 5000").withColumn("masked", mask_name("c_name"))
    keyed.export_delimited(
        people, {"c_custkey": "member", "masked": "masked_name", "c_mktsegment": "segment"}, path
    )
    return readers.delimited(d.spark, path, ",")


@query("sink_model_store")
def sink_model_store(d: Data):
    scores = metrics.rfm_scores(metrics.rfm_metrics(d.orders, d.orders_as_of, scale=2), RFM_R, RFM_F, RFM_M)
    scores = cut_lineage(scores, "scores")
    vectors = clustering.cluster_vectors(scores, RFM_COLUMNS)
    path = d.folder_for("model")

    def train():
        return clustering.best_by_iterations(vectors, 5, weight="weight")[0]

    def never():
        raise AssertionError("a stored model must not be trained again")

    load_or_train(d.spark, path, KMeansModel, train)
    stored = load_or_train(d.spark, path, KMeansModel, never)
    return stored.transform(clustering.assembled(scores, RFM_COLUMNS)).select("uid", "prediction")
