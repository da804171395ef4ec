"""Business tables of the tag models, as views over the given Parquet tables.

``Data`` builds the Spark side.  The SQL strings below it state the same views for the oracle,
written independently.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagloom.functions.bins import cut_bins
from tagloom.session import cut_lineage, fresh_folder
from tagloom.small import small_table

# The tag catalogue: (id, name, rule, level, pid).
CATALOGUE = [
    (1, "e-commerce", None, 1, -1),
    (2, "shop", None, 2, 1),
    (3, "population", None, 3, 2),
    (4, "commercial", None, 3, 2),
    (5, "behaviour", None, 3, 2),
    (6, "value", None, 3, 2),
    (7, "products", None, 3, 2),
    (318, "gender", "inType=hive\nhiveTable=tagloom_customer\nselectFieldNames=c_custkey,c_mktsegment", 4, 3),
    (319, "male", "BUILDING", 5, 318),
    (320, "female", "MACHINERY", 5, 318),
    (332, "nationality", "inType=hive\nhiveTable=tagloom_customer\nselectFieldNames=c_custkey,c_nationkey", 4, 3),
    (333, "nation one", "1", 5, 332),
    (334, "nation two", "2", 5, 332),
    (335, "nation three", "3", 5, 332),
    (336, "nation four", "4", 5, 332),
    (338, "age range", "inType=hive\nhiveTable=tagloom_customer\nselectFieldNames=c_custkey", 4, 3),
    (339, "fifties", "19500101-19591231", 5, 338),
    (340, "sixties", "19600101-19691231", 5, 338),
    (341, "seventies", "19700101-19791231", 5, 338),
    (342, "eighties", "19800101-19891231", 5, 338),
    (343, "nineties", "19900101-19991231", 5, 338),
    (344, "noughties", "20000101-20091231", 5, 338),
    (345, "tens", "20100101-20191231", 5, 338),
    (346, "twenties", "20200101-20291231", 5, 338),
    (347, "consumption cycle", "inType=hive\nhiveTable=tagloom_orders\nselectFieldNames=o_custkey,o_orderdate", 4, 4),
    (348, "a week", "0-7", 5, 347),
    (349, "two weeks", "8-14", 5, 347),
    (350, "a month", "15-30", 5, 347),
    (351, "two months", "31-60", 5, 347),
    (352, "three months", "61-90", 5, 347),
    (353, "four months", "91-120", 5, 347),
    (354, "five months", "121-150", 5, 347),
    (355, "six months", "151-180", 5, 347),
    (385, "a year", "181-365", 5, 347),
    (386, "longer", "366-3000", 5, 347),
    (356, "payment type", "inType=hive\nhiveTable=tagloom_orders\nselectFieldNames=o_custkey,o_orderpriority", 4, 4),
    (357, "urgent", "1-URGENT", 5, 356),
    (358, "high", "2-HIGH", 5, 356),
    (359, "medium", "3-MEDIUM", 5, 356),
    (360, "not specified", "4-NOT SPECIFIED", 5, 356),
    (361, "customer value", "inType=hive\nhiveTable=tagloom_orders\nselectFieldNames=o_custkey", 4, 6),
    (362, "very high", "0", 5, 361),
    (363, "high", "1", 5, 361),
    (364, "middle", "2", 5, 361),
    (365, "low", "3", 5, 361),
    (366, "very low", "4", 5, 361),
    (367, "activity", "inType=hive\nhiveTable=tagloom_events\nselectFieldNames=user_id", 4, 5),
    (368, "very active", "0", 5, 367),
    (369, "active", "1", 5, 367),
    (370, "inactive", "2", 5, 367),
    (371, "very inactive", "3", 5, 367),
    (372, "price sensitivity", "inType=hive\nhiveTable=tagloom_orders\nselectFieldNames=o_custkey", 4, 6),
    (373, "extremely", "0", 5, 372),
    (374, "rather", "1", 5, 372),
    (375, "somewhat", "2", 5, 372),
    (376, "hardly", "3", 5, 372),
    (377, "not at all", "4", 5, 372),
    (378, "shopping gender", "inType=hive\nhiveTable=tagloom_lineitem\nselectFieldNames=l_orderkey", 4, 5),
    (379, "shops male", "0", 5, 378),
    (380, "shops female", "1", 5, 378),
    (381, "shops either", "-1", 5, 378),
]
CATALOGUE_SCHEMA = "id bigint, name string, rule string, level int, pid bigint"
BRAND_BASE, PART_BASE = 1_000, 1_000_000

# Combined tags: (merge_tag_id, seq, basic_tag_id, connector to the next row).
COMBINED = [
    (1, 1, 319, "or"), (1, 2, 320, "and"), (1, 3, 348, "or"), (1, 4, 349, "and"), (1, 5, 333, "and"),
    (2, 1, 333, "or"), (2, 2, 334, "or"), (2, 3, 335, "and"), (2, 4, 319, "and"),
    (3, 1, 350, "and"),
    (4, 1, 320, "and"), (4, 2, 336, "or"), (4, 3, 351, "or"), (4, 4, 352, "and"),
]

# Dimension tables; one colour and one product are missing on purpose.
COLOURS = [(1, "AF"), (2, "AO"), (3, "NF"), (4, "NO"), (5, "RF")]
PRODUCTS = [(1, "ECONOMY"), (2, "LARGE"), (3, "MEDIUM"), (4, "PROMO"), (5, "SMALL")]
LABEL_COLOURS = ("RF", "RO", "NF")
LABEL_PRODUCTS = ("PROMO", "SMALL")

# Score cut points that spread the given data over all five scores.
RFM_R = cut_bins([54, 123, 220, 390], [5, 4, 3, 2, 1], "hi")
RFM_F = cut_bins([8, 10, 12, 14], [1, 2, 3, 4, 5], "lo")
RFM_M = cut_bins([1_710_000, 2_230_000, 2_670_000, 3_250_000], [1, 2, 3, 4, 5], "lo")
RFE_R = cut_bins([1, 2, 3, 7], [5, 4, 3, 2, 1], "hi")
RFE_F = cut_bins([60, 65, 70, 75], [1, 2, 3, 4, 5], "lo")
RFE_E = cut_bins([56, 62, 65, 70], [1, 2, 3, 4, 5], "lo")

RFM_COLUMNS = ["r_score", "f_score", "m_score"]
RFE_COLUMNS = ["r_score", "f_score", "e_score"]


_schemas: dict[str, StructType] = {}


class Data:
    """The given tables and the business views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is looked up once, as a catalog would."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def view(self, name: str) -> str:
        """The table as a session view, for sources that are found by name."""
        self.table(name).createOrReplaceTempView(f"tagloom_{name}")
        return f"tagloom_{name}"

    def folder_for(self, purpose: str) -> str:
        return fresh_folder(self.spark, purpose)

    def small(self, rows, ddl: str) -> DataFrame:
        return small_table(self.spark, rows, ddl)

    # as-of dates: the day after the last one in the data

    @cached_property
    def orders_as_of(self) -> Column:
        return self.table("orders").agg(F.date_add(F.max("o_orderdate").cast("date"), 1)).scalar()

    @cached_property
    def events_as_of(self) -> Column:
        return self.table("events").agg(F.date_add(F.max("ts").cast("date"), 1)).scalar()

    # business views

    @property
    def users(self) -> DataFrame:
        days = F.pmod(F.col("c_custkey") * 37, F.lit(29000)).cast("int")
        return self.table("customer").select(
            F.col("c_custkey").alias("uid"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("gender"),
            F.col("c_nationkey").alias("nationality"),
            F.col("c_acctbal").alias("balance"),
            F.date_add(F.lit("1950-01-01").cast("date"), days).alias("birthday"),
        )

    @property
    def contacts(self) -> DataFrame:
        """Users with synthetic identifiers."""
        uid = F.col("c_custkey").cast("string")
        return self.table("customer").select(
            F.col("c_custkey").alias("uid"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("13"), F.lpad(uid, 9, "0")).alias("phone"),
            F.concat(F.lower("c_mktsegment"), F.lit("."), uid, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("9"), F.lpad(uid, 8, "0")).alias("qq"),
            F.concat(F.lit("11010119500101"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("X")).alias("id_card"),
        )

    @property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("uid"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.col("o_orderdate").alias("finish_time"),
            F.col("o_orderpriority").alias("pay_code"),
            F.col("o_orderstatus").alias("status"),
        )

    @property
    def orders_with_coupons(self) -> DataFrame:
        """Orders with the discount of their lines; NULL for an order without lines.

        Lines are summed in whole hundredths of a cent, which is exact and stays in long
        arithmetic.
        """
        off = F.round(F.col("l_extendedprice") * 100).cast("bigint") * F.round(F.col("l_discount") * 100).cast("bigint")
        coupons = self.table("lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
            (F.sum(off).cast("decimal(19,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(19,4)").alias("coupon")
        )
        return self.orders.join(coupons, "order_id", "left")

    @property
    def visits(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id"),
            F.col("user_id").alias("uid"),
            F.col("ts").alias("log_time"),
            F.concat_ws("/", "event_type", F.get_json_object("props", "$.k")).alias("url"),
        )

    @property
    def lines(self) -> DataFrame:
        part = self.table("part").select(F.col("p_partkey"), F.col("p_type").alias("product"))
        line = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), "l_partkey",
            F.concat("l_returnflag", "l_linestatus").alias("colour"),
        )
        return line.join(part, line["l_partkey"] == part["p_partkey"]).select(
            "order_id", "colour", "product"
        )

    @property
    def colours(self) -> DataFrame:
        return self.small(COLOURS, "id int, name string")

    @property
    def products(self) -> DataFrame:
        return self.small(PRODUCTS, "id int, name string")

    # tags and profiles

    @property
    def model_tags(self) -> DataFrame:
        return self.small(CATALOGUE, CATALOGUE_SCHEMA)

    @cached_property
    def tags(self) -> DataFrame:
        """The stored definitions: the catalogue plus a product branch with a level-4 tag per brand
        and a level-5 tag per part."""
        part = self.table("part")
        brand_id = F.lit(BRAND_BASE) + F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint")
        brands = part.select(
            brand_id.alias("id"), F.col("p_brand").alias("name"),
            F.lit("inType=hive\nhiveTable=tagloom_lineitem\nselectFieldNames=l_partkey").alias("rule"),
            F.lit(4).alias("level"), F.lit(7).cast("bigint").alias("pid"),
        ).distinct()
        leaves = part.select(
            (F.lit(PART_BASE) + F.col("p_partkey")).alias("id"), F.col("p_name").alias("name"),
            F.col("p_partkey").cast("string").alias("rule"), F.lit(5).alias("level"),
            brand_id.alias("pid"),
        )
        return cut_lineage(self.model_tags.unionByName(brands).unionByName(leaves), "definitions")

    @property
    def profile_table(self) -> DataFrame:
        """Stored profiles of the users with a balance that is not negative, as comma text."""
        gender = F.when(F.col("c_mktsegment") == "BUILDING", "319").when(
            F.col("c_mktsegment") == "MACHINERY", "320"
        )
        nation = (F.lit(333) + F.col("c_nationkey") % 4).cast("string")
        cycle = (F.lit(348) + F.col("c_custkey") % 8).cast("string")
        return self.table("customer").where("c_acctbal >= 0").select(
            F.col("c_custkey").cast("string").alias("user_id"),
            F.concat_ws(",", gender, nation, cycle).alias("tag_ids"),
        )

    @property
    def profile(self) -> DataFrame:
        from tagloom.operators.profiles import load_profile

        return load_profile(self.profile_table)

    @property
    def combined(self) -> DataFrame:
        return self.small(COMBINED, "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string")


def _values(rows) -> str:
    def one(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            # chr(10) keeps line breaks inside a SQL literal
            return "'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
        return str(v)

    return ", ".join("(" + ", ".join(one(v) for v in row) + ")" for row in rows)


# Oracle views. Each is a common table expression without the leading WITH.

SQL_MODEL_TAGS = f"""model_tags AS (
  SELECT CAST(id AS BIGINT) AS id, name, rule, CAST(level AS INTEGER) AS level, CAST(pid AS BIGINT) AS pid
  FROM (VALUES {_values(CATALOGUE)}) v(id, name, rule, level, pid))"""

SQL_TAGS = SQL_MODEL_TAGS + f""", tags AS (
  SELECT * FROM model_tags
  UNION ALL
  SELECT DISTINCT {BRAND_BASE} + CAST(replace(p_brand, 'Brand#', '') AS BIGINT), p_brand,
    'inType=hive' || chr(10) || 'hiveTable=tagloom_lineitem' || chr(10) || 'selectFieldNames=l_partkey',
    4, CAST(7 AS BIGINT) FROM part
  UNION ALL
  SELECT {PART_BASE} + p_partkey, p_name, CAST(p_partkey AS VARCHAR), 5,
    {BRAND_BASE} + CAST(replace(p_brand, 'Brand#', '') AS BIGINT) FROM part)"""

SQL_COMBINED = f"""combined AS (
  SELECT * FROM (VALUES {_values(COMBINED)}) v(merge_tag_id, seq, basic_tag_id, connector))"""

SQL_PROFILE_TABLE = """profile_table AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id,
    CASE c_mktsegment WHEN 'BUILDING' THEN '319,' WHEN 'MACHINERY' THEN '320,' ELSE '' END
      || CAST(333 + c_nationkey % 4 AS VARCHAR) || ',' || CAST(348 + c_custkey % 8 AS VARCHAR) AS tag_ids
  FROM customer WHERE c_acctbal >= 0)"""

SQL_PROFILE_ROWS = SQL_PROFILE_TABLE + """, profile_rows AS (
  SELECT CAST(user_id AS BIGINT) AS uid, CAST(unnest(string_split(tag_ids, ',')) AS BIGINT) AS tag_id
  FROM profile_table)"""

SQL_USERS = """users AS (
  SELECT c_custkey AS uid, c_name AS name, c_mktsegment AS gender, c_nationkey AS nationality,
    c_acctbal AS balance, DATE '1950-01-01' + CAST(c_custkey * 37 % 29000 AS INTEGER) AS birthday
  FROM customer)"""

SQL_RFM = """rfm AS (
  SELECT o_custkey AS uid,
    CAST(date_diff('day', CAST(max(o_orderdate) AS DATE),
      (SELECT CAST(max(o_orderdate) AS DATE) + 1 FROM orders)) AS INTEGER) AS recency,
    count(o_orderkey) AS frequency,
    CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS monetary
  FROM orders GROUP BY o_custkey)"""

SQL_RFM_SCORES = SQL_RFM + """, rfm_scores AS (
  SELECT uid,
    CAST(CASE WHEN recency <= 54 THEN 5 WHEN recency <= 123 THEN 4 WHEN recency <= 220 THEN 3
      WHEN recency <= 390 THEN 2 ELSE 1 END AS DOUBLE) AS r_score,
    CAST(CASE WHEN frequency >= 14 THEN 5 WHEN frequency >= 12 THEN 4 WHEN frequency >= 10 THEN 3
      WHEN frequency >= 8 THEN 2 ELSE 1 END AS DOUBLE) AS f_score,
    CAST(CASE WHEN monetary >= 3250000 THEN 5 WHEN monetary >= 2670000 THEN 4
      WHEN monetary >= 2230000 THEN 3 WHEN monetary >= 1710000 THEN 2 ELSE 1 END AS DOUBLE) AS m_score
  FROM rfm)"""

SQL_RFE = """rfe AS (
  SELECT user_id AS uid,
    CAST(date_diff('day', CAST(max(ts) AS DATE), (SELECT CAST(max(ts) AS DATE) + 1 FROM events)) AS INTEGER) AS recency,
    count(event_type || '/' || regexp_extract(props, '[0-9]+')) AS frequency,
    count(DISTINCT event_type || '/' || regexp_extract(props, '[0-9]+')) AS engagements
  FROM events GROUP BY user_id)"""

SQL_RFE_SCORES = SQL_RFE + """, rfe_scores AS (
  SELECT uid,
    CAST(CASE WHEN recency <= 1 THEN 5 WHEN recency <= 2 THEN 4 WHEN recency <= 3 THEN 3 WHEN recency <= 7 THEN 2 ELSE 1 END AS DOUBLE) AS r_score,
    CAST(CASE WHEN frequency >= 75 THEN 5 WHEN frequency >= 70 THEN 4 WHEN frequency >= 65 THEN 3 WHEN frequency >= 60 THEN 2 ELSE 1 END AS DOUBLE) AS f_score,
    CAST(CASE WHEN engagements >= 70 THEN 5 WHEN engagements >= 65 THEN 4 WHEN engagements >= 62 THEN 3 WHEN engagements >= 56 THEN 2 ELSE 1 END AS DOUBLE) AS e_score
  FROM rfe)"""

SQL_LINES = """lines AS (
  SELECT l_orderkey AS order_id, l_returnflag || l_linestatus AS colour, p_type AS product
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

def sql_items(folds: int) -> str:
    """``items``: a row an order line, with coded colour and product, label and fold."""
    return f"""{SQL_LINES}, items AS MATERIALIZED (
    SELECT o_custkey AS uid, CASE WHEN colour IN ('RF', 'RO', 'NF') OR product IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS label,
      CASE colour {" ".join(f"WHEN '{name}' THEN {i}" for i, name in COLOURS)} ELSE 0 END AS colour_id,
      CASE product {" ".join(f"WHEN '{name}' THEN {i}" for i, name in PRODUCTS)} ELSE 0 END AS product_id,
      CAST('0x' || substr(md5(concat_ws(':', order_id, colour, product, '31')), 1, 15) AS BIGINT) % {folds} AS fold
    FROM lines JOIN orders ON o_orderkey = order_id)"""


SQL_CYCLE = """cycle_days AS (
  SELECT o_custkey AS uid, date_diff('day', CAST(max(o_orderdate) AS DATE),
    (SELECT CAST(max(o_orderdate) AS DATE) + 1 FROM orders)) AS days
  FROM orders GROUP BY o_custkey),
cycle AS (
  SELECT uid, CAST(CASE WHEN days BETWEEN 0 AND 7 THEN 348 WHEN days BETWEEN 8 AND 14 THEN 349
    WHEN days BETWEEN 15 AND 30 THEN 350 WHEN days BETWEEN 31 AND 60 THEN 351
    WHEN days BETWEEN 61 AND 90 THEN 352 WHEN days BETWEEN 91 AND 120 THEN 353
    WHEN days BETWEEN 121 AND 150 THEN 354 WHEN days BETWEEN 151 AND 180 THEN 355
    WHEN days BETWEEN 181 AND 365 THEN 385 WHEN days BETWEEN 366 AND 3000 THEN 386 END AS BIGINT) AS tag_id
  FROM cycle_days WHERE days BETWEEN 0 AND 3000)"""

SQL_PAY = """pay_counts AS (
  SELECT o_custkey AS uid, o_orderpriority AS code, count(*) AS uses FROM orders GROUP BY 1, 2),
pay_best AS (
  SELECT uid, code, uses FROM (
    SELECT *, row_number() OVER (PARTITION BY uid ORDER BY uses DESC, code) AS rn FROM pay_counts) WHERE rn = 1),
pay AS (
  SELECT uid, CAST(CASE code WHEN '1-URGENT' THEN 357 WHEN '2-HIGH' THEN 358 WHEN '3-MEDIUM' THEN 359
    ELSE 360 END AS BIGINT) AS tag_id
  FROM pay_best WHERE code <> '5-LOW')"""


def sql_centres(name: str, source: str, columns: list[str], k: int, steps: int) -> str:
    """KMeans steps from the diagonal of the box around the vectors of ``source``.

    ``{name}_c`` and ``{name}_a`` followed by a number are the centres after so many steps and the vectors
    with their nearest centre ``i`` and distance ``d``; ``{name}_v`` are the vectors with their weight.
    """
    listed = ", ".join(columns)
    starts = ", ".join(f"min({c}) + (max({c}) - min({c})) * i / {max(k - 1, 1)} AS {c}" for c in columns)
    distance = " + ".join(f"(v.{c} - c.{c}) * (v.{c} - c.{c})" for c in columns)
    means = ", ".join(f"coalesce(round(sum(a.w * a.{c}) / sum(a.w), 9), any_value(c.{c})) AS {c}" for c in columns)
    out = [
        f"{name}_v AS MATERIALIZED (SELECT {listed}, count(*) AS w FROM {source} GROUP BY {listed})",
        f"{name}_c0 AS MATERIALIZED (SELECT i, {starts} FROM {name}_v, range({k}) t(i) GROUP BY i)",
    ]
    for n in range(steps + 1):
        if n:
            out.append(f"{name}_c{n} AS MATERIALIZED (SELECT c.i, {means} FROM {name}_c{n - 1} c LEFT JOIN {name}_a{n - 1} a ON a.i = c.i GROUP BY c.i)")
        out.append(f"""{name}_a{n} AS MATERIALIZED (
    SELECT v.*, c.i, {distance} AS d FROM {name}_v v, {name}_c{n} c
    QUALIFY row_number() OVER (PARTITION BY {", ".join(f"v.{c}" for c in columns)} ORDER BY {distance}, c.i) = 1)""")
    return ",\n  ".join(out)
