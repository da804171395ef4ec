"""Data preparation jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.operators import preparation
from tagloom.plans.book import query
from tagloom.plans.datasets import Data


def _hash(key: str, salt: int = 0) -> str:
    """``portable_hash`` for the oracles."""
    return f"CAST('0x' || substr(md5(concat_ws(':', {key}, '{salt}')), 1, 15) AS BIGINT)"


def _one_of(values, key: str, salt: int) -> str:
    return f"[{', '.join(repr(v) for v in values)}][{_hash(key, salt)} % {len(values)} + 1]"


@query("gen_normalize_orders", f"""
  WITH o AS (SELECT o_orderkey AS order_id, CASE WHEN o_custkey >= 950 THEN {_hash("o_orderkey")} % 950 + 1 ELSE o_custkey END AS uid,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' WHEN '2-HIGH' THEN 'wxpay' WHEN '3-MEDIUM' THEN 'chinapay' WHEN '4-NOT SPECIFIED' THEN 'cod'
        ELSE {_one_of(preparation.PAY_NAMES, "o_orderkey", 1)} END AS pay_code,
      CAST(o_orderdate AS DATE) + 300 AS finish_date FROM orders)
  SELECT order_id, uid, pay_code, CAST(finish_date AS DATE) AS finish_date,
    CASE pay_code {' '.join(f"WHEN '{code}' THEN '{name}'" for code, name in preparation.PAY_NAMES.items())} END AS pay_name FROM o
""")
def gen_normalize_orders(d: Data):
    codes = F.create_map(*[F.lit(x) for x in (
        "1-URGENT", "alipay", "2-HIGH", "wxpay", "3-MEDIUM", "chinapay", "4-NOT SPECIFIED", "cod", "5-LOW", "other")])
    raw = d.orders.select(
        "order_id", "uid", codes[F.col("pay_code")].alias("pay_code"), F.to_date("finish_time").alias("finish_date")
    )
    return preparation.normalize_orders(raw, 950)


@query("gen_fill_missing_keys", f"""
  WITH real AS (SELECT c_custkey AS uid, row_number() OVER (ORDER BY c_custkey) - 1 AS place, count(*) OVER () AS n FROM customer WHERE c_custkey <> 0)
  SELECT o_orderkey AS order_id, o_custkey AS uid FROM orders WHERE o_orderstatus <> 'P' AND o_custkey <> 0
  UNION ALL SELECT o_orderkey, uid FROM orders JOIN real ON place = {_hash("o_orderkey")} % n WHERE o_orderstatus = 'P' OR o_custkey = 0
""")
def gen_fill_missing_keys(d: Data):
    """Orders of status P have lost their user."""
    raw = d.orders.select("order_id", F.when(F.col("status") == "P", 0).otherwise(F.col("uid")).cast("bigint").alias("uid"))
    return preparation.fill_missing_users(raw, d.users)


@query("gen_synthetic_users", f"""
  SELECT c_custkey AS uid, {_one_of(preparation._GIVEN, "c_custkey", 3)} || ' ' || {_one_of(preparation._FAMILY, "c_custkey", 2)} AS name,
    CAST({_hash("c_custkey", 4)} % 2 AS INTEGER) AS sex, ({_hash("c_custkey", 5)} % 300 + 1) || ' ' || {_one_of(preparation._ROADS, "c_custkey", 6)} AS address,
    {_one_of(preparation._MOBILE_HEADS, "c_custkey", 7)} || lpad(CAST({_hash("c_custkey", 8)} % 100000000 AS VARCHAR), 8, '0') AS phone,
    'user' || c_custkey || '@' || {_one_of(preparation._DOMAINS, "c_custkey", 9)} AS email,
    {" || '.' || ".join(f"({_hash('c_custkey', 10 + i)} % 254 + 1)" for i in range(4))} AS ip
  FROM customer
""")
def gen_synthetic_users(d: Data):
    return preparation.synthetic_users(d.users.select("uid"))
