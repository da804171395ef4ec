from conftest import rows
from pyspark.sql import functions as F

from tagloom.operators import preparation
from tagloom.plans.all_queries import run
from tagloom.plans.datasets import Data

SMALL = "/root/testdata/sf0.01"


def test_orders_are_normalised(spark):
    data = Data(spark, SMALL)
    got = run("gen_normalize_orders", spark, SMALL).cache()
    before = data.orders.select("order_id", F.col("uid").alias("old"), "status", F.to_date("finish_time").alias("d"),
                                F.col("pay_code").alias("p"))
    both = got.join(before, "order_id").cache()
    assert both.count() == got.count() == 15000
    assert both.where("old < 950 and uid <> old").count() == 0
    assert both.where("old >= 950 and uid = 0").count() == 0
    assert both.where("datediff(finish_date, d) <> 300").count() == 0
    assert {r[0] for r in got.select("pay_code").distinct().collect()} == set(preparation.PAY_NAMES)
    assert dict(got.select("pay_code", "pay_name").distinct().collect()) == preparation.PAY_NAMES
    assert both.where("p = '1-URGENT' and pay_code <> 'alipay'").count() == 0
    assert got.where("uid > 950 or uid < 0").count() == 0
    spread = both.where("p = '5-LOW'").groupBy("pay_code").count().collect()
    assert len(spread) == 4 and min(r["count"] for r in spread) > 500


def test_choices_do_not_depend_on_partitioning(spark):
    a = preparation.synthetic_users(spark, 500)
    b = preparation.synthetic_users(spark.range(500).withColumnRenamed("id", "uid").repartition(13))
    assert rows(a) == rows(b)
    assert a.where("length(phone) <> 11 or not phone rlike '^1[3-8][0-9]{9}$'").count() == 0
    assert a.where("not ip rlike '^[0-9]{1,3}([.][0-9]{1,3}){3}$'").count() == 0


def test_missing_users_are_filled_from_real_ones(spark):
    got = run("gen_fill_missing_keys", spark, SMALL).cache()
    data = Data(spark, SMALL)
    assert got.count() == 15000 and got.select("order_id").distinct().count() == 15000
    strange = got.join(data.users.select("uid"), "uid", "left_anti")
    assert strange.count() == 0
    both = got.join(data.orders.select("order_id", F.col("uid").alias("old"), "status"), "order_id")
    assert both.where("status <> 'P' and old <> 0 and uid <> old").count() == 0
    assert both.where("status = 'P' and uid = 0").count() == 0
    busiest = both.where("status = 'P'").groupBy("uid").count().agg(F.max("count")).first()[0]
    assert busiest < 25


def test_numbering_has_no_gaps(spark):
    df = spark.range(0, 3000, 3).withColumnRenamed("id", "uid").repartition(11)
    got = preparation.numbered(df, "uid").orderBy("uid").collect()
    assert [r["place"] for r in got] == list(range(1000))
    assert [r["uid"] for r in got] == list(range(0, 3000, 3))
