import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.functions import bins
from tagloom.operators import metrics, tagging

def as_of():
    return F.lit(dt.date(2019, 6, 1))

RFM_ROWS = [
    ("1", "20190519", 1998), ("1", "20190522", 2998), ("1", "20190521", 1998), ("2", "20190523", 1099),
    ("2", "20190520", 909), ("3", "20190519", 1999), ("1", "20190519", 2499), ("3", "20190519", 1499),
    ("4", "20190519", 1998), ("1", "20190519", 2099), ("1", "20190519", 1899), ("2", "20190519", 499),
    ("1", "20190519", 2199), ("3", "20190519", 1799), ("1", "20190519", 2249),
]


def day(text):
    return dt.datetime.strptime(text, "%Y%m%d").date()


def test_rfm_rows(table):
    orders = table([(int(u), i, Decimal(a), day(d)) for i, (u, d, a) in enumerate(RFM_ROWS)],
                   "uid bigint, order_id int, amount decimal(12,2), finish_time date")
    got = {r["uid"]: (r["recency"], r["frequency"], int(r["monetary"])) for r in metrics.rfm_metrics(orders, as_of()).collect()}
    assert got == {1: (10, 8, 17939), 2: (9, 3, 2507), 3: (13, 3, 5297), 4: (13, 1, 1998)}


def test_amounts_are_rounded_before_the_sum(table):
    orders = table([(1, i, Decimal("2479.45"), dt.date(2019, 5, 1)) for i in range(2)],
                   "uid bigint, order_id int, amount decimal(12,2), finish_time date")
    whole = metrics.rfm_metrics(orders, as_of())
    assert dict(whole.dtypes)["monetary"] == "decimal(20,0)"
    assert whole.first()["monetary"] == Decimal(4958)
    assert metrics.rfm_metrics(orders, as_of(), scale=2).first()["monetary"] == Decimal("4958.90")


def test_rfm_score_samples(table):
    scored = metrics.rfm_scores(table([(1, 77, 240, 528430.0), (102, 77, 107, 141954.0), (107, 77, 110, 250000.0)],
                                      "uid bigint, recency int, frequency bigint, monetary double"))
    assert rows(scored) == [(1, 1.0, 5.0, 5.0), (102, 1.0, 3.0, 4.0), (107, 1.0, 3.0, 5.0)]


def test_rfe_counts_views_and_distinct_pages(table):
    visits = table([(1, "a", dt.date(2019, 5, 1)), (1, "a", dt.date(2019, 5, 3)), (1, "b", dt.date(2019, 5, 2)),
                    (2, None, dt.date(2019, 5, 30))], "uid bigint, url string, log_time date")
    assert rows(metrics.rfe_metrics(visits, as_of())) == [(1, 29, 3, 2), (2, 2, 0, 0)]
    assert rows(metrics.rfe_metrics(visits, as_of(), moved_back=10), "uid", "recency") == [(1, 19), (2, -8)]


def test_bean_scores(table):
    scored = metrics.rfe_bean_scores(table([(1, 1, 10, 6), (2, 15, 1, 1), (3, 6, 7, 4)],
                                           "uid bigint, recency int, frequency bigint, engagements bigint"))
    assert rows(scored, "uid", "score") == [(1, 18.0), (2, 3.0), (3, 3.0 + 4.0 + 4.0)]


PSM_ROWS = [
    (1, 199.49, 0.00), (3, 153.66, 4.34), (2, 589.00, 60.00), (4, 978.50, 420.50), (4, 55.99, 5.00),
    (1, 494.00, 5.00), (2, 81.80, 23.00), (1, 333.05, 42.95), (3, 949.00, 150.00), (3, 1099.00, 0.00),
]


def test_psm_rows(table):
    orders = table([(u, Decimal(str(p)), Decimal(str(c))) for u, p, c in PSM_ROWS],
                   "uid bigint, amount decimal(12,2), coupon decimal(12,2)")
    got = {r["uid"]: r["psm_score"] for r in metrics.psm_scores(orders).collect()}
    for uid in (1, 2, 3, 4):
        mine = [(p, c) for u, p, c in PSM_ROWS if u == uid]
        n, dn = len(mine), sum(1 for _, c in mine if c > 0)
        off, due = sum(c for _, c in mine), sum(p + c for p, c in mine)
        assert got[uid] == pytest.approx(dn / n + off / due + (off / dn) / (due / n))
    assert rows(metrics.psm_scores(orders, mode="parts"), "uid", "psm_score") == sorted(got.items())


def test_psm_without_discount(table):
    orders = table([(1, Decimal(10), Decimal(0)), (2, Decimal(10), None), (3, Decimal(0), Decimal(0))],
                   "uid bigint, amount decimal(12,2), coupon decimal(12,2)")
    whole = {r["uid"]: (r["tdonr"], r["psm_score"]) for r in metrics.psm_scores(orders).collect()}
    assert whole[1] == (0.0, metrics.NO_DISCOUNT_SCORE)
    assert whole[2] == (1.0, metrics.NO_DISCOUNT_SCORE)  # a missing coupon counts as discounted
    assert whole[3] == (0.0, metrics.NO_DISCOUNT_SCORE)
    parts = {r["uid"]: r["psm_score"] for r in metrics.psm_scores(orders, mode="parts").collect()}
    assert parts == {1: 0.0, 2: 0.0, 3: 0.0}
    with pytest.raises(ValueError):
        metrics.psm_scores(orders, mode="other")


def test_gender_share_is_decided_at_six_tenths(table):
    items = table([(1, 0)] * 6 + [(1, 1)] * 4 + [(2, 1)] * 3 + [(2, 0)] * 2 + [(3, 0)] * 5 + [(3, 1)] * 5, "uid bigint, label int")
    rules = table([(379, "0"), (380, "1"), (381, "-1")], "tag_id bigint, rule string")
    assert rows(tagging.gender_share_tag(items, rules)) == [(1, 379), (2, 380), (3, 381)]


def test_ties_take_the_smallest_code(table):
    orders = table([(1, "b"), (1, "a"), (2, "b"), (2, "b"), (2, "a")], "uid bigint, pay_code string")
    assert rows(tagging.favourite(orders), "uid", "pay_code", "uses") == [(1, "a", 1), (2, "b", 2)]


def test_cycle_ranges_drop_users_outside(table):
    orders = table([(1, dt.date(2019, 6, 1)), (1, dt.date(2019, 1, 1)), (2, dt.date(2019, 5, 18)), (3, dt.date(2018, 1, 1))],
                   "uid bigint, finish_time date")
    rules = table([(348, "0-7"), (349, "8-14"), (350, "x")], "tag_id bigint, rule string")
    assert rows(tagging.consume_cycle_tag(orders, rules, as_of())) == [(1, 348), (2, 349)]


def test_age_ranges_include_both_ends(table):
    users = table([(1, dt.date(1950, 1, 1)), (2, dt.date(1959, 12, 31)), (3, dt.date(1960, 1, 1))], "uid bigint, birthday date")
    rules = table([(339, "19500101-19591231")], "tag_id bigint, rule string")
    assert rows(tagging.age_range_tag(users, rules)) == [(1, 339), (2, 339)]


def test_closed_bins_never_miss(table):
    df = table([(v / 2,) for v in range(-20, 600)], "v double")
    for spec in (bins.RFM_RECENCY, bins.RFM_FREQUENCY, bins.RFE_RECENCY, bins.RFE_FREQUENCY, bins.BEAN_RECENCY):
        assert df.where(spec.score("v").isNull()).count() == 0
