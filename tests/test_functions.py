import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tagloom.functions import bins, conditions, dates, lists, rules, text


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


# conditions


def test_condition_parts():
    c = conditions.parse_condition("modified[lt]2019-09-01")
    assert (c.field, c.op, c.value) == ("modified", "lt", "2019-09-01")
    assert conditions.parse_condition("gender[EQ]1").op == "eq"
    assert conditions.parse_condition("name[ne]").value == ""


@pytest.mark.parametrize("bad", ["gender[[eq]1", "gender=1", "gender[like]1", "[eq]1"])
def test_condition_refuses(bad):
    with pytest.raises(ValueError):
        conditions.parse_condition(bad)


def test_condition_text_and_typed(table):
    df = table([(1, 9), (2, 10), (3, None)], "id bigint, n int")

    def keep(**options):
        return rows(df.where(conditions.condition_filter("n[gt]5", **options)).select("id"))

    assert keep() == [(1,)]  # "10" sorts before "5"
    assert keep(as_text=False) == [(1,), (2,)]
    assert keep(as_text=False, missing_passes=True) == [(1,), (2,), (3,)]


def test_comma_means_and(table):
    df = table([(i,) for i in range(10)], "n int")
    kept = df.where(conditions.condition_filter("n[ge]3,n[lt]6", as_text=False))
    assert rows(kept) == [(3,), (4,), (5,)]


@pytest.mark.parametrize("unit,days", [("day", 2), ("Month", 60), ("YEAR", 730)])
def test_relative_window_ends(table, unit, days):
    as_of = dt.date(2020, 9, 1)
    offsets = sorted({0, 1, 2, days, days + 1, days + 2})
    df = table([(n, as_of - dt.timedelta(days=n)) for n in offsets], "n int, modified date")
    kept = df.where(conditions.relative_window(f"modified#{unit}#2", F.lit(as_of)))
    assert rows(kept, "n") == sorted({(n,) for n in offsets if 1 <= n <= days + 1})


def test_relative_window_refuses_unit():
    with pytest.raises(ValueError):
        conditions.relative_window("modified#week#2", F.lit(dt.date(2020, 1, 1)))


# rules


def test_rule_keeps_equals_signs_in_values(table):
    rule = "inType=mysql\nurl=jdbc:mysql://h:3306/?useUnicode=true&characterEncoding=UTF-8\n\ndbTable = t "
    parsed = rules.parse_rule(rule)
    assert parsed["url"] == "jdbc:mysql://h:3306/?useUnicode=true&characterEncoding=UTF-8"
    assert parsed["dbTable"] == "t"
    df = table([(rule,)], "rule string")
    assert one(df, rules.rule_params("rule")) == parsed


def test_range_rule(table):
    df = table([("0-7",), (" 19500101-19591231 ",), ("1",), ("-1",), ("a-b",), (None,)], "r string")
    found = [r[0] and tuple(r[0]) for r in df.select(rules.range_rule("r")).collect()]
    assert found == [(0, 7), (19500101, 19591231), None, None, None, None]


# score bins

EDGES = [
    (bins.RFM_RECENCY, [(0, 5, None), (1, 5, 5), (3, 5, 5), (4, 4, 4), (15, 2, 2), (16, 1, None), (17, 1, 1)]),
    (bins.RFM_FREQUENCY, [(0, 1, None), (49, 1, 1), (50, 2, 2), (199, 4, 4), (200, 5, 5)]),
    (bins.RFM_MONETARY, [(9999.5, 1, 1), (10000, 2, 2), (49999, 2, 2), (49999.5, 2, None), (50000, 3, 3), (200000, 5, 5)]),
    (bins.RFE_RECENCY, [(0, 5, 5), (15, 5, 5), (16, 4, 4), (60, 2, 2), (61, 1, None), (62, 1, 1)]),
    (bins.RFE_RECENCY_FROM_ONE, [(0, 5, None), (1, 5, 5), (60, 2, 2), (61, 1, 1)]),
    (bins.RFE_ENGAGEMENTS, [(48, 1, 1), (49, 1, 1), (50, 2, 2), (249, 4, 4), (250, 5, 5)]),
    (bins.RFE_ENGAGEMENTS_BELOW_49, [(48, 1, 1), (49, 1, None), (50, 2, 2)]),
    (bins.BEAN_RECENCY, [(0, 6, 6), (1, 6, 6), (2, 5, 5), (14, 2, 2), (15, 1, 1)]),
]


@pytest.mark.parametrize("spec,cases", EDGES)
def test_bin_edges(table, spec, cases):
    df = table([(i, float(v)) for i, (v, _, _) in enumerate(cases)], "i int, v double")
    got = df.orderBy("i").select(spec.score("v"), spec.score("v", strict=True)).collect()
    assert [tuple(r) for r in got] == [(c, s) for _, c, s in cases]


def test_missing_value_has_no_score(table):
    assert one(table([(None,)], "v int"), bins.RFM_RECENCY.score("v")) is None


# dates


def test_is_date(table):
    cases = {
        "2000-02-29": True, "1900-02-29": False, "2001-2-29": False, "2004-2-29": True, "20040229": True,
        "2004-13-01": False, "2004-04-31": False, "2004-4-1": True, "x": False, "": False, "0000-01-01": True,
    }
    df = table([(t,) for t in cases], "t string")
    assert dict(df.select("t", dates.is_date("t")).collect()) == cases
    assert one(table([(None,)], "t string"), dates.is_date("t")) is False


def test_zodiac_round_the_year(table):
    days = [(dt.date(2000, 1, 1) + dt.timedelta(days=n),) for n in range(366)]
    got = [r[0] for r in table(days, "d date").select("d", dates.zodiac("d").alias("s")).orderBy("d").select("s").collect()]
    changes = [i for i in range(1, 366) if got[i] != got[i - 1]]
    starts = [(days[i][0].month, days[i][0].day) for i in changes]
    assert starts == [(m, d) for m, d in zip(range(1, 13), dates.SIGN_CHANGE_DAYS)]
    assert got[0] == got[-1] == "魔羯座"


def test_day_number_round_trip(table):
    df = table([(dt.date(1900, 2, 1),), (dt.date(2019, 8, 13),)], "d date")
    assert [r[0] for r in df.select(dates.day_number("d")).collect()] == [0, (dt.date(2019, 8, 13) - dt.date(1900, 2, 1)).days]
    again = df.select("d", dates.day_from_number(dates.day_number("d")).alias("e"))
    assert again.where("d <> e").count() == 0


def test_epoch_round_trip(table):
    df = table([(1590249600,)], "s bigint")
    assert one(df, dates.epoch_to_text("s")) == "2020-05-23 16:00:00"
    assert one(df, dates.text_to_epoch(dates.epoch_to_text("s"))) == 1590249600


def test_month_and_year_length(table):
    import calendar

    days = [dt.date(1950, 1, 15) + dt.timedelta(days=97 * n) for n in range(300)]
    got = table([(d,) for d in days], "d date").select("d", dates.days_in_month("d"), dates.days_in_year("d")).collect()
    for d, month, year in got:
        assert month == calendar.monthrange(d.year, d.month)[1]
        assert year == (366 if calendar.isleap(d.year) else 365)


# text


def test_identifier_order(table):
    cases = {
        "13912345678": "phone", "15412345678": "qq", "a.b-c@x-y.example.com": "email", "1@x.com": None,
        "12345": "qq", "1234": None, "110101195001010123": "id_card", "11010119500101012X": "id_card",
        "110101500101012": "id_card", "hello": None, "12345\n": None, "a..b@x.com": None,
    }
    df = table([(t,) for t in cases], "t string")
    assert dict(df.select("t", text.identifier_type("t")).collect()) == cases


def test_long_text_does_not_explode_the_patterns(table):
    long = ["a" * 200_000, "a-" * 100_000 + "@", "a@" + "b." * 100_000, "http://" + "a." * 100_000, "a-a." * 50_000 + "a@b.cc"]
    df = table([(t,) for t in long], "t string")
    assert [r[0] for r in df.select(text.identifier_type("t")).collect()] == [None, None, None, None, "email"]
    assert df.where(text.looks_like("t", text.URL)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_equal_their_grouped_form(table, seed):
    """The look-ahead forms accept what plain repeated groups accept."""
    import random
    import re

    email = re.compile(r"([a-z0-9A-Z]+[-|.]?)+[a-z0-9A-Z]@([a-z0-9A-Z]+(-[a-z0-9A-Z]+)?\.)+[a-zA-Z]{2,}")
    url = re.compile(r"https?://([a-zA-Z0-9_-]+\.)+[a-zA-Z0-9_-]+(/[a-zA-Z0-9_ ./?%&=-]*)?")
    draw = random.Random(seed)
    texts = {"".join(draw.choice("ab1@.-|") for _ in range(draw.randint(3, 11))) for _ in range(1500)}
    texts |= {f"ab@{''.join(draw.choice('ab.-') for _ in range(7))}.cd" for _ in range(500)}
    texts |= {"http://" + "".join(draw.choice("ab./-_ ") for _ in range(draw.randint(1, 8))) for _ in range(800)}
    df = table([(t,) for t in sorted(texts)], "t string")
    got = {r[0]: (r[1], r[2]) for r in df.select("t", text.looks_like("t", text.EMAIL), text.looks_like("t", text.URL)).collect()}
    assert got == {t: (bool(email.fullmatch(t)), bool(url.fullmatch(t))) for t in texts}
    assert any(e for e, _ in got.values()) and any(u for _, u in got.values())


def test_other_shapes(table):
    df = table([("10.0.0.255",), ("256.1.1.1",), ("中文",), ("https://a.example.com/x?y=1",)], "t string")
    got = df.select(
        text.looks_like("t", text.IPV4), text.looks_like("t", text.CHINESE), text.looks_like("t", text.URL)
    ).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False), (False, False, False), (False, True, False), (False, False, True)]


def test_masking(table):
    df = table([(None,), ("12345",), ("123456",), ("13912345678",)], "t string")
    assert [r[0] for r in df.select(text.mask_value("t")).collect()] == ["", "12345", "123456", "139*****678"]
    assert one(table([("李雷",)], "t string"), text.mask_name("t")) == "李**"


def test_ip_round_trip(table):
    df = table([(0,), (3232235777,), (4294967295,)], "n bigint")
    assert [r[0] for r in df.select(text.int_to_ip("n")).collect()] == ["0.0.0.0", "192.168.1.1", "255.255.255.255"]
    assert df.where(text.ip_to_int(text.int_to_ip("n")) != F.col("n")).count() == 0


def test_row_to_line(table):
    df = table([(1, None, "x")], "a int, b string, c string")
    assert one(df, text.row_to_line(["a", "b", "c"], "|")) == "1|null|x"


# lists


def test_sibling_replacing_merge(table):
    df = table([("319,322,329,333,354",), (None,), ("348",)], "t string").select(lists.split_list("t").alias("t"))
    family = lists.tag_array(range(348, 356))
    got = [r[0] for r in df.select(lists.replace_siblings("t", family, F.lit(348))).collect()]
    assert got == [[319, 322, 329, 333, 348], [348], [348]]


def test_append_compares_whole_ids(table):
    df = table([("334,12",)], "t string").select(lists.split_list("t").alias("t"))
    assert one(df, lists.append_tag("t", F.lit(3))) == [334, 12, 3]
    assert one(df, lists.append_tag("t", F.lit(12))) == [334, 12]


def test_split_list_drops_blanks(table):
    df = table([(" 1, ,2,,",)], "t string")
    assert one(df, lists.split_list("t")) == [1, 2]


def test_dirty_dates_are_null(table):
    df = table([("1990/01/01", "bad", "2020-01-01 10:00:00")], "d string, t string, g string")
    as_of = F.lit("2020-01-03").cast("date")
    assert one(df, dates.date_digits("d")) is None
    assert one(df, dates.days_since("t", as_of)) is None and one(df, dates.days_since("g", as_of)) == 2


def test_rule_columns_agree_with_rule_texts(table):
    text = "a=1\nb = x=y \na=2\nno pair\n"
    assert one(table([(text,)], "rule string"), rules.rule_params("rule")) == rules.parse_rule(text) == {"a": "2", "b": "x=y"}
