"""URL filter: parts and rules against plain Python, the classifier on hosts that it was not trained on."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagloom.llm import url_filter, url_seeds
from tagloom.llm.queries import QUERIES, URL_RULES
from tagloom.small import small_table

ODD = [
    None, "", "example.org/es/1", "http://", "http://ORG", "http://org/", "https://A.Org/es/", "x://example.org/es/1", "x://example.org/en/1", "x://EXAMPLE.org/en/12?q",
    "x://notexample.org/es/1", "x://a.b.example.org/es/?x=/y", "x://example.com/fr/", "x://com/de/x", "x://example.com/de", "x://h?x=://example.org/es/", "http://h#/es/",
    "x://example.org./es/", "://org/a", "a://b://org/", "x://É.ORG/É", "http://h/p\nq?r", "x://\n", "http://org" + "/a" * 20_000, "x://" + "a." * 20_000 + "org/", "x://.org/", "x:// org/ x",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda x: x[0].lower(), host), path


def brute_rule(host, path, rules):
    best = None
    for rule in rules:
        own, slash, rest = rule.partition("/")
        if (host == own or host.endswith(f".{own}")) and path.startswith(slash + rest) and (best is None or (-len(rule), rule) < (-len(best), best)):
            best = rule
    return best


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.fit(small_table(spark, url_seeds.labelled(), "url string, blocked int"))


def made_urls(seed, n):
    rng = random.Random(seed)
    host = lambda: ".".join(rng.choice(["a", "b", "example", "org", "com", "WWW", ""]) for _ in range(rng.randrange(1, 5)))
    return [f"{rng.choice(['http://', 'x', '//', 'h://'])}{host()}{rng.choice(['', '/es/', '/en/1', '/fr/x', '/de/', '/a/b', '?a', '#b'])}" for _ in range(n)]


def test_parts_and_rules(spark, model, monkeypatch):
    urls = ODD + made_urls(1, 400)
    rows = [(None if i % 40 == 7 else i // 2, url) for i, url in enumerate(urls)]  # null and repeated ids
    frame = small_table(spark, rows, "page_id long, url string")
    for name in ("host", "path", "rule", "score", "grams", "features", "probability", "row"):
        frame = frame.withColumn(name, F.lit("clash"))
    more = {**URL_RULES, "b": "block", "a/a": "allow", "b/a": "block", "a.example": "block", "example.org/": "block", "a.org/e": "allow", "": "block", "/a": "allow"}
    for rules in ({}, URL_RULES, more):
        told = []
        for bound in (500, -1):
            monkeypatch.setattr(url_filter, "RULES_IN_PLAN", bound if rules else 500)
            told.append(sorted(map(tuple, url_filter.judged(frame, rules, model).collect()), key=repr))
        assert told[0] == told[1]
        want = sorted(((i, *parts(url), brute_rule(*parts(url), rules)) for i, url in rows), key=repr)
        assert sorted((r[:4] for r in told[0]), key=repr) == want
        for _, _, _, rule, verdict, score in told[0]:
            assert 0 <= score <= 1 and verdict == (rules[rule] if rule is not None else "block" if score >= 0.5 else "allow")


def test_grams(spark):
    frame = small_table(spark, [("ab.c", "/X"), ("", ""), ("a", "")], "host string, path string")
    got = [r[0] for r in frame.select(url_filter.grams(F.col("host"), F.col("path"))).collect()]
    want = [f"h:{'^ab.c$'[i : i + n]}" for n in (3, 4, 5) for i in range(7 - n)] + ["p:/x$"]
    assert got[0] == want and got[1] == [] and got[2] == ["h:^a$"]


def test_hosts_that_were_not_seen(spark, model):
    """Other hosts than the table's: every blocked kind, and plain ones."""
    bad = ["casino-win.example.com", "www.cheap-pills.example.org", "free-bets.example.net", "ads-track.example.com", "spam-farm.example.net", "m.adult-x.example.com",
           "pills-shop.example.com", "poker-casino.example.net", "blog.spam-network.example.org", "track-ads.example.com"]
    good = ["tionble.example.com", "blog.therha.example.org", "ththwh.example.net", "garden-club.example.com", "www.city-archive.example.net", "m.tionsh.example.org", "en.example.com"]
    assert not {*bad, *good} & {*url_seeds.BLOCKED_HOSTS, *url_seeds.ALLOWED_HOSTS}
    rows = [(i, f"https://{host}{path}") for i, host in enumerate(bad + good) for path in ("/en/12", "/de/7.html?page=2", "", "/fr/990#top")]
    got = url_filter.judged(small_table(spark, rows, "page_id long, url string"), {}, model).collect()
    wrong = [(r.host, r.path, r.score) for r in got if (r.verdict == "block") != (r.page_id < len(bad))]
    assert not wrong


def test_held_out_rows_of_the_table(spark):
    known = small_table(spark, url_seeds.labelled(), "url string, blocked int")
    kept = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(4)) != 2
    model = url_filter.fit(known.where(kept))
    tested = url_filter.judged(known.where(~kept), {}, model, "blocked").collect()
    right = sum((r.verdict == "block") == bool(r.page_id) for r in tested)
    assert len(tested) > 30 and right >= 0.85 * len(tested)


def test_nothing_to_learn(spark, model):
    one = small_table(spark, [("http://a", 1), (None, 0), ("http://b", None)], "url string, blocked int")
    assert url_filter.fit(one) is None and url_filter.fit(one.limit(0)) is None
    frame = small_table(spark, [(1, "http://casino"), (2, None)], "page_id long, url string")
    assert [tuple(r)[4:] for r in url_filter.judged(frame, {}, None).collect()] == [("allow", 0.0)] * 2
    assert url_filter.judged(frame.limit(0), URL_RULES, model).count() == 0


def test_query_judges_every_page(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op13_url_filter"](spark, folder).collect()
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()
    assert sorted((r.page_id, r.host, r.path, r.rule) for r in got) == sorted((p.page_id, *parts(p.url), brute_rule(*parts(p.url), URL_RULES)) for p in pages)
