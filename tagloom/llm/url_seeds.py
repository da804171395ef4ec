"""A small labelled table of URLs that the URL filter is trained from.

Hosts are invented: each topic's words are paired with others of the same topic, joined with or without a
hyphen, so that every word occurs in some rows.  Blocked topics are gambling, pills, advertising, link farms,
adult and fraud pages; allowed ones are everything else, with words that look alike and made-up words among
them.  Both kinds take the same endings and the same shapes of paths in turn, so that these decide nothing.
"""

from __future__ import annotations

BLOCKED_TOPICS = [
    "casino lucky slots jackpot spins poker win roulette bingo vegas bets freebets sport betting odds free".split(),
    "cheap meds viagra pills diet pharma rx replica watches loans payday discount".split(),
    "ads click banner track popup tracker adserver pixel affiliate clicks".split(),
    "spam links farm backlinks bulk seo mailer spammy traffic spinner".split(),
    "adult xxx porn cams hot sex escort x dating videos".split(),
    "phish verify login account bitcoin crypto profit rich quick prize winner".split(),
]
ALLOWED_TOPICS = [
    "city library archive museum river bridge council history village theatre".split(),
    "garden bread recipes kitchen farmers market cooking harvest family flowers".split(),
    "chess sports winter hiking trails railway bicycle cycling football windsurf".split(),
    "physics letters science astronomy journal maths compiler kernel atlas alphabet".split(),
    "school university college language lessons reading poetry forum music gallery".split(),
    "news daily herald weather radio station report bulletin gazette review".split(),
    "health doctor clinic service office tax law parliament institute shepherd".split(),
    "the and ing tion her ther thing nation there where ent ation other ever whether".split(),
    "reth enes stou ouren onth erat hant edin lyand shere wherin blean thesh tiont ndor".split(),
]
BLOCKED_PATHS = ["/win-free-bonus", "/casino/bonus/12", "/buy-cheap-pills.html", "/click/ads?id=7", "/free-spins/30", "/casino/free", "/cheap-pills/buy", "/ads/click", "/bonus/win"]
ALLOWED_PATHS = ["/about-us", "/articles/2019/history.html", "/docs/manual/12", "/recipes/bread", "/news/local/30", "/docs/history", "/articles/local", "/about/news", "/manual/recipes"]
FRONTS = ["", "www.", "blog.", "m."]
ENDINGS = [".example.com", ".example.net", ".example.org"]
#: Paths that any host may have.
SHAPES = ["", "/", "/en/{n}", "/fr/{n}/", "/de/{n}.html", "/es/{n}", "/index.html", "/en/{n}?page=2", "/blog/{n}", "/en/{n}#top"]


def _hosts(topics: list[list[str]]) -> list[str]:
    """Each word with the next one by a hyphen, and with the third next one written together."""
    out = []
    for words in topics:
        for i, word in enumerate(words):
            out += [f"{word}-{words[(i + 1) % len(words)]}", f"{word}{words[(i + 3) % len(words)]}"]
    return [FRONTS[i % len(FRONTS)] + host + ENDINGS[i % len(ENDINGS)] for i, host in enumerate(out)]


BLOCKED_HOSTS, ALLOWED_HOSTS = _hosts(BLOCKED_TOPICS), _hosts(ALLOWED_TOPICS)


def labelled() -> list[tuple[str, int]]:
    """``(url, blocked)``: every host under one of the shapes, and the telling paths under neutral hosts."""
    out = []
    for blocked, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS)):
        for i, host in enumerate(hosts):
            out.append((f"https://{host}{SHAPES[i % len(SHAPES)].format(n=37 * i % 1_000)}", blocked))
    for blocked, paths in ((1, BLOCKED_PATHS), (0, ALLOWED_PATHS)):
        out += [(f"http://pages{ENDINGS[i % len(ENDINGS)]}{path}", blocked) for i, path in enumerate(paths)]
    return out
