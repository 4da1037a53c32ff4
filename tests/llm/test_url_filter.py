import re

from tidemark.llm import registry, url_filter

from .helpers import by_id

URLS = [
    "http://Example.com/en/7/x?q=1", "https://www.example.com/en/8#f", "ftp://a.net/de/x", "http://example.net/de/8a", "http://example.net/de/9", "x://b.org/es/", "http://notexample.com/en/7",
    "http://spam.test/page.html", "https://www.spam.test/page/", "http://SPAM.test/page?x", "http://spam.test/Page", "no scheme", "", None, "://", "http://net/de/", "http://a.com/EN/", "http://h\nost/a\nb?c", "a://b://c/d",
]
LISTED = ["http://spam.test/page", None, "", "junk", "http://net/de/"]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host) :]).group()


def plain(url):
    host, path = split(url)
    canon = lambda h, p: re.sub(r"^www\.", "", h) + re.sub(r"(\.html|/)+\Z", "", p)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, *max(fits)[1:]
    listed = {canon(*split(u)) for u in LISTED} - {""}
    return host, path, None, "block" if canon(host, path) in listed else "allow"


def test_verdicts_match_a_plain_version(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, URLS[0]])] + [(None, URLS[0], "x")], "page_id long, url string, canon string")
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    found = by_id(url_filter.judge(pages, listed).collect(), "page_id", "host", "path", "rule", "verdict")
    assert found == sorted(((r.page_id, *plain(r.url)) for r in pages.collect()), key=repr)


def test_filter_lets_all_listed_through_and_few_others(spark):
    listed = spark.range(5000).selectExpr("concat('a.b/', id) AS canon")
    others = spark.range(5000).selectExpr("concat('c.d/', id) AS canon")
    blocks = 5000 * 16 // 256
    table = url_filter.bloom_blocks(listed, blocks)
    assert url_filter.possible(listed, table, blocks, blocks).count() == 5000
    assert url_filter.possible(others, table, blocks, blocks).count() < 100
    assert url_filter.listed_among(others.unionByName(listed.limit(10)), listed).count() == 10


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(none, none.select("url")).count() == 0
    assert url_filter.judge(spark.createDataFrame([(1, "http://a/b")], "page_id long, url string"), none.select("url")).first().verdict == "allow"


def test_the_list_is_made_of_spam_hosts_only(spark):
    urls = ["http://CASINO-WIN.com/q", "https://a.free-bets.org", "http://clean.org/a?u=http://casino-win.x/", "http://clean.org/casino-win.x/", "casino-win.com/x", None, "http://not-casino-win.com/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert sorted(r.url for r in registry.spam_pages(pages).collect()) == sorted(urls[:2])
    verdicts = {r.page_id: r.verdict for r in url_filter.judge(pages, registry.spam_pages(pages)).collect()}
    assert verdicts[0] == verdicts[1] == "block" and verdicts[2] == verdicts[3] == "allow"
