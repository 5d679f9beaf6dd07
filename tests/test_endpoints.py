"""Endpoint functions, extraction and validation on the fixture cases."""

import pytest
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X
from gridloom.functions import text as TX
from gridloom.operators import extract, records, sites, validate

DAY = "2025-02-03"
BASE = {
    "domain": "stratum+tcp://Mine.Quartz.test:4021/jobs#top", "port": "", "scheme": "", "pool_name": "Quartz", "coin": "QZ",
    "algorithm": "QuartzHash", "region": "Global", "source_type": "official", "source_url": "https://quartz.test/how-to", "confidence": "confirmed",
    "status": "active", "first_seen": DAY, "last_seen": DAY, "notes": "Seen on the start page.",
}
SCHEMA = ", ".join(f"{f} string" for f in X.ENDPOINT_FIELDS)


def frame(spark, *rows):
    return spark.createDataFrame([tuple((BASE | r)[f] for f in X.ENDPOINT_FIELDS) for r in rows], SCHEMA)


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def test_parse_endpoint(spark):
    def parse(value, port):
        df = spark.createDataFrame([(value, port)], "v string, p string")
        return tuple(E.parse_endpoints(df, "x", F.col("v"), F.col("p"), F.lit("stratum+tcp")).first()["x"])

    assert parse("stratum+ssl://Worker.1@EU.Pool-One.test:1443/jobs?x=1", "") == ("eu.pool-one.test", 1443, "stratum+ssl", None)
    assert parse("\u3000[2001:db8::1]. ", "33")[1] == 33 and parse("[2001:db8::7]", "1")[0] == "2001:db8::7"
    assert parse("a.example.", " +7 ")[:2] == ("a.example", 7) and parse("u@h.test:70000", None)[1] == 70000
    assert parse(":443", "")[0] == ":443" and parse("a b:1", "5")[:2] == ("a", 5)
    assert parse("", "")[3] and parse(None, None)[3] and parse("a.example", "abc")[3] == "invalid literal for int() with base 10: 'abc'"


def test_ip_literals(spark):
    import ipaddress
    import random

    rng, bits = random.Random(1), ["1", "ab", "::", ":", "1234", "12345", "192.0.2.1", "%eth0", "%", "/", "g", "0", ".", "01.2.3.4"]
    hosts = {"".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(4000)}
    hosts |= {":".join("1" * a) + "::" + ":".join("2" * b) + end for a in range(9) for b in range(9) for end in ("", ":192.0.2.4")}

    def literal(host):
        try:
            return bool(ipaddress.ip_address(host))
        except ValueError:
            return False

    rows = spark.createDataFrame([(h,) for h in sorted(hosts)], "h string").select("h", E.is_ip_literal(F.col("h")).alias("x")).collect()
    assert [(r["h"], r["x"]) for r in rows if r["x"] != literal(r["h"])] == [] and sum(r["x"] for r in rows) > 50


def test_validation(spark):
    def errors(**change):
        return validate.normalize(frame(spark, change)).first()["errors"]

    row = validate.good(validate.normalize(frame(spark, {}))).first()
    assert (row["domain"], row["port"], row["scheme"]) == ("mine.quartz.test", 4021, "stratum+tcp")
    assert validate.normalize(frame(spark, {"domain": "stratum+tcp://198.51.100.9:4021"})).first()["errors"] == []
    assert errors(source_type="aggregator") == ["confirmed records must use source_type=official"]
    assert errors(confidence="probable", source_type="aggregator") == ["probable records must include at least two source URLs separated by semicolons"]
    assert errors(confidence="probable", source_url="https://north.test/a;https://south.test/b") == []
    assert errors(domain=" ") == ["endpoint/domain must be a non-empty string"]
    assert errors(domain=None) == ["endpoint/domain must be a non-empty string"]
    assert "port must be an integer from 1 to 65535: 99999" in errors(domain="a.example", port="99999", scheme="stratum+tcp")
    assert errors(domain="[2001:db8::5]", port="1", scheme="stratum+tcp") == []
    assert "last_seen must use YYYY-MM-DD" in errors(last_seen="soon")
    with pytest.raises(ValueError, match="Duplicate record"):
        validate.require_unique(validate.good(validate.normalize(frame(spark, {}, {"coin": "qz"}))))
    both = validate.good(validate.normalize(frame(spark, {}, {"domain": "b.test:1", "scheme": "stratum+tcp", "confidence": "candidate", "status": "unknown", "source_type": "open_source"})))
    assert validate.watchlist(both).count() == 1
    again = validate.normalize(validate.good(validate.normalize(frame(spark, {}))))
    assert again.select(*X.ENDPOINT_FIELDS).first() == row and again.first()["errors"] == []


def test_hosts(spark):
    assert one(spark, E.canonical_domain(F.col("u")), u="http://me@WWW.Ore-Field.test:81?x") == "ore-field.test"
    assert one(spark, E.canonical_netloc(F.col("u")), u="http://www.Ore-Field.test:81/a?x") == "ore-field.test:81"
    assert one(spark, E.is_ip_endpoint_url(F.col("u")), u="http://203.0.113.5:4021/") is True
    assert one(spark, E.is_ip_endpoint_url(F.col("u")), u="http://ore-field.test:4021") is False
    for host, blocked in (("127.8.0.3", True), ("10.20.0.1", True), ("example.org", True), ("LOCALHOST", True), ("109.1.2.3", False), ("quartz.test", False)):
        assert one(spark, E.blocked_host(F.col("h")), h=host) is blocked
    coin = lambda d, p, pool: tuple(one(spark, E.infer_coin_algorithm(F.col("d"), F.col("p"), F.col("pool")), d=d, p=p, pool=pool))
    assert coin("eu.btc.quartz.test", 4021, None) == ("BTC", "SHA-256")
    assert coin("any.quartz.test", 3010, "ViaBTC") == ("ETC", "Etchash")
    assert coin("plain.example", 1, None) == ("UNKNOWN", "UNKNOWN")
    assert one(spark, E.normalize_region(F.col("d")), d="nano.example") == "North America"
    assert one(spark, E.pool_name_from_slug(F.col("s")), s="my-2nd-pool") == "My 2Nd Pool"
    assert one(spark, E.is_ip_literal(F.col("h")), h="01.2.3.4") is False and one(spark, E.is_ip_literal(F.col("h")), h="::1") is True


def test_text(spark):
    html = "<style>p{}</style><p>Ore<i>field</i>&nbsp;&nbsp;north</p><SCRIPT src='s'>if(a<b)</SCRIPT>&amp;"
    assert one(spark, TX.html_to_text_unescaped(F.col("h")), h=html) == "Ore field north &"
    assert one(spark, TX.html_to_text(F.col("h")), h=html) == "Ore field north &amp;"
    decode = TX.decode_body(F.col("b"), F.col("t"))
    assert one(spark, decode, b="é".encode("gbk", "ignore") + "中".encode("gbk"), t="text/html; charset=gbk").endswith("中")
    assert one(spark, decode, b=b"a\xff", t="text/html") == "a�"
    assert one(spark, decode, b="é".encode("latin1"), t="x; charset=nonsense") == "�"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_priority_extraction(spark):
    text = "plain stratum+tcp://w@rvn.quartz.test:6100 / secure eu-rvn.quartz.test : 16100 / not quartz.test.other:6100"
    page = spark.createDataFrame([(1, text, "2Miners", ["quartz.test"])], "page_id int, text string, pool_name string, allowed_domain_suffixes array<string>")
    got = rows(extract.priority_endpoints(page), "domain", "port", "scheme")
    assert got == [("eu-rvn.quartz.test", 16100, "stratum+ssl"), ("rvn.quartz.test", 6100, "stratum+tcp")]


def site(spark, text):
    return spark.createDataFrame([(1, text, "ore-field.test", "P", "https://ore-field.test/", None)], "page_id int, text string, site string, pool_name string, page_url string, site_coin string")


def test_site_extraction(spark):
    got = rows(extract.site_endpoints(site(spark, "eu.ore-field.test:4021; 203.0.113.5:4022; stratum+ssl://far.test:4023; far.test:4024")), "domain", "port", "scheme")
    assert got == [("203.0.113.5", 4022, "stratum+tcp"), ("eu.ore-field.test", 4021, "stratum+tcp"), ("far.test", 4023, "stratum+ssl")]
    bad = "ore-field.test:00 203.0.113.5:99999 stratum+ssl://far.test:0 ore-field.test:65535"
    assert rows(extract.site_endpoints(site(spark, bad)), "domain", "port") == [("ore-field.test", 65535)]
    nodes = site(spark, "seednode:203.0.113.7:9333 then ADDNODE 203.0.113.6:8333; 203.0.113.8:4025")
    found = records.node_records(extract.site_nodes(nodes), DAY)
    assert rows(found, "node_host", "port", "node_type", "coin") == [("203.0.113.6", 8333, "addnode", "BTC"), ("203.0.113.7", 9333, "seednode", "LTC")]
    assert rows(extract.site_endpoints(nodes), "domain", "port") == [("203.0.113.8", 4025)]
    wide = "ore-field.test : 44 and éore-field.test : 45"
    assert rows(extract.site_endpoints(site(spark, wide)), "port") == [(44,)]


def test_code_extraction(spark):
    code = lambda t: rows(extract.code_endpoints(spark.createDataFrame([(1, t)], "doc_id int, text string")), "domain", "port", "scheme")
    assert code('run --url=stratum+ssl://a:b@zec.quartz.test:4021') == [("zec.quartz.test", 4021, "stratum+ssl")]
    assert code("listen ore-field.test:8080\r\nlolminer zec-ssl.quartz.test:4022") == [("zec-ssl.quartz.test", 4022, "stratum+ssl")]
    found = spark.createDataFrame([("btc.quartz.test", 4021, "stratum+tcp", "ore/field", "run.sh", "u")], "domain string, port int, scheme string, repo string, path string, file_url string")
    row = records.code_records(found, "q", DAY).first()
    assert (row["source_type"], row["confidence"]) == ("open_source", "candidate") and "repo=ore/field" in row["notes"]


def links(spark, html, base, **more):
    page = spark.createDataFrame([(1, html, base, more.get("site", ""))], "page_id int, html string, page_url string, site string")
    return sites.page_links(page)


def test_links(spark):
    html = '<a href="/about?how=connect">About us</a><a href="https://far.test/faq">Elsewhere</a><a>no</a><a href="x&amp;y">a <b>b</b>\n c</a><a href="/open">'
    found = links(spark, html, "https://ore-field.test/", site="ore-field.test")
    assert rows(found, "pos", "url", "text")[2] == (2, "https://ore-field.test/x&y", "a b c") and found.count() == 3
    assert rows(sites.help_pages(found, 4), "place", "url") == [(0, "https://ore-field.test/"), (1, "https://ore-field.test/about?how=connect")]
    assert rows(sites.help_pages(found, 1), "place") == [(0,), (1,)]
    listed = sites.profiles(links(spark, '<a href="/pools/quartz-one/">no</a><a href="/pools/quartz-one">Quartz</a><a href="/pools/pools">all</a>', "https://list.test"), "https://list.test/")
    assert rows(listed, "slug", "pool_name", "profile_url") == [("quartz-one", "Quartz", "https://list.test/pools/quartz-one")]
    profile = '<a href="https://t.me/q">Chat</a><a href="http://first.test/a">News</a><a href="http://www.quartz.test:81/z?q">Website of Quartz</a>'
    assert rows(sites.official_site(links(spark, profile, "https://list.test/p"), "list.test"), "website_url", "website_domain") == [("http://www.quartz.test/", "quartz.test")]


def test_directories(spark):
    base = "https://pools.example"
    xml = "".join(f"<loc>{u}</loc>" for u in (base, base + "/zcoin", base + "/acoin", base + "/c/d", "https://far.test/x"))
    got = extract.sitemap_coin_urls(spark.createDataFrame([(xml,)], "text string"), base).orderBy("url").collect()
    assert [r["url"] for r in got] == [base + "/acoin", base + "/zcoin"]
    url = "https://data.miningpoolstats.stream/data/q_z.coin.js?t=9"
    assert one(spark, extract.coin_data_url(F.col("h")), h=f'<link rel="preload" href="{url}" as="fetch">') == url
    doc = '{"data": [{"url": "http://192.0.2.1:70000"}, {"url": "http://192.0.2.1:3333", "pool_id": "p"}, {"url": "ftp://x"}, {"url": "https://www.a.example/x"}, {"url": "https://t.me/x"}]}'
    kinds = sites.listed(sites.listing_from_json(spark.createDataFrame([("btc", 1, doc)], "coin_slug string, ord int, doc string")))
    assert rows(kinds, "item", "kind") == [(0, "bad_port"), (1, "endpoint"), (3, "site"), (4, "none")]
