"""One golden test per rule table, with values written down here: a wrong table would pass on both sides of a comparison with SQL that reads it too."""

from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X


def test_sizes_and_orders():
    assert len(X.ENDPOINT_FIELDS) == 14 and X.ENDPOINT_FIELDS[:3] == ("domain", "port", "scheme") and X.ENDPOINT_FIELDS[-3:] == ("first_seen", "last_seen", "notes")
    assert len(X.SITE_FIELDS) == 10 and len(X.NODE_FIELDS) == 9
    assert [len(t) for t in (X.SCHEMES, X.SOURCE_TYPES, X.CONFIDENCE, X.STATUS)] == [2, 6, 4, 4]
    assert sorted(X.CONFIDENCE, key=X.CONFIDENCE_RANK.get) == ["retired", "candidate", "probable", "confirmed"]
    assert {r: sorted(k for k, v in X.SOURCE_TYPE_RANK.items() if v == r) for r in range(4)} == {
        0: ["ct_log", "dns"], 1: ["open_source"], 2: ["aggregator", "manual_review"], 3: ["official"],
    }
    assert (len(X.COIN_RULES), len(X.PORT_RULES), len(X.REGION_RULES)) == (22, 14, 6)
    assert (len(X.NON_SITE_DOMAINS), len(X.HELP_WORDS), len(X.CODE_WORDS), len(X.BLOCKED_HOSTS)) == (10, 13, 15, 4)


def test_what_the_tables_say(spark):
    hosts = {
        "btc-eu.a.example": ("BTC", "SHA-256", "Europe"), "etc-ssl.b.example": ("ETC", "Etchash", "Global"), "asia-rvn.x": ("RVN", "KawPoW", "Asia"),
        "us-kas.example": ("KAS", "kHeavyHash", "USA"), "nano.example": ("UNKNOWN", "UNKNOWN", "North America"), "dash.africa.x": ("DASH", "X11", "Africa"),
        "latin.hns.x": ("HNS", "Blake2B+SHA3", "Latin America"), "b4c.bch.x": ("BCH", "SHA-256", "Global"),
    }
    rows = spark.createDataFrame([(h,) for h in hosts], "domain string")
    none = F.lit(None).cast("string")
    told = rows.withColumn("c", E.infer_coin_algorithm(F.col("domain"), F.lit(1), F.lit("Pool"), none, none)).withColumn("r", E.normalize_region(F.col("domain")))
    got = {r["domain"]: (r["c"]["coin"], r["c"]["algorithm"], r["r"]) for r in told.collect()}
    assert got == hosts
    ports = {3014: "XEC", 310: "ETC", 3002: "ZEC", 304: "DASH", 3008: "HNS", 301: "CKB", 315: "KAS"}
    assert {p: X.PORT_RULES[p][0] for p in ports} == ports and X.PORT_RULES_POOL == "ViaBTC"
    assert X.NODE_COINS == {8333: "BTC", 18333: "BTC-TESTNET", 9333: "LTC", 22556: "DOGE"}
    assert X.SLUG_NAMES["viabtc"] == "ViaBTC" and X.HIGH_PORT_SSL_POOLS == ("2Miners", "RavenMiner")
