"""Fixed values that results depend on: field orders, enumerations, ranks, rule tables, word lists and patterns."""

from __future__ import annotations

from pyspark.sql import types as T

# Fields of published tables, in order.
ENDPOINT_FIELDS = (
    "domain", "port", "scheme", "pool_name", "coin", "algorithm", "region", "source_type", "source_url", "confidence",
    "status", "first_seen", "last_seen", "notes",
)
SITE_FIELDS = (
    "pool_name", "website_domain", "website_url", "profile_url", "directory_source", "source_type", "confidence",
    "first_seen", "last_seen", "notes",
)
NODE_FIELDS = ("node_host", "port", "node_type", "pool_name", "coin", "source_url", "first_seen", "last_seen", "notes")

# Enumerations and ranks. The four enumerations are sets; they stand in the order in which messages print them, sorted.
SCHEMES = ("stratum+ssl", "stratum+tcp")
SOURCE_TYPES = ("aggregator", "ct_log", "dns", "manual_review", "official", "open_source")
CONFIDENCE = ("candidate", "confirmed", "probable", "retired")
STATUS = ("active", "inactive", "retired", "unknown")
CONFIDENCE_RANK = {"retired": 0, "candidate": 1, "probable": 2, "confirmed": 3}
SOURCE_TYPE_RANK = {"ct_log": 0, "dns": 0, "open_source": 1, "aggregator": 2, "manual_review": 2, "official": 3}

# A coin is told by the first token of this list that is a whole part of the host.
COIN_RULES = (
    ("btc", "BTC", "SHA-256"),
    ("bitcoin", "BTC", "SHA-256"),
    ("bch", "BCH", "SHA-256"),
    ("b4c", "BCH", "SHA-256"),
    ("ltc", "LTC", "Scrypt"),
    ("doge", "DOGE", "Scrypt"),
    ("etc", "ETC", "Etchash"),
    ("ethw", "ETHW", "Ethash"),
    ("erg", "ERG", "Autolykos v2"),
    ("rvn", "RVN", "KawPoW"),
    ("raven", "RVN", "KawPoW"),
    ("kas", "KAS", "kHeavyHash"),
    ("zec", "ZEC", "Equihash"),
    ("sc", "SC", "Blake2b"),
    ("ckb", "CKB", "Eaglesong"),
    ("cfx", "CFX", "Octopus"),
    ("nexa", "NEXA", "NexaPoW"),
    ("aleo", "ALEO", "Aleo"),
    ("alph", "ALPH", "Blake3"),
    ("dash", "DASH", "X11"),
    ("xec", "XEC", "SHA-256"),
    ("hns", "HNS", "Blake2B+SHA3"),
)

# Ports of one pool that name a coin.
PORT_RULES_POOL = "ViaBTC"
PORT_RULES = {
    3014: ("XEC", "SHA-256"), 314: ("XEC", "SHA-256"), 3010: ("ETC", "Etchash"), 310: ("ETC", "Etchash"),
    3002: ("ZEC", "Equihash"), 302: ("ZEC", "Equihash"), 3004: ("DASH", "X11"), 304: ("DASH", "X11"),
    3008: ("HNS", "Blake2B+SHA3"), 308: ("HNS", "Blake2B+SHA3"), 3001: ("CKB", "Eaglesong"), 301: ("CKB", "Eaglesong"),
    315: ("KAS", "kHeavyHash"), 3015: ("KAS", "kHeavyHash"),
}
NODE_COINS = {8333: "BTC", 18333: "BTC-TESTNET", 9333: "LTC", 22556: "DOGE"}
HIGH_PORT_SSL_POOLS = ("2Miners", "RavenMiner")

# Regions, by the first row with a token in the host's labels joined by hyphens.
REGION_RULES = (
    ("Asia", ("asia", "-ap-", "apac")),
    ("Europe", ("euro", "eu-", "-eu", "europe")),
    ("USA", ("usa", "us-", "-us")),
    ("North America", ("na", "north-america")),
    ("Africa", ("africa",)),
    ("Latin America", ("latin",)),
)
REGION_ELSE = "Global"

# Word and host lists.
NON_SITE_DOMAINS = (
    "bitcointalk.org", "discord.com", "facebook.com", "github.com", "medium.com", "t.me", "telegram.me", "twitter.com",
    "x.com", "youtube.com",
)
HELP_WORDS = (
    "connect", "doc", "faq", "getting", "guide", "help", "mine", "mining", "pool", "server", "start", "stratum", "support",
)
CODE_WORDS = (
    "ccminer", "cpuminer", "ethminer", "lolminer", "miner", "mining", "mining.subscribe", "nbminer", "phoenixminer",
    "pool", "pools", "stratum", "trex", "xmrig", "xmr-stak",
)
BLOCKED_HOSTS = ("example.com", "example.net", "example.org", "localhost")
BLOCKED_PREFIXES = ("127.", "10.", "192.168.")
SLUG_NAMES = {"f2pool": "F2Pool", "viabtc": "ViaBTC", "2miners": "2Miners", "k1pool": "K1 Pool"}

# Patterns, in Java's dialect with Unicode classes and without case.
FLAGS = "(?iU)"
_HOST = r"[a-z0-9][a-z0-9.-]*[a-z0-9]"
_NAME = r"[a-z0-9][a-z0-9.-]*\.[a-z0-9-]{2,63}"
_IPV4 = r"(?:\d{1,3}\.){3}\d{1,3}"
STRATUM = rf"{FLAGS}\b(stratum\+(?:tcp|ssl)):/+(?:[^\s/@<>]+@)?({_HOST})\s*:\s*(\d{{1,5}})\b"
HOST_PORT = rf"{FLAGS}(?<![@\w.-])({_NAME})\s*:\s*(\d{{2,5}})\b"
IP_PORT = rf"{FLAGS}(?<![\w.-])({_IPV4})\s*:\s*(\d{{2,5}})\b"
NODE = rf"{FLAGS}\b(addnode|seednode)\b\s*[=:]?\s*({_IPV4})\s*:\s*(\d{{2,5}})\b"
CODE_STRATUM = rf"{FLAGS}\b(stratum\+(?:tcp|ssl)):/+(?:[^\s/@<>\"']+@)?({_HOST}|{_IPV4})\s*:\s*(\d{{1,5}})\b"
CODE_HOST_PORT = rf"{FLAGS}(?<![@\w.-])({_NAME}|{_IPV4})\s*:\s*(\d{{2,5}})\b"
FILE_STRATUM = rf"{FLAGS}\b(stratum\+(?:tcp|ssl))://(?:[^\s/@]+@)?([a-z0-9.-]+):(\d{{1,5}})\b"
DOMAIN = r"\A(?=.{1,253}\z)([a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z0-9-]{2,63}\z"
DATE = r"\A\d{4}-\d{2}-\d{2}\z"
DATA_URL = r"(?i)https://data\.miningpoolstats\.stream/data/[a-z0-9_.-]+\.js\?t=\d+"

STRINGS = lambda names: [T.StructField(n, T.StringType()) for n in names]
ENDPOINT_SCHEMA = T.StructType([T.StructField(f, T.IntegerType() if f == "port" else T.StringType()) for f in ENDPOINT_FIELDS])
SITE_SCHEMA = T.StructType(STRINGS(SITE_FIELDS))
NODE_SCHEMA = T.StructType([T.StructField(f, T.IntegerType() if f == "port" else T.StringType()) for f in NODE_FIELDS])
PAGE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()), T.StructField("body", T.BinaryType()),
])
SOURCE_SCHEMA = T.StructType([
    *STRINGS(("id",)), T.StructField("enabled", T.BooleanType()),
    *STRINGS(("name", "url", "source_type", "confidence", "pool_name", "default_coin", "default_algorithm", "default_region")),
    T.StructField("allowed_domain_suffixes", T.ArrayType(T.StringType())), *STRINGS(("method", "notes")),
])
