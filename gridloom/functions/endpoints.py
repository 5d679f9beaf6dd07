"""Column functions over endpoints, hosts and URLs. All stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import fixed as X


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, however often later expressions and filters read it.

    A plain projection would be copied into each of them, which makes nested rules grow without bound; what a generator
    returns is a value.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


#: White space in the Unicode sense, as characters and as a part of a character class.
WHITE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Scheme, user (dropped), then host and port up to a path, query, fragment or space: one search cuts all of them out.
CUT = rf"(?s)\A(?:([A-Za-z][A-Za-z0-9+.-]*)://)?(?:[^@{_WHITE}/]++@)?([^/#?{_WHITE}]*+).*\z"


def trimmed(c: Column) -> Column:
    """Without white space at both ends, in the Unicode sense."""
    return F.btrim(c, F.lit(WHITE))


def parse_endpoints(df: DataFrame, name: str, value: Column, port: Column, scheme: Column) -> DataFrame:
    """``df`` with STRUCT<domain, port, scheme, error> of an endpoint string; its own port and scheme override the fallbacks.

    ``error`` is set where the value is blank or the fallback port that is needed is not an integer. Each step is a column of
    its own that the next one reads, so a row is searched once.
    """
    c, kept = F.col, df.columns
    parts = df.select("*", trimmed(F.coalesce(value, F.lit(""))).alias("_raw"), F.coalesce(port.cast("string"), F.lit("")).alias("_given"), scheme.alias("_fallback"))
    parts = parts.withColumn("_cut", F.split(F.regexp_replace("_raw", CUT, "$1\u0001$2"), "\u0001"))
    parts = parts.withColumns({"_scheme": F.lower(c("_cut")[0]), "_host": c("_cut")[1]})
    last = F.regexp_extract("_host", r"\A.+:([0-9]{1,5})\z", 1)
    parts = parts.withColumn("_port", F.when(c("_host").contains(":"), last).otherwise(""))
    cut_off = lambda text, n: F.left(text, F.length(text) - n)
    parts = parts.withColumn("_host", F.when(c("_port") != "", cut_off(c("_host"), F.length("_port") + 1)).otherwise(c("_host")))
    for edge, cut in (("[", F.substr(c("_host"), F.lit(2))), ("]", cut_off(c("_host"), 1)), (".", cut_off(c("_host"), 1))):
        found = c("_host").startswith(edge) if edge == "[" else c("_host").endswith(edge)
        parts = parts.withColumn("_host", F.when(found, cut).otherwise(c("_host")))
    number = F.when(c("_port") != "", c("_port").cast("int")).otherwise(trimmed(c("_given")).try_cast("int"))
    parts = parts.withColumn("_number", number)
    error = F.when(c("_raw") == "", "endpoint/domain must be a non-empty string").when(
        (c("_port") == "") & (c("_given") != "") & c("_number").isNull(),
        F.concat(F.lit("invalid literal for int() with base 10: '"), c("_given"), F.lit("'")),
    )
    known = c("_raw") != ""
    whole = F.struct(
        F.when(known, F.lower("_host")).alias("domain"),
        F.when(known, c("_number")).alias("port"),
        F.when(known, F.when(c("_scheme") != "", c("_scheme")).otherwise(c("_fallback"))).alias("scheme"),
        error.alias("error"),
    )
    return once(parts.select(*[k for k in kept if k != name], whole.alias("_whole")), name, F.col("_whole")).drop("_whole")


def source_urls(c: Column) -> Column:
    """The non-blank parts of a ``;``-joined string, trimmed, repeats kept."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ";"), trimmed)
    return F.filter(parts, lambda x: x != "")


def count_source_urls(c: Column) -> Column:
    return F.size(source_urls(c))


def split_source_urls(c: Column) -> Column:
    """As ``source_urls``, each once, in order of first appearance."""
    return F.array_distinct(source_urls(c))


def join_source_urls(c: Column) -> Column:
    return F.array_join(c, "; ")


V4 = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}"


def _v6() -> str:
    """A pattern of IPv6 addresses: eight groups, the last two perhaps as IPv4, or fewer with one ``::``; then perhaps a zone."""
    group = "[0-9a-fA-F]{1,4}"
    tail = f"(?:{group}:{group}|{V4})"
    forms = [f"(?:{group}:){{6}}{tail}"]
    for after in range(5, -1, -1):  # groups between :: and the last two
        before = f"(?:(?:{group}:){{0,{4 - after}}}{group})?" if after < 5 else ""
        forms.append(f"{before}::(?:{group}:){{{after}}}{tail}")
    forms += [f"(?:(?:{group}:){{0,5}}{group})?::{group}", f"(?:(?:{group}:){{0,6}}{group})?::"]
    return rf"\A(?:{'|'.join(forms)})(?:%[^%/]+)?\z"


V6 = _v6()


def is_ip_literal(c: Column) -> Column:
    """Strict IPv4 (no leading zeros) or IPv6."""
    return c.rlike(rf"\A{V4}\z") | (c.contains(":") & c.rlike(V6))


def is_ip_address(c: Column) -> Column:
    """The loose test: four dotted numbers, or any colon."""
    return c.rlike(r"\A\d{1,3}(?:\.\d{1,3}){3}\z") | c.contains(":")


def authority(url: Column) -> Column:
    """What lies between ``//`` and the path of a URL, ``https://`` taken as given where there is no scheme."""
    whole = F.when(url.contains("://"), url).otherwise(F.concat(F.lit("https://"), url))
    return F.regexp_extract(whole, r"\A[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def hostname(url: Column) -> Column:
    """Lower-case host of a URL without user, port and brackets."""
    host = F.regexp_replace(authority(url), r"\A.*@", "")
    bare = F.regexp_extract(host, r"\A\[([^\]]*)\]", 1)
    return F.lower(F.when(bare != "", bare).otherwise(F.regexp_replace(host, r":[0-9]*\z", "")))


def _without_www(host: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(host, r"\A\.+|\.+\z", ""), r"\Awww\.", "")


def canonical_domain(url: Column) -> Column:
    """Host of a URL as a directory lists it: no port, no user, no ``www.``."""
    return _without_www(hostname(url))


def canonical_netloc(url: Column) -> Column:
    """As ``canonical_domain``, but port and user stay."""
    return _without_www(F.lower(authority(url)))


def url_port(url: Column) -> Column:
    return F.regexp_extract(authority(url), r":([0-9]{1,9})\z", 1).try_cast("int")


def domain_matches(domain: Column, suffix: Column) -> Column:
    bare = lambda c: F.regexp_replace(F.lower(c), r"\A\.+|\.+\z", "")
    return (bare(domain) == bare(suffix)) | F.endswith(bare(domain), F.concat(F.lit("."), bare(suffix)))


def suffix_allowed(domain: Column, suffixes: Column) -> Column:
    """Any suffix holds; no list or an empty one allows all."""
    bare = F.regexp_replace(F.lower(domain), r"\A\.+|\.+\z", "")
    held = F.exists(suffixes, lambda s: (bare == s) | F.endswith(bare, F.concat(F.lit("."), s)))
    return F.coalesce(F.size(suffixes), F.lit(0)).isin(0, -1) | F.coalesce(held, F.lit(False))


def suffixes_of(domain: Column) -> Column:
    """A domain and all that is left of it when labels are taken off its front; as many as it has labels."""
    labels = F.split(F.regexp_replace(F.lower(domain), r"\A\.+|\.+\z", ""), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def matching_suffixes(rows: DataFrame, domain: Column, suffixes: DataFrame) -> DataFrame:
    """``rows`` with the ``suffix`` of the table ``suffixes`` (one column of that name, any number of rows) that their domain equals or ends in, at a label.

    A row per match: a domain looks up its own few suffixes, so the list may be as long as it likes, and no row meets all of it.
    """
    table = suffixes.select(F.regexp_replace(F.lower("suffix"), r"\A\.+|\.+\z", "").alias("suffix")).where("suffix <> ''").distinct()
    return rows.select("*", F.explode(suffixes_of(domain)).alias("suffix")).join(table, "suffix").select(*rows.columns, "suffix")


def is_non_site_domain(domain: Column) -> Column:
    listed = F.array(*map(F.lit, X.NON_SITE_DOMAINS))
    return is_ip_address(domain) | F.exists(listed, lambda b: (domain == b) | F.endswith(domain, F.concat(F.lit("."), b)))


def is_ip_endpoint_url(url: Column) -> Column:
    return (hostname(url) != "") & is_ip_address(hostname(url)) & (F.coalesce(url_port(url), F.lit(0)) > 0)


def pool_name_from_slug(slug: Column) -> Column:
    """A listed name, or the slug in words, each with a capital after anything that is no letter."""
    words = F.regexp_extract_all(F.lower(F.translate(slug, "-", " ")), F.lit("([a-z]+|[^a-z]+)"), F.lit(1))
    titled = F.array_join(F.transform(words, F.initcap), "")
    named = F.create_map(*[F.lit(x) for pair in X.SLUG_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(named, slug), titled)


def pool_name_from_domain(domain: Column) -> Column:
    return pool_name_from_slug(F.split(domain, r"\.")[0])


def normalize_region(domain: Column) -> Column:
    text = F.translate(F.lower(domain), ".", "-")
    held = lambda tokens: reduce(lambda a, b: a | b, [text.contains(t) for t in tokens])
    rules = iter(X.REGION_RULES)
    region, tokens = next(rules)
    found = F.when(held(tokens), region)
    for region, tokens in rules:
        found = found.when(held(tokens), region)
    return found.otherwise(X.REGION_ELSE)


def infer_coin_algorithm(domain: Column, port: Column, pool: Column, coin: Column | None = None, algorithm: Column | None = None) -> Column:
    """STRUCT<coin, algorithm>: a listed port of one pool, else the first rule that a part of the host meets, else the defaults."""
    pair = lambda c, a: F.struct(F.lit(c).alias("coin"), F.lit(a).alias("algorithm"))
    ports = F.create_map(*[x for p, (c, a) in X.PORT_RULES.items() for x in (F.lit(p), pair(c, a))])
    rules = F.array(*[F.struct(F.lit(t).alias("token"), F.lit(c).alias("coin"), F.lit(a).alias("algorithm")) for t, c, a in X.COIN_RULES])
    parts = F.split(F.replace(F.lower(domain), F.lit("ssl"), F.lit("")), "[-.]")
    rule = F.try_element_at(F.filter(rules, lambda r: F.array_contains(parts, r["token"])), F.lit(1))
    default = F.struct(
        F.coalesce(coin if coin is not None else F.lit(None).cast("string"), F.lit("UNKNOWN")).alias("coin"),
        F.coalesce(algorithm if algorithm is not None else F.lit(None).cast("string"), F.lit("UNKNOWN")).alias("algorithm"),
    )
    by_port = F.when(F.coalesce(pool, F.lit("")) == X.PORT_RULES_POOL, F.try_element_at(ports, port))
    by_rule = F.when(rule.isNotNull(), F.struct(rule["coin"].alias("coin"), rule["algorithm"].alias("algorithm")))
    return F.coalesce(by_port, by_rule, default)


def infer_scheme(domain: Column, port: Column, pool: Column) -> Column:
    high = F.coalesce(pool, F.lit("")).isin(*X.HIGH_PORT_SSL_POOLS) & (port >= 10_000)
    return F.when(F.lower(domain).contains("ssl") | high, "stratum+ssl").otherwise("stratum+tcp")


def infer_node_coin(port: Column, site_coin: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in X.NODE_COINS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, port), F.nullif(site_coin, F.lit("")), F.lit("UNKNOWN"))


def blocked_host(host: Column) -> Column:
    low = F.lower(host)
    return reduce(lambda a, b: a | b, [low.startswith(p) for p in X.BLOCKED_PREFIXES]) | low.isin(*X.BLOCKED_HOSTS)


def is_valid_endpoint(port: Column, scheme: Column) -> Column:
    return F.coalesce(port.between(1, 65535) & F.lower(scheme).isin(*X.SCHEMES), F.lit(False))


def record_key() -> list[Column]:
    """The four columns that make a record the same endpoint."""
    return [F.col("domain"), F.col("port"), F.col("scheme"), F.upper("coin").alias("coin_key")]


def endpoint_snapshot_key() -> Column:
    part = lambda c: F.lower(trimmed(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    port = F.when(F.col("port").cast("string") == "0", "").otherwise(trimmed(F.coalesce(F.col("port").cast("string"), F.lit(""))))
    coin = F.when(F.coalesce(F.col("coin"), F.lit("")) == "", "unknown").otherwise(part("coin"))
    whole = F.concat_ws("|", part("domain"), port, part("scheme"), coin)
    return F.when((part("domain") != "") & (port != "") & (part("scheme") != ""), whole)


def node_snapshot_key() -> Column:
    part = lambda c: F.lower(trimmed(F.coalesce(F.col(c).cast("string"), F.lit(""))))
    port = F.when(F.col("port").cast("string") == "0", "").otherwise(part("port"))
    kind = F.when(part("node_type") == "", "node").otherwise(part("node_type"))
    return F.when((part("node_host") != "") & (port != ""), F.concat_ws("|", part("node_host"), port, kind))


def domain_snapshot_key(column: str) -> Column:
    return F.nullif(F.lower(trimmed(F.coalesce(F.col(column), F.lit("")))), F.lit(""))
