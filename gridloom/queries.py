"""Registered queries: each applies operators to whole tables derived from the given ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X
from gridloom.functions import text as TX
from gridloom.operators import dedupe, extract, metrics, promote, records, sites, validate
from gridloom.sources import files
from gridloom.sources.derived import derive

DAY, AS_OF = "2024-03-01", "2024-02-10"
COIN_URL, DIRECTORY = "https://pools.example/", {"url": "https://pools.example/", "name": "Pools", "source_type": "directory", "confidence": "candidate"}
SUFFIXES = ("net", "other.example")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = derive(spark, sf_dir, "raw_endpoint")
    return validate.normalize(raw.withColumns({"given_domain": F.col("domain"), "given_port": F.col("port")}))


def _shown(errors: str = "errors") -> F.Column:
    return F.array_join(errors, "\n").alias("errors")


@query
def parse_endpoint(spark, sf_dir):
    rows = derive(spark, sf_dir, "raw_endpoint")
    parsed = E.parse_endpoints(rows, "p", F.col("domain"), F.col("port"), F.col("scheme"))
    return parsed.select("ord", "p.domain", F.col("p.port").cast("string").alias("port"), "p.scheme", "p.error")


@query
def normalize_record(spark, sf_dir):
    return validate.good(_normalized(spark, sf_dir)).select("ord", *X.ENDPOINT_FIELDS)


@query
def validation_errors(spark, sf_dir):
    return _normalized(spark, sf_dir).select("ord", F.size("errors").cast("long").alias("n_errors"), _shown())


@query
def quarantine_reasons(spark, sf_dir):
    bad = validate.quarantine(_normalized(spark, sf_dir))
    return bad.select("ord", validate.error_message(F.col("ord"), F.col("given_domain"), F.col("given_port"), F.col("errors")).alias("reason"))


@query
def duplicate_keys(spark, sf_dir):
    return validate.duplicate_keys(validate.good(_normalized(spark, sf_dir)))


@query
def library(spark, sf_dir):
    return validate.library(dedupe.unique_first(validate.good(_normalized(spark, sf_dir)), "exact"))


@query
def watchlist(spark, sf_dir):
    return validate.watchlist(dedupe.unique_first(validate.good(_normalized(spark, sf_dir)), "exact")).select(*X.ENDPOINT_FIELDS)


@query
def source_urls(spark, sf_dir):
    rows = derive(spark, sf_dir, "raw_endpoint").withColumn("twice", F.concat("source_url", F.lit(" ;; "), "source_url"))
    return rows.select(
        "ord", E.count_source_urls(F.col("twice")).cast("long").alias("n_urls"), E.join_source_urls(E.split_source_urls(F.col("twice"))).alias("urls")
    )


@query
def ip_literals(spark, sf_dir):
    p = E.parse_endpoints(derive(spark, sf_dir, "raw_endpoint"), "p", F.col("domain"), F.col("port"), F.col("scheme"))
    rows = p.select("ord", F.coalesce("p.domain", F.lit("")).alias("host"))
    return rows.select("ord", "host", E.is_ip_literal(F.col("host")).alias("strict"), E.is_ip_address(F.col("host")).alias("loose"))


# Pages.


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pool = F.element_at(F.array(F.lit("2Miners"), F.lit("ViaBTC"), F.lit("Pool")), (F.col("page_id") % 3 + 1).cast("int"))
    return derive(spark, sf_dir, "page").withColumn("pool_name", pool)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).withColumn("text", TX.html_to_text(F.col("html"))).drop("html")


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.page_links(_pages(spark, sf_dir).drop("pool_name"))


@query
def html_to_text(spark, sf_dir):
    return _texts(spark, sf_dir).select("page_id", "text")


@query
def html_to_text_unescaped(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", TX.html_to_text_unescaped(F.col("html")).alias("text"))


@query
def decode_body(spark, sf_dir):
    rows = _pages(spark, sf_dir).withColumn("latin", F.col("page_id") % 2 == 0)
    given = F.translate("html", "".join(map(chr, range(256, 383))) + "–—‘’“”…€", "")
    rows = rows.select("page_id", "latin", F.when(F.col("latin"), F.encode(given, "ISO-8859-1")).otherwise(F.encode(given, "UTF-8")).alias("body"))
    kind = F.when(F.col("latin"), "text/html; charset=ISO-8859-1").otherwise("text/html")
    return rows.select("page_id", F.sha2(TX.decode_body(F.col("body"), kind), 256).alias("text_sha256"))


#: Charsets of bodies, and bytes in them; the last charset takes the whole page.
BODIES = (
    ("gbk", "C4E3BAC3"), ("windows-1252", "93808594"), ("utf-8", "61FF62C3"), ("no-such-charset", "E4BDA0"), ("ISO-8859-1", "E9A3"), ("utf-16le", ""),
)


@query
def decode_charsets(spark, sf_dir):
    kind = (F.col("page_id") % len(BODIES)).cast("int")
    form = F.element_at(F.array(*[F.struct(F.lit(c).alias("charset"), F.lit(b).alias("bytes")) for c, b in BODIES]), kind + 1)
    rows = _pages(spark, sf_dir).select("page_id", "html", kind.alias("kind"), form.alias("form"))
    short = F.concat(F.unhex("form.bytes"), F.encode(F.col("page_id").cast("string"), "UTF-8"))
    body = F.when(F.col("kind") == len(BODIES) - 1, F.encode("html", "UTF-16LE")).otherwise(short)
    text = TX.decode_body(body, F.concat(F.lit("text/html; Charset="), "form.charset"))
    return rows.select("page_id", F.col("form.charset").alias("charset"), F.sha2(text, 256).alias("text_sha256"))


@query
def extract_priority_endpoints(spark, sf_dir):
    rows = _texts(spark, sf_dir).withColumn("allowed_domain_suffixes", F.array(*map(F.lit, SUFFIXES)))
    return extract.priority_endpoints(rows).select("page_id", "domain", "port", "scheme")


@query
def priority_records(spark, sf_dir):
    rows = _texts(spark, sf_dir).withColumn("allowed_domain_suffixes", F.array(*map(F.lit, SUFFIXES)))
    found = extract.priority_endpoints(rows).withColumn("source_id", F.concat(F.lit("s"), (F.col("page_id") % 3).cast("string")))
    registry = spark.createDataFrame(
        [("s0", "Zero", "https://s0.example/", "official", "confirmed", "ViaBTC", None, None, None, "table", "Checked."),
         ("s1", "One", "https://s1.example/", "aggregator", "candidate", None, "XMR", "RandomX", "Global", "api", None),
         ("s2", "Two", "https://s2.example/", "official", "probable", "2Miners", None, None, "", "help", "")],
        "id string, name string, url string, source_type string, confidence string, pool_name string, default_coin string, "
        "default_algorithm string, default_region string, method string, notes string",
    )
    return records.source_records(found, registry, DAY, ("page_id",))


@query
def extract_site_endpoints(spark, sf_dir):
    return extract.site_endpoints(_texts(spark, sf_dir)).select("page_id", "domain", "port", "scheme")


@query
def site_records(spark, sf_dir):
    return records.site_records(extract.site_endpoints(_texts(spark, sf_dir)), DAY, ("page_id",))


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.site_nodes(_texts(spark, sf_dir)).withColumn("site_coin", F.when(F.col("page_id") % 2 == 0, "KAS"))
    rows = records.node_records(found, DAY, ("page_id",))
    return rows.withColumn("last_seen", F.concat(F.lit("2024-03-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")))


@query
def extract_nodes(spark, sf_dir):
    return _nodes(spark, sf_dir)


@query
def unique_nodes(spark, sf_dir):
    return dedupe.unique_nodes(_nodes(spark, sf_dir).withColumn("ord", F.col("page_id")))


@query
def page_links(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "pos", "url", "text")


@query
def help_pages_topk(spark, sf_dir):
    return sites.help_pages(_links(spark, sf_dir), 4)


@query
def profiles(spark, sf_dir):
    return sites.profiles(_links(spark, sf_dir), "https://stats.example")


@query
def official_site(spark, sf_dir):
    return sites.official_site(_links(spark, sf_dir).withColumn("url", F.regexp_replace("url", r"\.example\.(com|net|org)/", ".stats.example/")), "stats.example")


@query
def fetch_report(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    found = extract.site_endpoints(_texts(spark, sf_dir))
    fetched = pages.select("page_id", F.col("page_url").alias("url"), (F.col("page_id") % 7 != 0).alias("ok"), F.encode("html", "UTF-8").alias("body"))
    return metrics.fetch_report(fetched, found, "page_id")


@query
def profile_sites(spark, sf_dir):
    links = _links(spark, sf_dir)
    named = sites.profiles(links, "https://stats.example").join(sites.official_site(links, "stats.example"), "page_id")
    return sites.profile_site_records(named.withColumn("ord", F.col("page_id")), DIRECTORY, DAY)


@query
def fetch_outcomes(spark, sf_dir):
    pages = _pages(spark, sf_dir).withColumn("ok", F.col("page_id") % 7 != 0)
    pages = pages.withColumns({"html": F.when(F.col("ok"), F.col("html")), "status": F.when(F.col("ok"), 200).otherwise(503), "used_cache": ~F.col("ok")})
    found = extract.site_endpoints(pages.withColumn("text", TX.html_to_text(F.coalesce("html", F.lit("")))).drop("html"))
    error = F.when(F.col("ok"), "").otherwise(F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    fetched = pages.select("page_id", F.col("page_url").alias("url"), "ok", "status", "used_cache", error.alias("error"), F.encode("html", "UTF-8").alias("body"))
    return metrics.fetch_report(fetched, found, "page_id")


# Code and local files.


def _code(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = derive(spark, sf_dir, "code_file")
    packed = files.withColumns({"content": F.base64(F.encode("text", "UTF-8")), "encoding": F.lit("base64")})
    return packed.withColumn("text", TX.decode_code_file(F.col("content"), F.col("encoding"))).drop("content", "encoding")


@query
def extract_code_endpoints(spark, sf_dir):
    return extract.code_endpoints(_code(spark, sf_dir)).select("doc_id", "domain", "port", "scheme")


@query
def code_records(spark, sf_dir):
    found = extract.code_endpoints(_code(spark, sf_dir)).withColumn("file_url", F.concat(F.lit("https://code.example/"), "repo", F.lit("/"), "path"))
    return records.code_records(found, "q1", DAY, ("doc_id",))


@query
def extract_local_text(spark, sf_dir):
    found = extract.local_endpoints(derive(spark, sf_dir, "code_file"))
    return records.local_records(found, DAY, ("doc_id", "pos"))


# Rules on hosts and URLs.


@query
def infer_coin(spark, sf_dir):
    rows = derive(spark, sf_dir, "record").withColumn("pool_name", F.when(F.col("ord") % 3 == 0, "ViaBTC").otherwise("Pool"))
    rows = rows.withColumn("port", F.when(F.col("ord") % 2 == 0, F.lit(3010)).otherwise(F.col("port")))
    return rows.select("ord", E.infer_coin_algorithm(F.col("domain"), F.col("port"), F.col("pool_name"), F.lit("XMR"), F.lit("RandomX")).alias("c")).select("ord", "c.*")


@query
def infer_region(spark, sf_dir):
    return derive(spark, sf_dir, "record").select("ord", E.normalize_region(F.col("domain")).alias("region"))


@query
def infer_scheme(spark, sf_dir):
    pool = F.when(F.col("ord") % 2 == 0, "2Miners").otherwise(F.col("pool_name"))
    port = (F.col("port") + F.when(F.col("ord") % 3 == 0, 9000).otherwise(0)).cast("int")
    return derive(spark, sf_dir, "record").select("ord", port.alias("port"), E.infer_scheme(F.col("domain"), port, pool).alias("scheme"))


@query
def canonical_domain(spark, sf_dir):
    rows = derive(spark, sf_dir, "listing")
    url = F.regexp_replace("url", "^https://www", "https://user@WWW")
    return rows.select(
        "item", url.alias("url"), E.canonical_domain(url).alias("domain"), E.canonical_netloc(url).alias("netloc"),
        E.is_non_site_domain(E.canonical_domain(url)).alias("non_site"), E.is_ip_endpoint_url(url).alias("ip_endpoint"),
    )


@query
def pool_names(spark, sf_dir):
    n = F.col("s_suppkey").cast("string")
    kinds = (
        F.lit("f2pool"), F.lit("K1Pool"), F.concat(F.lit("my-new-pool"), n), F.lower(F.regexp_replace("s_name", "#", "-")), F.concat(F.lit("a"), n, F.lit("b"), n, F.lit("c-x")),
        F.concat(F.lit("--POOL.of-"), n, F.lit("th_miners")), F.lit(""), F.lit("2miners"),
    )
    slug = F.element_at(F.array(*kinds), (F.col("s_suppkey") % len(kinds) + 1).cast("int"))
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", slug.alias("slug"), E.pool_name_from_slug(slug).alias("pool_name"))


@query
def blocked_hosts(spark, sf_dir):
    """Hosts of records, and addresses and reserved names made of their ids."""
    n = F.col("ord").cast("string")
    tail = F.concat((F.col("ord") % 250).cast("string"), F.lit("."), (F.col("ord") % 7).cast("string"))
    heads = ("127.0.", "10.1.", "192.168.", "192.169.", "101.2.", "11.0.")
    kinds = [F.concat(F.lit(h), tail) for h in heads] + [F.lit(h) for h in ("Example.com", "example.NET", "example.org", "localhost")]
    kinds += [F.col("domain"), F.upper("domain"), F.concat(F.lit("a."), F.lit("example.com")), F.concat(F.lit("localhost"), n)]
    host = F.element_at(F.array(*kinds), (F.col("ord") % len(kinds) + 1).cast("int"))
    return derive(spark, sf_dir, "record").select(F.col("ord").alias("event_id"), host.alias("host"), E.blocked_host(host).alias("blocked"))


@query
def suffix_matches(spark, sf_dir):
    """Hosts of records against a table of suffixes, some of which are whole hosts."""
    rows = derive(spark, sf_dir, "record")
    suffixes = rows.where(F.col("port") == 2111).select(F.col("domain").alias("suffix")).union(
        rows.select(F.concat(F.lit(".Pool"), (F.col("ord") % 40).cast("string"), F.lit(".example.com.")))
    )
    return E.matching_suffixes(rows.select("ord", "domain"), F.col("domain"), suffixes)


@query
def sitemap_coins(spark, sf_dir):
    loc = lambda url: F.concat(F.lit("<loc>"), *url, F.lit("</loc>"))
    rows = derive(spark, sf_dir, "listing").select(
        F.concat(
            loc([F.lit(COIN_URL), "coin_slug"]), loc([F.lit(COIN_URL)]), loc([F.lit(COIN_URL + "a/"), F.col("item").cast("string")]),
            loc([F.lit("https://foreign.example/"), "coin_slug"]),
        ).alias("text")
    )
    return extract.sitemap_coin_urls(rows, COIN_URL, 12)


@query
def coin_data_url(spark, sf_dir):
    rows = derive(spark, sf_dir, "listing")
    html = F.concat(F.lit('<link rel="preload" href="https://Data.miningpoolstats.stream/data/'), "coin_slug", F.lit(".js?t="), F.col("item").cast("string"), F.lit('" as="fetch">'))
    html = F.when(F.col("item") % 5 == 0, F.lit("<p>none</p>")).otherwise(html)
    return rows.select("item", extract.coin_data_url(html).alias("data_url"))


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "listing")
    doc = F.to_json(F.struct(F.array(F.struct("url", "pool_id")).alias("data")))
    return sites.listed(sites.listing_from_json(rows.select("coin_slug", F.col("item").alias("ord"), doc.alias("doc"))))


@query
def directory_split(spark, sf_dir):
    return _listed(spark, sf_dir).select("ord", "coin_slug", "kind", "host", F.col("url_port").cast("string").alias("port"))


@query
def directory_endpoints(spark, sf_dir):
    return sites.listed_endpoints(_listed(spark, sf_dir), COIN_URL, DAY, ("ord",))


@query
def directory_ip_list(spark, sf_dir):
    return sites.ip_list(_listed(spark, sf_dir), COIN_URL, DAY).select(*X.ENDPOINT_FIELDS)


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.listed_sites(_listed(spark, sf_dir), DIRECTORY, COIN_URL, DAY, ("ord",))


@query
def directory_sites(spark, sf_dir):
    return _sites(spark, sf_dir)


@query
def unique_sites(spark, sf_dir):
    return dedupe.unique_sites(_sites(spark, sf_dir)).select(*X.SITE_FIELDS)


@query
def merge_existing(spark, sf_dir):
    rows = _sites(spark, sf_dir)
    old = rows.where(F.col("ord") % 3 == 0).withColumn("first_seen", F.lit("2024-01-01"))
    return dedupe.merge_existing(old, rows.where(F.col("ord") % 3 != 0)).select(*X.SITE_FIELDS)


@query
def api_coin_explode(spark, sf_dir):
    about = lambda a: F.struct(F.lit(a).cast("string").alias("algorithm"))
    rows = derive(spark, sf_dir, "listing").select(
        F.coalesce("pool_id", F.lit("pool")).alias("name"), F.col("url").alias("website"),
        F.create_map(F.lit("btc"), about("SHA-256"), F.concat(F.lit("kas"), (F.col("item") % 3).cast("string")), about(None)).alias("coins"),
    )
    return extract.api_endpoints(rows)


# Deduplication and promotion.


@query
def unique_ranked(spark, sf_dir):
    return dedupe.unique_ranked(derive(spark, sf_dir, "record")).select(*X.ENDPOINT_FIELDS)


@query
def unique_ranked_exact(spark, sf_dir):
    return dedupe.unique_ranked(derive(spark, sf_dir, "record"), "exact").select(*X.ENDPOINT_FIELDS)


@query
def unique_first(spark, sf_dir):
    return dedupe.unique_first(derive(spark, sf_dir, "record")).select(*X.ENDPOINT_FIELDS)


@query
def unique_wide(spark, sf_dir):
    """As unique_first, with an address of its own for every record, of which some hold others."""
    rows = derive(spark, sf_dir, "record")
    number = (F.col("ord") * 7919) % 99991
    url = F.concat(F.lit("https://src"), (F.col("ord") % 5).cast("string"), F.lit(".example/p"), number.cast("string"), F.when(F.col("ord") % 2 == 0, "/more").otherwise(""))
    return dedupe.unique_first(rows.withColumn("source_url", url)).select(*X.ENDPOINT_FIELDS)


LABELS = (("priority_sources", "trusted"), ("official_site_crawl", "trusted"), ("code_search", "candidate"))


def _prepared_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "raw_endpoint")
    return promote.prepare(promote.tagged([(label, kind, rows.where(F.col("ord") % 3 == i)) for i, (label, kind) in enumerate(LABELS)]))


@query
def prepare_records(spark, sf_dir):
    return _prepared_raw(spark, sf_dir).select("src_label", "ord", *X.ENDPOINT_FIELDS, _shown()).withColumn("port", F.col("port").cast("string"))


def _source() -> F.Column:
    """Which input of a promotion has a record: 0 the seeds, else a source. Endpoints of one port are known to the seeds alone, those of another to sources alone."""
    return F.when(F.col("port") == 3222, 0).when(F.col("port") == 2111, 1 + F.col("ord") % 3).otherwise(F.col("ord") % 4)


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = derive(spark, sf_dir, "record").where(_source() == 0)
    return validate.good(validate.normalize(dedupe.unique_ranked(seeds)))


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive(spark, sf_dir, "record")
    parts = [(label, kind, dedupe.unique_first(rows.where(_source() == i + 1))) for i, (label, kind) in enumerate(LABELS)]
    return promote.prepare(promote.tagged(parts))


def _promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promote.promote(_seeds(spark, sf_dir), validate.good(_prepared(spark, sf_dir)))


@query
def promoted_library(spark, sf_dir):
    return _promoted(spark, sf_dir).select(*X.ENDPOINT_FIELDS, "change", _shown())


@query
def promotion_changes(spark, sf_dir):
    return _promoted(spark, sf_dir).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query
def promotion_report(spark, sf_dir):
    return promote.promotion_report(_promoted(spark, sf_dir))


@query
def promotion_inputs(spark, sf_dir):
    return promote.promotion_inputs(_seeds(spark, sf_dir), _prepared_raw(spark, sf_dir))


@query
def skip_examples(spark, sf_dir):
    rows = derive(spark, sf_dir, "raw_endpoint")
    return promote.skip_examples(promote.prepare(promote.tagged([("priority_sources", "trusted", rows)])))


# Snapshots, reports, upkeep.


def _current(spark: SparkSession, sf_dir: str) -> tuple:
    rows = derive(spark, sf_dir, "record")
    return _sites(spark, sf_dir), [rows], rows.where("port = 2111"), _nodes(spark, sf_dir), rows.where("confidence = 'confirmed'"), validate.watchlist(rows)


def _snapshot(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    rows = derive(spark, sf_dir, "record").where(F.col("last_seen") <= until)
    ips = validate.good(_normalized(spark, sf_dir)).where((F.col("last_seen") <= until) & F.col("domain").rlike(r"^[0-9.]+$"))
    return metrics.snapshot(
        _sites(spark, sf_dir).where(F.lit(until > AS_OF) | (F.col("ord") % 2 == 0)),
        [rows, ips], ips, _nodes(spark, sf_dir).where(F.col("last_seen") <= F.lit(until)), rows.where("confidence = 'confirmed'"),
        validate.watchlist(rows),
    )


@query
def snapshot_keys(spark, sf_dir):
    return _snapshot(spark, sf_dir, "2024-12-31")


@query
def snapshot_delta(spark, sf_dir):
    """The tables as they are at the end of the year, against what of them was there on a day of January."""
    early, until = "2024-01-15", "2024-12-31"
    old = (F.col("last_seen") <= early).alias("before")
    rows = derive(spark, sf_dir, "record").where(F.col("last_seen") <= until).select("*", old)
    ips = validate.good(_normalized(spark, sf_dir)).where((F.col("last_seen") <= until) & F.col("domain").rlike(r"^[0-9.]+$")).select("*", old)
    places = _sites(spark, sf_dir).select("*", (F.col("ord") % 2 == 0).alias("before"))
    nodes = _nodes(spark, sf_dir).where(F.col("last_seen") <= until).select("*", old)
    return metrics.snapshot_change(places, [rows, ips], ips, nodes, rows.where("confidence = 'confirmed'"), validate.watchlist(rows), "before")


@query
def stored_snapshot_delta(spark, sf_dir):
    """As snapshot_delta, of two snapshots that are stored in buckets; the catalog keeps no trace of them."""
    folder, names = files.shared_folder(spark), []
    for until in ("2024-12-31", "2024-01-15"):
        names.append(f"snapshot_{until.replace('-', '_')}_{uuid.uuid4().hex}")
        metrics.store_snapshot(_snapshot(spark, sf_dir, until), names[-1], f"{folder}/{names[-1]}", 16)
    delta = metrics.stored_delta(spark, *names)
    for name in names:
        spark.sql(f"DROP TABLE {name}")
    return delta


@query
def baseline_delta(spark, sf_dir):
    """A first run: nothing is stored, so the current snapshot is its own baseline."""
    now = metrics.snapshot(*_current(spark, sf_dir))
    folder = files.shared_folder(spark)
    now.write.parquet(f"{folder}/snapshot")
    stored = spark.read.parquet(f"{folder}/snapshot")
    return metrics.count_delta(stored, metrics.choose_baseline(stored.where(F.col("key") == ""), stored))


@query
def report_summary(spark, sf_dir):
    rows = derive(spark, sf_dir, "fetch")
    sources = rows.where(F.col("ord") % 2 == 0).select("source_id", "ok", (F.col("ord") % 4 == 0).alias("used_cache"))
    pages = rows.where(F.col("ord") % 2 == 1).select(F.col("source_id").alias("url"), F.when(F.col("ord") % 5 != 0, F.col("ok")).alias("ok"))
    return metrics.report_summary(sources, pages)


@query
def cache_fallback(spark, sf_dir):
    return metrics.cache_fallback(derive(spark, sf_dir, "fetch"), 40)


@query
def last_good_records(spark, sf_dir):
    fetches = derive(spark, sf_dir, "fetch")
    records = derive(spark, sf_dir, "record").join(fetches.where("ok").select("ord", "run", "source_id"), "ord")
    return metrics.last_good_records(fetches, records, 40).select("source_id", "run", "used_cache", "ord", "domain", "port", "scheme", "coin")


@query
def run_record(spark, sf_dir):
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")  # noqa: E731  the events' times have no zone
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    run = metrics.run_status(events.agg(F.max("event_id").alias("run_id"), iso(F.min("ts")).alias("started"), iso(F.max("ts")).alias("ended")))
    return metrics.run_record(run, {"day": DAY, "max_pages": "4"}, snapshot_delta(spark, sf_dir), report_summary(spark, sf_dir))


@query
def run_status(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    iso = lambda c, end: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(end))
    ended = F.col("ts") + F.make_interval(secs=(F.col("event_id") % 5000 - 60).cast("decimal(18,6)"))
    return metrics.run_status(rows.select(F.col("event_id").alias("run_id"), iso("ts", "Z").alias("started"), iso(ended, "+00:00").alias("ended")))


@query
def retire_stale(spark, sf_dir):
    return promote.retire_stale(derive(spark, sf_dir, "record"), AS_OF).select("ord", "last_seen", "confidence", "status")


@query
def change_audit(spark, sf_dir):
    """Endpoints of one port are known to the earlier library alone, those of another to the later one alone."""
    rows = derive(spark, sf_dir, "record")
    before = dedupe.unique_first(rows.where("port <> 2111"))
    return promote.change_audit(before, dedupe.unique_ranked(rows.where("port <> 3222")))


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "record").withColumn("cycle", F.datediff(F.to_date("last_seen"), F.lit("2024-01-01").cast("date")))


@query
def confirmation_runs(spark, sf_dir):
    return promote.confirmation_runs(_sightings(spark, sf_dir))


@query
def retire_unconfirmed(spark, sf_dir):
    library = dedupe.unique_ranked(derive(spark, sf_dir, "record"))
    kept = promote.retire_unconfirmed(library, _sightings(spark, sf_dir), 29)
    return kept.select("domain", "port", "scheme", F.upper("coin").alias("coin_key"), "missed", "confidence", "status")


# Files.


@query
def published_records(spark, sf_dir):
    """A library published as a version, and its JSON array read back."""
    folder = files.shared_folder(spark)
    files.publish(spark, folder, {"library": (validate.library(dedupe.unique_first(derive(spark, sf_dir, "record"))), X.ENDPOINT_FIELDS)})
    return files.read_records(spark, files.published_path(spark, folder, "library", "json"))


@query
def published_tables(spark, sf_dir):
    """Sites and nodes published in one version; their JSON arrays read back, as (table, key, url)."""
    folder = files.shared_folder(spark)
    tables = {"sites": (unique_sites(spark, sf_dir), X.SITE_FIELDS), "nodes": (dedupe.unique_nodes(_nodes(spark, sf_dir).withColumn("ord", F.col("page_id"))), X.NODE_FIELDS)}
    files.publish(spark, folder, tables)
    text = lambda fields: T.StructType([T.StructField(f, T.StringType()) for f in fields])
    read = lambda name, fields: files.read_records(spark, files.published_path(spark, folder, name, "json"), text(fields))
    node = F.concat_ws("|", "node_host", "port", "node_type")
    return read("sites", X.SITE_FIELDS).select(F.lit("sites").alias("name"), F.col("website_domain").alias("key"), F.col("profile_url").alias("url")).union(
        read("nodes", X.NODE_FIELDS).select(F.lit("nodes"), node, "source_url")
    )


@query
def registry_sources(spark, sf_dir):
    """Suppliers as a registry file of sources, required and optional, with and without a word on being enabled."""
    n = F.col("s_suppkey")
    source = F.struct(
        F.concat(F.lit("source-"), n.cast("string")).alias("id"), F.when(n % 3 == 0, F.lit(False)).when(n % 3 == 1, F.lit(True)).alias("enabled"),
        F.col("s_name").alias("name"), F.concat(F.lit("https://s"), n.cast("string"), F.lit(".example/")).alias("url"),
        F.when(n % 4 > 0, F.array(F.concat(F.lit("s"), n.cast("string"), F.lit(".example")))).alias("allowed_domain_suffixes"),
    )
    folder = files.shared_folder(spark)
    listed = lambda optional: F.collect_list(F.when((n % 5 == 0) == F.lit(optional), source))
    rows = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    rows.agg(listed(False).alias("sources"), listed(True).alias("optional_sources")).write.json(f"{folder}/registry.json")
    found = files.read_registry(spark, f"{folder}/registry.json", include_optional=True)
    return found.select("id", "name", "url", F.array_join("allowed_domain_suffixes", ",").alias("suffixes"))


@query
def cached_pages(spark, sf_dir):
    """Pages in the cache's JSON form, whose bodies are Latin-1 text, read back as bytes."""
    folder = files.shared_folder(spark)
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet")
    body = F.decode(F.encode(F.coalesce("html", F.lit("")), "UTF-8"), "ISO-8859-1").alias("body")
    rows.select(F.col("page_id").cast("string").alias("url"), F.lit(200).alias("status"), F.lit("text/html").alias("content_type"), body).write.json(f"{folder}/cache.json")
    return files.read_pages(spark, f"{folder}/cache.json").select(F.col("url").cast("long").alias("page_id"), "status", F.sha2("body", 256).alias("sha256"))


@query
def local_texts(spark, sf_dir):
    """One text file per nation, in the nested layout, read whole."""
    folder = files.shared_folder(spark)
    lines = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_nationkey", "s_suppkey", F.concat(F.lit("stratum+tcp://s"), F.col("s_suppkey").cast("string"), F.lit(".example:3333")).alias("value"))
    whole = lines.groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "value"))), lambda x: x["value"]), "\n").alias("value"))
    whole.repartition("s_nationkey").write.partitionBy("s_nationkey").text(f"{folder}/data/texts")
    found = files.read_local_texts(spark, files.artifact_path(spark, folder, "texts") + "/*")
    return found.select(F.regexp_extract("path", "s_nationkey=([0-9]+)/", 1).cast("int").alias("s_nationkey"), F.sha2("text", 256).alias("sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
