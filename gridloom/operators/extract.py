"""Extraction of endpoints and nodes from text: one row to many, all in the JVM and without a shuffle.

A page's hits are made distinct inside its row before they are exploded, so a page never meets another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X

LINE_END = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def _hits(text: Column, pattern: str) -> Column:
    """Each match as the array of its groups: all matches first, then the groups of each short match."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _group(hit: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(hit, pattern, group)


def _endpoint(host: Column, port: Column, scheme: Column) -> Column:
    """A hit as STRUCT<domain, port, scheme>; the host may end in a dot, which goes."""
    return F.struct(
        F.lower(F.regexp_replace(host, r"\.\z", "")).alias("domain"), port.cast("int").alias("port"), F.lower(scheme).alias("scheme")
    )


def _schemed(text: Column, pattern: str) -> Column:
    return F.transform(
        _hits(text, pattern), lambda h: _endpoint(_group(h, pattern, 2), _group(h, pattern, 3), _group(h, pattern, 1))
    )


def _bare(text: Column, pattern: str, pool: Column) -> Column:
    """Hits without a scheme, which is inferred."""

    def one(h: Column) -> Column:
        host, port = _group(h, pattern, 1), _group(h, pattern, 2).cast("int")
        return _endpoint(host, port, E.infer_scheme(host, port, pool))

    return F.transform(_hits(text, pattern), one)


def _exploded(rows: DataFrame, hits: Column) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("text", "domain", "port", "scheme")]
    return rows.withColumn("_hit", F.explode(F.array_distinct(hits))).select(*kept, "_hit.domain", "_hit.port", "_hit.scheme")


def priority_endpoints(pages: DataFrame) -> DataFrame:
    """Endpoints of source pages (text, pool_name, allowed_domain_suffixes, ...), under the source's suffixes if it has some."""
    hits = F.concat(_schemed(F.col("text"), X.STRATUM), _bare(F.col("text"), X.HOST_PORT, F.col("pool_name")))
    found = _exploded(pages, hits)
    return found.where(E.suffix_allowed(F.col("domain"), F.col("allowed_domain_suffixes")))


def node_hits(text: Column) -> Column:
    """ARRAY<STRUCT<node_host, port, node_type>> of a page, distinct."""
    return F.array_distinct(
        F.transform(
            _hits(text, X.NODE),
            lambda h: F.struct(
                _group(h, X.NODE, 2).alias("node_host"),
                _group(h, X.NODE, 3).cast("int").alias("port"),
                F.lower(_group(h, X.NODE, 1)).alias("node_type"),
            ),
        )
    )


def site_nodes(pages: DataFrame) -> DataFrame:
    """Blockchain peers named on pages (text, ...)."""
    kept = [c for c in pages.columns if c not in ("text", "port")]
    found = pages.withColumn("_hit", F.explode(node_hits(F.col("text"))))
    return found.select(*kept, "_hit.node_host", "_hit.port", "_hit.node_type")


def site_endpoints(pages: DataFrame) -> DataFrame:
    """Endpoints of site pages (text, site, pool_name, ...): any with a scheme, bare hosts of the site, bare IPs that are no peer there."""
    text = F.col("text")
    peers = F.transform(node_hits(text), lambda n: F.struct(n["node_host"].alias("h"), n["port"].alias("p")))
    own = F.filter(_bare(text, X.HOST_PORT, F.col("pool_name")), lambda e: E.domain_matches(e["domain"], F.col("site")))
    plain = F.transform(
        _hits(text, X.IP_PORT), lambda h: _endpoint(_group(h, X.IP_PORT, 1), _group(h, X.IP_PORT, 2), F.lit("stratum+tcp"))
    )
    plain = F.filter(plain, lambda e: ~F.array_contains(peers, F.struct(e["domain"].alias("h"), e["port"].alias("p"))))
    hits = F.filter(F.concat(_schemed(text, X.STRATUM), own, plain), lambda e: E.is_valid_endpoint(e["port"], e["scheme"]))
    return _exploded(pages, hits)


def code_endpoints(files: DataFrame) -> DataFrame:
    """Endpoints of code files (text, ...): any with a scheme, bare ones on lines that speak of mining; blocked hosts go."""
    lines = F.filter(
        F.split(F.col("text"), LINE_END),
        lambda x: ~F.lower(x).contains("stratum+") & F.exists(F.array(*map(F.lit, X.CODE_WORDS)), lambda w: F.contains(F.lower(x), w)),
    )
    bare = F.flatten(F.transform(lines, lambda x: _bare(x, X.CODE_HOST_PORT, F.lit("GitHub"))))
    hits = F.concat(_schemed(F.col("text"), X.CODE_STRATUM), bare)
    return _exploded(files, F.filter(hits, lambda e: ~E.blocked_host(e["domain"])))


def local_endpoints(files: DataFrame) -> DataFrame:
    """Endpoints of local text files (text, ...) with ``pos``, the place of the first hit among the file's distinct ones."""
    kept = [c for c in files.columns if c not in ("text", "domain", "port", "scheme", "pos")]
    found = files.select(*kept, F.posexplode(F.array_distinct(_schemed(F.col("text"), X.FILE_STRATUM))).alias("pos", "_hit"))
    return found.select(*kept, "pos", "_hit.domain", "_hit.port", "_hit.scheme")


def sitemap_coin_urls(sitemaps: DataFrame, base: str, limit: int = 0) -> DataFrame:
    """Distinct URLs of one path part under ``base`` in sitemaps (text), in order; ``limit`` 0 is all."""
    locs = sitemaps.select(F.explode(F.regexp_extract_all("text", F.lit("<loc>([^<]+)</loc>"), F.lit(1))).alias("url"))
    prefix = base.rstrip("/") + "/"
    path = F.regexp_replace(F.regexp_extract("url", r"\A[^:]+://[^/?#]*([^?#]*)", 1), r"\A/+|/+\z", "")
    found = locs.where(F.col("url").startswith(prefix) & (path != "") & ~path.contains("/")).distinct()
    return found.orderBy("url").limit(limit) if limit else found


def coin_data_url(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, X.DATA_URL, 0), F.lit(""))


def api_endpoints(pools: DataFrame) -> DataFrame:
    """One placeholder endpoint per coin of an aggregator's pools (name, website, coins: MAP<coin, STRUCT<algorithm>>)."""
    rows = pools.select("name", "website", F.explode("coins").alias("coin", "_about"))
    return rows.select(
        E.canonical_domain(F.col("website")).alias("domain"),
        F.lit(443).alias("port"),
        F.lit("stratum+tcp").alias("scheme"),
        F.col("name").alias("pool_name"),
        F.upper("coin").alias("coin"),
        F.coalesce(F.col("_about.algorithm"), F.lit("UNKNOWN")).alias("algorithm"),
    )
