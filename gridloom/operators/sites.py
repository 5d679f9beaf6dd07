"""Links of pages and the site lists of directories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X
from gridloom.functions.text import extract_links
from gridloom.operators import dedupe, validate


def page_links(pages: DataFrame) -> DataFrame:
    """Links of pages (html, page_url, ...): pos, url, text, in page order."""
    kept = [c for c in pages.columns if c not in ("html", "pos", "url", "text")]
    found = pages.withColumn("_link", F.explode(extract_links(F.col("html"), F.col("page_url"))))
    return found.select(*kept, "_link.pos", "_link.url", "_link.text")


def _is_web(url):
    return url.rlike(r"(?i)\Ahttps?://[^/?#]") & (E.authority(url) != "")


def likely_help_link() -> F.Column:
    """A link of the site itself (columns url, text, site) whose path, query or text speaks of help."""
    parts = F.regexp_extract("url", r"\A[^:]+://[^/?#]*([^?#]*)\??([^#]*)", 1), F.regexp_extract("url", r"\A[^:]+://[^/?#]*([^?#]*)\??([^#]*)", 2)
    where = F.lower(F.concat_ws(" ", *parts, F.coalesce("text", F.lit(""))))
    speaks = reduce(lambda a, b: a | b, [where.contains(w) for w in X.HELP_WORDS])
    return _is_web(F.col("url")) & E.domain_matches(E.canonical_netloc(F.col("url")), F.col("site")) & speaks


def help_pages(links: DataFrame, max_pages: int) -> DataFrame:
    """Pages to read of each site (links: page_id, site, page_url, pos, url, text): its home page, then its first distinct help links.

    Returns page_id, place (from 0), url. The limit is tested after a link was taken, so one that is allowed a single
    page may still give two, as long as the first link of the page is the one.
    """
    helpful = links.where(likely_help_link() & (F.col("url") != F.col("page_url")))
    first = helpful.groupBy("page_id", "url").agg(F.min("pos").alias("pos"))
    order = Window.partitionBy("page_id").orderBy("pos")
    ranked = first.withColumn("place", F.row_number().over(order))
    # Of home page and k links, the k-th link is still looked at when fewer than max_pages are taken.
    taken = ranked.where((F.col("place") < max_pages) | ((F.lit(max_pages) <= 1) & (F.col("place") == 1) & (F.col("pos") == 0)))
    home = links.select("page_id", F.lit(0).alias("place"), F.col("page_url").alias("url")).distinct()
    return home.unionByName(taken.select("page_id", "place", "url"))


def profiles(links: DataFrame, base: str) -> DataFrame:
    """Pool profiles that a listing page links to (links: page_id, pos, url, text): page_id, slug, pool_name, profile_url; the last link of a slug wins."""
    path = F.regexp_extract("url", r"\A[^:]+://[^/?#]*([^?#;]*)", 1)
    found = links.withColumn("slug", F.regexp_extract(path, r"\A/pools/([a-z0-9-]+)\z", 1)).where("slug not in ('', 'pools')")
    last = found.groupBy("page_id", "slug").agg(F.max_by("text", "pos").alias("text"))
    name = F.when(F.col("text") != "", F.col("text")).otherwise(E.pool_name_from_slug(F.col("slug")))
    return last.select("page_id", "slug", name.alias("pool_name"), F.concat(F.lit(base.rstrip("/") + "/pools/"), "slug").alias("profile_url"))


def official_site(links: DataFrame, directory: str) -> DataFrame:
    """The site that each profile page names (links: page_id, pos, url, text): page_id, website_url, website_domain.

    External web links count, not the directory's own and not social ones; the first that says ``website`` wins, else the first.
    """
    domain = E.canonical_domain(F.col("url"))
    own = (domain == directory) | F.endswith(domain, F.lit("." + directory))
    external = links.where(_is_web(F.col("url")) & ~own & ~E.is_non_site_domain(domain))
    order = F.struct((~F.lower(F.col("text")).contains("website")).alias("plain"), "pos")
    best = external.groupBy("page_id").agg(F.min_by("url", order).alias("url"))
    scheme = F.lower(F.regexp_extract("url", r"\A([^:]+)://", 1))
    website = F.concat(scheme, F.lit("://"), E.hostname(F.col("url")), F.lit("/"))
    return best.select("page_id", website.alias("website_url"), E.canonical_domain(website).alias("website_domain"))


def profile_site_records(named: DataFrame, source: dict[str, str], day: str) -> DataFrame:
    """Directory rows of profiles (pool_name, profile_url, website_url, website_domain, ord)."""
    fixed = {
        "directory_source": source["url"], "source_type": source["source_type"], "confidence": source["confidence"], "first_seen": day,
        "last_seen": day, "notes": f"Official website link extracted from {source['name']} profile.",
    }
    return named.select("ord", *[F.lit(fixed[f]).alias(f) if f in fixed else F.col(f) for f in X.SITE_FIELDS])


def listing_from_json(documents: DataFrame) -> DataFrame:
    """Listed pools of directory data files (coin_slug, ord, doc: ``{"data": [{url, pool_id}, ...]}``), one row each."""
    schema = "data array<struct<url:string,pool_id:string>>"
    rows = documents.select("coin_slug", "ord", F.posexplode(F.from_json("doc", schema)["data"]).alias("item", "_pool"))
    return rows.select("coin_slug", "ord", "item", "_pool.url", "_pool.pool_id")


def listed(listing: DataFrame) -> DataFrame:
    """Listed pools (coin_slug, url, pool_id, ...) with what they are: ``kind`` endpoint, bad_port, site or none."""
    url = E.trimmed(F.coalesce("url", F.lit("")))
    rows = listing.withColumn("url", url).where(F.col("url").rlike(r"\Ahttps?://"))
    domain, port = E.canonical_domain(F.col("url")), E.url_port(F.col("url"))
    kind = (
        F.when(E.is_ip_endpoint_url(F.col("url")), F.when(port.between(1, 65535), "endpoint").otherwise("bad_port"))
        .when((domain == "") | E.is_non_site_domain(domain), "none")
        .otherwise("site")
    )
    return rows.select("*", domain.alias("host"), port.alias("url_port"), kind.alias("kind"))


def listed_endpoints(rows: DataFrame, coin_url: str, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Bare IP endpoints among ``listed`` rows, as candidate records."""
    unknown = F.lit("UNKNOWN")
    whole = {
        "domain": F.col("host"), "port": F.col("url_port"), "scheme": F.lit("stratum+tcp"), "coin": F.upper("coin_slug"), "algorithm": unknown,
        "pool_name": F.coalesce(F.nullif(F.col("pool_id"), F.lit("")), "host"), "region": unknown, "source_type": F.lit("aggregator"),
        "source_url": F.concat(F.lit(coin_url), "coin_slug"), "confidence": F.lit("candidate"), "status": F.lit("unknown"),
        "first_seen": F.lit(day), "last_seen": F.lit(day),
        "notes": F.concat(F.lit("IP:port pool URL extracted from MiningPoolStats data file for "), "coin_slug", F.lit("; verify protocol before promotion.")),
    }
    return rows.where("kind = 'endpoint'").select(*kept, *[whole[f].alias(f) for f in X.ENDPOINT_FIELDS])


def ip_list(rows: DataFrame, coin_url: str, day: str) -> DataFrame:
    """The bare IP endpoints of ``listed`` rows (with ``ord``) that pass validation, one per key."""
    good = validate.good(validate.normalize(listed_endpoints(rows, coin_url, day, ("ord",))))
    return dedupe.unique_first(good)


def listed_sites(rows: DataFrame, source: dict[str, str], coin_url: str, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Websites among ``listed`` rows, as directory rows."""
    scheme = F.regexp_extract("url", r"\A([^:]+)://", 1)
    whole = {
        "pool_name": F.coalesce(F.nullif(F.col("pool_id"), F.lit("")), E.pool_name_from_domain(F.col("host"))),
        "website_domain": F.col("host"), "website_url": F.concat(scheme, F.lit("://"), E.hostname(F.col("url")), F.lit("/")),
        "profile_url": F.concat(F.lit(coin_url), "coin_slug"), "directory_source": F.lit(source["url"]), "source_type": F.lit(source["source_type"]),
        "confidence": F.lit(source["confidence"]), "first_seen": F.lit(day), "last_seen": F.lit(day),
        "notes": F.concat(F.lit("Pool website URL extracted from MiningPoolStats data file for "), "coin_slug", F.lit(".")),
    }
    return rows.where("kind = 'site'").select(*kept, *[whole[f].alias(f) for f in X.SITE_FIELDS])
