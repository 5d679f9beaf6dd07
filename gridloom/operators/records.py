"""Endpoint records from extracted endpoints: projections, with the small registry of sources joined where one is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X


def _record(found: DataFrame, kept: tuple[str, ...], day: str, **fields: Column) -> DataFrame:
    whole = {f: F.col(f) for f in ("domain", "port", "scheme")} | fields | {"first_seen": F.lit(day), "last_seen": F.lit(day)}
    return found.select(*kept, *[whole[f].alias(f) for f in X.ENDPOINT_FIELDS])


def source_records(found: DataFrame, sources: DataFrame, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Records of priority sources: ``found`` (source_id, domain, port, scheme) with its source, which is one row of a registry."""
    s = sources.select(F.col("id").alias("source_id"), F.struct(*[c for c in sources.columns]).alias("_s"))
    rows = found.join(F.broadcast(s), "source_id")  # a registry is a hand-kept list, read whole by every job
    coin = E.infer_coin_algorithm(F.col("domain"), F.col("port"), F.col("_s.pool_name"), F.col("_s.default_coin"), F.col("_s.default_algorithm"))
    notes = F.concat(F.lit("Discovered by "), F.col("_s.id"), F.lit(" using "), F.col("_s.method"), F.lit(". "), F.coalesce("_s.notes", F.lit("")))
    return _record(
        rows.withColumn("_c", coin), kept, day,
        pool_name=F.coalesce("_s.pool_name", "_s.name"), coin=F.col("_c.coin"), algorithm=F.col("_c.algorithm"),
        region=F.coalesce(F.nullif("_s.default_region", F.lit("")), E.normalize_region(F.col("domain"))),
        source_type=F.col("_s.source_type"), source_url=F.col("_s.url"), confidence=F.col("_s.confidence"),
        status=F.when(F.col("_s.confidence").isin("confirmed", "probable"), "active").otherwise("unknown"), notes=F.trim(notes),
    )


def site_records(found: DataFrame, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Records of a site's own pages: ``found`` (site, pool_name, page_url, domain, port, scheme)."""
    coin = E.infer_coin_algorithm(F.col("domain"), F.col("port"), F.col("pool_name"))
    return _record(
        found.withColumn("_c", coin), kept, day,
        pool_name=F.col("pool_name"), coin=F.col("_c.coin"), algorithm=F.col("_c.algorithm"), region=E.normalize_region(F.col("domain")),
        source_type=F.lit("official"), source_url=F.col("page_url"), confidence=F.lit("confirmed"), status=F.lit("active"),
        notes=F.concat(F.lit("Discovered by shallow crawling official website domain "), F.col("site"), F.lit(".")),
    )


def node_records(found: DataFrame, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Peers named on a site's pages: ``found`` (site, pool_name, page_url, site_coin, node_host, port, node_type)."""
    notes = F.concat(
        F.lit("Blockchain peer node candidate extracted from "), F.col("node_type"), F.lit(" directive while crawling "), F.col("site"),
        F.lit("; not a mining pool Stratum endpoint."),
    )
    whole = {
        "coin": E.infer_node_coin(F.col("port"), F.col("site_coin")), "source_url": F.col("page_url"), "first_seen": F.lit(day),
        "last_seen": F.lit(day), "notes": notes,
    }
    return found.select(*kept, *[whole.get(f, F.col(f)).alias(f) for f in X.NODE_FIELDS])


def code_records(found: DataFrame, query_id: str, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Records of code files: ``found`` (file_url, repo, path, domain, port, scheme); candidates to be reviewed."""
    coin = E.infer_coin_algorithm(F.col("domain"), F.col("port"), F.lit("GitHub"))
    unknown = F.lit("UNKNOWN")
    notes = F.concat(
        F.lit(f"Extracted from public GitHub code search query {query_id}; repo="), F.coalesce("repo", unknown), F.lit("; path="),
        F.coalesce("path", unknown), F.lit("; review before promotion."),
    )
    return _record(
        found.withColumn("_c", coin), kept, day,
        pool_name=unknown, coin=F.col("_c.coin"), algorithm=F.col("_c.algorithm"), region=E.normalize_region(F.col("domain")),
        source_type=F.lit("open_source"), source_url=F.col("file_url"), confidence=F.lit("candidate"), status=F.lit("unknown"), notes=notes,
    )


def local_records(found: DataFrame, day: str, kept: tuple[str, ...] = ()) -> DataFrame:
    """Records of local text files: ``found`` (path, domain, port, scheme); nothing but the endpoint is known."""
    unknown = F.lit("UNKNOWN")
    return _record(
        found, kept, day,
        pool_name=unknown, coin=unknown, algorithm=unknown, region=unknown, source_type=F.lit("open_source"),
        source_url=F.concat(F.lit("file:"), F.col("path")), confidence=F.lit("candidate"), status=F.lit("unknown"),
        notes=F.lit("Extracted from local text; requires manual review before merging."),
    )
