"""Job: crawled pages of sites to graded endpoint and node tables."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.functions import text as TX
from gridloom.operators import dedupe, extract, records, validate
from gridloom.sources import files

#: A page without one of these has no hit, and is not searched further; the flags are those of the patterns of hits.
CHEAP = rf"{X.FLAGS}\d\s*:\s*\d|[a-z0-9-]\s*:\s*\d{{2}}|stratum\+"


def page_texts(pages: DataFrame) -> DataFrame:
    """Pages (site, pool_name, page_ord, url, content_type, body) as text; bodies are dropped in the same stage."""
    text = TX.html_to_text(TX.decode_body(F.col("body"), F.col("content_type")))
    rows = pages.select("site", "pool_name", "page_ord", F.col("url").alias("page_url"), text.alias("text"))
    return rows.where(F.col("text").rlike(CHEAP))


def crawl(pages: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """(endpoints with ``errors``, nodes) of pages; the order of records is site, page, then the endpoint itself."""
    texts = page_texts(pages)
    found = records.site_records(extract.site_endpoints(texts), day, ("site", "page_ord"))
    ordered = found.withColumn("ord", F.struct("site", "page_ord", "domain", "port", "scheme"))
    endpoints = validate.normalize(dedupe.unique_first(ordered.drop("site", "page_ord")))
    peers = records.node_records(extract.site_nodes(texts).withColumn("site_coin", F.lit(None).cast("string")), day, ("site", "page_ord"))
    nodes = dedupe.unique_nodes(peers.withColumn("ord", F.struct("site", "page_ord", "node_host", "port", "node_type")))
    return endpoints, nodes


def main(spark: SparkSession, pages_path: str, out: str, day: str) -> None:
    endpoints, nodes = crawl(spark.read.parquet(pages_path), day)
    # Not a part of what is published: good records and bad ones are both read from it.
    endpoints.write.mode("overwrite").parquet(f"{out}/work/checked.parquet")
    checked = spark.read.parquet(f"{out}/work/checked.parquet")
    bad = validate.quarantine(checked).withColumn("errors", F.array_join("errors", "\n"))
    tables = {
        "endpoints": (validate.library(validate.good(checked)), X.ENDPOINT_FIELDS),
        "quarantine": (bad, (*X.ENDPOINT_FIELDS, "errors")),
        "nodes": (nodes.orderBy("node_host", "port", "node_type"), X.NODE_FIELDS),
    }
    files.publish(spark, out, tables)


if __name__ == "__main__":
    main(SparkSession.builder.appName("crawl").getOrCreate(), *sys.argv[1:4])
