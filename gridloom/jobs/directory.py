"""Job: directory listings to the site list, bare endpoints, and the change against the run before."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.operators import dedupe, sites, validate
from gridloom.sources import files


def build(listing: DataFrame, existing: DataFrame, source: dict[str, str], coin_url: str, day: str) -> tuple[DataFrame, DataFrame]:
    """(sites, good endpoints) of listed pools (coin_slug, item, url, pool_id) and the existing sites.

    Endpoints are validated before they are made unique, so that a bad first record does not hide a good later one.
    """
    rows = sites.listed(listing).withColumn("ord", F.struct("coin_slug", "item"))
    new = sites.listed_sites(rows, source, coin_url, day, ("ord",))
    merged = dedupe.merge_existing(existing.withColumn("ord", F.struct(F.lit("").alias("coin_slug"), F.col("ord").alias("item"))), new)
    return merged, sites.ip_list(rows, coin_url, day)


def main(spark: SparkSession, listing_path: str, existing_path: str, out: str, source_id: str, source_url: str, coin_url: str, day: str) -> None:
    source = {"id": source_id, "url": source_url, "source_type": "directory", "confidence": "candidate"}
    merged, found = build(spark.read.parquet(listing_path), spark.read.parquet(existing_path), source, coin_url, day)
    ordered = merged.orderBy(F.lower("pool_name"), "website_domain")
    files.publish(spark, out, {"sites": (ordered, X.SITE_FIELDS), "ip_endpoints": (validate.library(found), X.ENDPOINT_FIELDS)})


if __name__ == "__main__":
    main(SparkSession.builder.appName("directory").getOrCreate(), *sys.argv[1:])
