"""Job: seeds and discovered sources to the library, its watchlist, the promotion report and the run record, published as one version."""

from __future__ import annotations

import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.operators import dedupe, metrics, promote, validate
from gridloom.sources import files

WITHOUT = "--without="


def build(seeds: DataFrame, sources: list[tuple[str, str, DataFrame]], without: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(promoted records with change and errors, prepared records with errors); each source is made unique by key before.

    ``without`` are labels of sources that are left out of this run.
    """
    used = [(label, kind, dedupe.unique_first(rows)) for label, kind, rows in sources if label not in without]
    good_seeds = validate.good(validate.normalize(seeds))
    if not used:
        used = [("none", "candidate", seeds.where("false"))]
    prepared = promote.prepare(promote.tagged(used))
    return promote.promote(good_seeds, validate.good(prepared)), prepared


def _snapshot(library: DataFrame) -> DataFrame:
    """The keys of this job's tables; sites, nodes and bare addresses are counted by the jobs that make them."""
    spark, none = library.sparkSession, library.where("false")
    sites, nodes = spark.createDataFrame([], "website_domain string"), spark.createDataFrame([], "node_host string, port int, node_type string")
    return metrics.snapshot(sites, [library], none, nodes, library, validate.watchlist(library))


def main(spark: SparkSession, seeds_path: str, out: str, *arguments: str) -> None:
    """``arguments`` are sources as label:kind:path, and --without=label for each one that is left out."""
    started = datetime.now(timezone.utc).isoformat(timespec="seconds")
    without = tuple(a.removeprefix(WITHOUT) for a in arguments if a.startswith(WITHOUT))
    parts = [a.split(":", 2) for a in arguments if not a.startswith(WITHOUT)]
    seeds = spark.read.parquet(seeds_path)
    promoted, prepared = build(seeds, [(label, kind, spark.read.parquet(path)) for label, kind, path in parts], without)
    # Not a part of what is published: read by all that follows, and written anew by the next run.
    promoted.write.mode("overwrite").parquet(f"{out}/work/promoted.parquet")
    prepared.select("src_label", "src_ord", "ord", "given_domain", "given_port", "errors").write.mode("overwrite").parquet(f"{out}/work/prepared.parquet")
    stored, told = spark.read.parquet(f"{out}/work/promoted.parquet"), spark.read.parquet(f"{out}/work/prepared.parquet")
    library = validate.good(stored)
    now = _snapshot(library)
    previous = files.read_published(spark, out, "snapshot") if "snapshot" in files.manifest(spark, out)["tables"] else now.where("false")
    ended = datetime.now(timezone.utc).isoformat(timespec="seconds")
    run = metrics.run_status(spark.createDataFrame([(started, started, ended)], "run_id string, started string, ended string"))
    fetches = told.select(F.lit(True).alias("ok")).where("false")
    record = metrics.run_record(run, {"sources": ",".join(p[0] for p in parts), "without": ",".join(without)}, metrics.count_delta(now, metrics.choose_baseline(previous, now)), metrics.report_summary(fetches.withColumn("used_cache", F.lit(False))))
    tables = {
        "library": (validate.library(library), X.ENDPOINT_FIELDS),
        "watchlist": (validate.library(validate.watchlist(library)), X.ENDPOINT_FIELDS),
        "snapshot": (now.orderBy("metric", "key"), ("metric", "key")),
    }
    reports = {"report": promote.promotion_report(stored), "inputs": promote.promotion_inputs(validate.good(validate.normalize(seeds)), told), "skipped": promote.skip_examples(told), "run": record}
    files.publish(spark, out, tables | {name: (rows, tuple(rows.columns)) for name, rows in reports.items()})


if __name__ == "__main__":
    main(SparkSession.builder.appName("library").getOrCreate(), *sys.argv[1:])
