"""Snapshots of key sets, their change between runs, and summaries of fetch reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E

# The seven metrics of a snapshot.
METRICS = (
    "site_domains", "endpoint_domains", "endpoint_records", "ip_candidates", "blockchain_nodes", "stable_library", "watchlist",
)


def _keys(
    sites: DataFrame, endpoints: list[DataFrame], ip_candidates: DataFrame, nodes: DataFrame, library: DataFrame, watchlist: DataFrame, *more: str
) -> DataFrame:
    """(metric, key) of every row of the tables, and their columns ``more``. A row gives the keys of all metrics that it counts in at once."""
    key, named = E.endpoint_snapshot_key(), lambda metric, c: F.struct(F.lit(metric).alias("metric"), c.alias("key"))
    fields = [F.col("domain"), F.col("port").cast("string").alias("port"), F.col("scheme"), F.col("coin"), *[F.col(c) for c in more]]

    def rows(df: DataFrame, *entries: Column) -> DataFrame:
        return df.select(F.inline(F.array(*entries)), *more)

    every = reduce(DataFrame.unionByName, [df.select(*fields) for df in endpoints])
    parts = [
        rows(sites, named("site_domains", E.domain_snapshot_key("website_domain"))),
        rows(every, named("endpoint_domains", E.domain_snapshot_key("domain")), named("endpoint_records", key)),
        rows(ip_candidates.select(*fields), named("ip_candidates", key)),
        rows(nodes, named("blockchain_nodes", E.node_snapshot_key())),
        rows(library.select(*fields), named("stable_library", key)),
        rows(watchlist.select(*fields), named("watchlist", key)),
    ]
    return reduce(DataFrame.unionByName, parts).where(F.col("key").isNotNull())


def snapshot(
    sites: DataFrame, endpoints: list[DataFrame], ip_candidates: DataFrame, nodes: DataFrame, library: DataFrame, watchlist: DataFrame
) -> DataFrame:
    """Distinct keys of each metric as (metric, key). ``endpoints`` are all the tables that endpoint metrics span."""
    return _keys(sites, endpoints, ip_candidates, nodes, library, watchlist).distinct()


def snapshot_change(
    sites: DataFrame, endpoints: list[DataFrame], ip_candidates: DataFrame, nodes: DataFrame, library: DataFrame, watchlist: DataFrame, before: str
) -> DataFrame:
    """(metric, total, new) of tables whose boolean column ``before`` says of each row whether the baseline had it too.

    The same as ``count_delta`` of two snapshots, where both are cut from the same tables: they are read once, and keys are aggregated
    once, with whether any of their rows is an old one.
    """
    met = _keys(sites, endpoints, ip_candidates, nodes, library, watchlist, before).groupBy("metric", "key").agg(F.max(before).alias("_old"))
    return _all_metrics(met.groupBy("metric").agg(F.count(F.lit(1)).alias("total"), F.count_if(~F.coalesce("_old", F.lit(False))).alias("new")))


def _all_metrics(counted: DataFrame) -> DataFrame:
    names = counted.sparkSession.createDataFrame([(m,) for m in METRICS], "metric string")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return names.join(F.broadcast(counted), "metric", "left").select("metric", zero("total"), zero("new"))


def choose_baseline(previous: DataFrame, current: DataFrame) -> DataFrame:
    """The stored snapshot of the run before; the current one where that is empty."""
    return current if previous.isEmpty() else previous


def count_delta(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """(metric, total, new) of all metrics: distinct keys now, and those that the baseline lacks."""
    old = baseline.select("metric", "key").distinct().withColumn("_old", F.lit(True))
    counted = (
        current.select("metric", "key").distinct().join(old, ["metric", "key"], "left")
        .groupBy("metric").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_old").isNull()).alias("new"))
    )
    return _all_metrics(counted)


def store_snapshot(snapshot: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """Keep a snapshot as the table ``table`` under ``path``, in buckets of (metric, key), so that its change to another needs no shuffle of either."""
    dealt = snapshot.select("metric", "key").repartition(buckets, "metric", "key")
    dealt.write.mode("overwrite").bucketBy(buckets, "metric", "key").sortBy("metric", "key").option("path", path).saveAsTable(table)


def stored_delta(spark: SparkSession, current: str, baseline: str) -> DataFrame:
    """``count_delta`` of two stored snapshots with the same number of buckets: a merge join of buckets; only a count per task and metric is shuffled."""
    old = spark.table(baseline).withColumn("_old", F.lit(True))
    met = spark.table(current).join(old.hint("merge"), ["metric", "key"], "left")
    return _all_metrics(met.groupBy("metric").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_old").isNull()).alias("new")))


def report_summary(*reports: DataFrame) -> DataFrame:
    """(total, ok, failed, used_cache) over fetch reports of any shape; a missing ``ok`` counts in the total alone."""
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)
    return whole.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed"),
        F.count_if("used_cache").alias("used_cache"),
    )


def fetch_report(pages: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """One row per fetched page (``key``, url, ok, body): its hash, size and number of ``found`` records, none among them.

    What pages tell of status, used_cache and error is handed on.
    """
    told = [c for c in ("status", "used_cache", "error") if c in pages.columns]
    counts = found.groupBy(key).agg(F.count(F.lit(1)).alias("records"))
    return pages.join(counts, key, "left").select(
        key, "url", "ok", F.sha2("body", 256).alias("sha256"), F.coalesce(F.octet_length("body"), F.lit(0)).cast("long").alias("bytes"),
        F.coalesce("records", F.lit(0)).alias("records"), *told,
    )


def cache_fallback(fetches: DataFrame, run: int) -> DataFrame:
    """Results of ``run`` per source (run, source_id, ok, n_records, ord), a failed one replaced by its last good earlier one.

    Returns source_id, ok, n_records, used_cache.
    """
    now = F.col("run") == run
    rows = fetches.where(F.col("run") <= run).groupBy("source_id").agg(
        F.max_by(F.when(now, F.struct("ok", "n_records")), F.when(now, F.col("ord"))).alias("now"),
        F.max_by("n_records", F.when(~now & F.col("ok"), F.struct("run", "ord"))).alias("kept"),
        F.max(~now & F.col("ok")).alias("has_kept"),
    )
    used = ~F.col("now.ok") & F.col("has_kept")
    count = F.when(F.col("now.ok"), F.col("now.n_records")).when(used, F.col("kept")).otherwise(0)
    return rows.where(F.col("now").isNotNull()).select("source_id", F.col("now.ok").alias("ok"), count.alias("n_records"), used.alias("used_cache"))


def last_good_records(fetches: DataFrame, records: DataFrame, run: int) -> DataFrame:
    """``records`` (source_id, run, any others) that ``run`` goes on with, and ``used_cache``.

    A source whose last fetch of the run (run, source_id, ok, ord) failed keeps the records of its last good earlier run; one without such
    a run has none.
    """
    now, earlier = F.col("run") == run, (F.col("run") < run) & F.col("ok")
    outcome = fetches.where(F.col("run") <= run).groupBy("source_id").agg(
        F.max_by(F.when(now, F.col("ok")), F.when(now, F.col("ord"))).alias("ok"), F.max(F.when(earlier, F.col("run"))).alias("kept")
    )
    taken = F.when(F.col("ok"), F.lit(run).cast("long")).otherwise(F.col("kept")).alias("run")
    return records.join(outcome.where("ok is not null").select("source_id", taken, (~F.col("ok")).alias("used_cache")), ["source_id", "run"])


def run_time(text: Column) -> Column:
    """A time in ISO form, with ``Z``, an offset, or neither (then UTC)."""
    zoned = F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})\z"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def run_status(runs: DataFrame) -> DataFrame:
    """Runs (run_id, started, ended as ISO text) with duration_seconds, duration text and the start at UTC+8."""
    seconds = F.greatest(F.unix_timestamp(run_time(F.col("ended"))) - F.unix_timestamp(run_time(F.col("started"))), F.lit(0))
    return runs.withColumn("duration_seconds", seconds).select(
        "run_id", "duration_seconds",
        F.format_string("%d min %02d s", F.expr("duration_seconds div 60"), F.col("duration_seconds") % 60).alias("duration"),
        F.date_format(F.from_utc_timestamp(run_time(F.col("started")), "+08:00"), "yyyy-MM-dd HH:mm:ss").alias("started_utc8"),
    )


def run_record(run: DataFrame, parameters: dict[str, str], delta: DataFrame, summary: DataFrame) -> DataFrame:
    """One row for a run: ``run`` (one row of ``run_status``), its parameters, the counts of ``count_delta`` and those of ``report_summary``."""
    counts = [F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"{m}_{c}") for m in METRICS for c in ("total", "new")]
    parts = [
        run.withColumns({name: F.lit(value) for name, value in parameters.items()}),
        delta.agg(*counts),
        summary.select(*[F.col(c).alias(f"fetches_{c}") for c in ("total", "ok", "failed", "used_cache")]),
    ]
    # Each part is one row.
    rows = [part.withColumn("_row", F.lit(1)) for part in parts]
    return reduce(lambda a, b: a.join(F.broadcast(b), "_row"), rows).drop("_row")
