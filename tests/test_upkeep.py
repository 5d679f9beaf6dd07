"""Upkeep over run history, change counts in one pass, suffix tables, and promotion of a key with very many records."""

import random

from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X
from gridloom.operators import metrics, promote, validate
from tests.test_merging import FIELDS, frame, key, merged, record, urls


def test_a_record_confirmed_in_between_stays(spark):
    seen = {"gone": [1, 2, 3], "back": [1, 2, 9], "gaps": [1, 3, 5, 6, 8], "now": [10], "late": [12]}
    rows = [(d, 1, "stratum+tcp", "btc" if i % 2 else "BTC", c) for d, cycles in seen.items() for i, c in enumerate([*cycles, *cycles])] + [("gone", 1, "stratum+tcp", "BTC", None)]
    sightings = spark.createDataFrame(rows, "domain string, port int, scheme string, coin string, cycle int")
    runs = sorted((r["domain"], r["first_cycle"], r["last_cycle"], r["cycles"]) for r in promote.confirmation_runs(sightings).collect())
    assert runs == [
        ("back", 1, 2, 2), ("back", 9, 9, 1), ("gaps", 1, 1, 1), ("gaps", 3, 3, 1), ("gaps", 5, 6, 2), ("gaps", 8, 8, 1), ("gone", 1, 3, 3), ("late", 12, 12, 1), ("now", 10, 10, 1),
    ]
    rng = random.Random(1)
    library = frame(spark, [record(rng, i) | {"domain": d, "port": 1, "coin": "BTC", "confidence": "candidate", "status": "active"} for i, d in enumerate([*seen, "never"])])
    kept = {r["domain"]: (r["missed"], r["status"]) for r in promote.retire_unconfirmed(library, sightings, 10).collect()}
    assert kept == {"gone": (7, "retired"), "back": (1, "active"), "gaps": (2, "retired"), "now": (0, "active"), "late": (None, "retired"), "never": (None, "retired")}


def test_change_in_one_pass_equals_two_snapshots(spark):
    rng = random.Random(6)
    rows = [record(rng, i) | {"domain": rng.choice(["a.example", "B.example", "", "c.example"])} for i in range(60)]
    whole = frame(spark, rows).withColumn("before", F.when(F.col("ord") % 7 == 0, None).otherwise(F.col("ord") % 3 == 0))
    sites = whole.select(F.concat("domain", F.lit(".site")).alias("website_domain"), "before")
    nodes = whole.select(F.col("domain").alias("node_host"), "port", F.lit(None).cast("string").alias("node_type"), "before")
    tables = lambda keep: (keep(sites), [keep(whole), keep(whole.where("port = 1"))], keep(whole.where("port = 2")), keep(nodes), keep(whole.where("confidence = 'confirmed'")), validate.watchlist(keep(whole)))
    want = metrics.count_delta(metrics.snapshot(*tables(lambda d: d)), metrics.snapshot(*tables(lambda d: d.where("before"))))
    got = metrics.snapshot_change(*tables(lambda d: d), "before")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert metrics.snapshot_change(*tables(lambda d: d.where("false")), "before").agg(F.sum("total")).first()[0] == 0


def test_stored_snapshots_are_joined_without_a_shuffle(spark, tmp_path):
    rows = lambda n, step: spark.createDataFrame([(metrics.METRICS[i % 5], f"k{i}") for i in range(0, n, step)], "metric string, key string")
    try:
        metrics.store_snapshot(rows(400, 1), "stored_now", str(tmp_path / "now"), 4)
        metrics.store_snapshot(rows(900, 3), "stored_old", str(tmp_path / "old"), 4)
        got = metrics.stored_delta(spark, "stored_now", "stored_old")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, metrics.count_delta(rows(400, 1), rows(900, 3)).collect()))
        plan = got._jdf.queryExecution().sparkPlan().toString() + got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "hashpartitioning(metric#" in plan and ", key#" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    finally:
        for name in ("stored_now", "stored_old"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_suffix_table_equals_the_list(spark):
    rng = random.Random(3)
    label = lambda: rng.choice(["a", "b", "ab", "pool", "x-1"])
    domain = lambda: ".".join(label() for _ in range(rng.randint(1, 4))) + rng.choice(["", "."])
    rows = spark.createDataFrame([(i, domain().upper() if i % 2 else domain()) for i in range(200)] + [(900, None), (901, "")], "id int, d string")
    listed = sorted({domain().strip(".") for _ in range(30)})
    table = spark.createDataFrame([("." + s,) for s in listed] + [(None,), ("",)], "suffix string")
    got = {r["id"] for r in E.matching_suffixes(rows, F.col("d"), table).collect()}
    want = {r["id"] for r in rows.where(E.suffix_allowed(F.col("d"), F.array(*map(F.lit, listed)))).collect()}
    assert got == want and got


def test_promotion_of_one_key_with_many_records(spark):
    rng = random.Random(12)
    sources = [(f"s{k}", "trusted", [record(rng, i) | {"domain": "a.example", "port": 1, "coin": rng.choice(["BTC", "btc"])} for i in range(1500)]) for k in range(2)]
    ready = validate.good(promote.prepare(promote.tagged([(label, kind, frame(spark, rows)) for label, kind, rows in sources])))
    assert "collect_list" not in promote.promote(frame(spark, []), ready)._jdf.queryExecution().optimizedPlan().toString()
    held = {}
    for r in (r.asDict() for r in ready.orderBy("src_ord", "ord").select(*FIELDS).collect()):
        held[key(r)] = merged(held[key(r)], r) if key(r) in held else r
    (got,) = promote.promote(frame(spark, []), ready).collect()
    (want,) = held.values()
    assert tuple(got[f] for f in X.ENDPOINT_FIELDS) == tuple(want[f] for f in FIELDS) and got["change"] == "inserted"
    assert len(urls(want)) > 30
