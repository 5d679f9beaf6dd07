"""One id or payload on a large share of the rows: nothing is lost, and no row meets what only its id shares."""

import random
import re
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.llm.test_operators import brute_repeats

SCHEMA = "doc_id long, text string, lang string"


def test_no_language_is_lost_with_one_id(spark):
    from gridloom.llm.language import fit_sample, identify

    english, french = "the cat sat on the mat with number %d and the dog", "le petit chat est sur la table %d avec le chien"
    for shared in (5, 7, 9, 11, 13, None):
        rows = [(shared, english % i, "en") for i in range(2000)] + [(1000 + i, french % i, "fr") for i in range(1200)]
        docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
        sizes = {r["lang"]: r["n"] for r in fit_sample(docs, 100).groupBy("lang").agg(F.count("*").alias("n")).collect()}
        assert sizes == {"en": 100, "fr": 100}
    same = spark.createDataFrame([(7, english % 1, "en")] * 3000 + [(i, french % i, "fr") for i in range(300)], SCHEMA)
    assert {(r["lang"], r["n"]) for r in fit_sample(same, 100).groupBy("lang").agg(F.count("*").alias("n")).collect()} == {("en", 1), ("fr", 100)}
    assert {r["lang_pred"] for r in identify(same.where("lang = 'en'").limit(5).unionAll(same.where("lang = 'fr'"))).collect()} >= {"fr"}


def test_repeats_with_one_id_cost_what_other_ids_cost(spark):
    from gridloom.llm.suffix_dedup import remove_repeats

    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    passages = [" ".join(word() for _ in range(20)) for _ in range(30)]
    texts = [" ".join(word() for _ in range(30)) + rng.choice(passages) + word() for _ in range(3000)]
    took = {}
    for name, ids in (("own", range(10, 3010)), ("one", [7] * 3000)):
        rows = [(3, p, "x") for p in passages] + [(i, t, "x") for i, t in zip(ids, texts, strict=True)]
        docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
        began = time.time()
        got = sorted(map(tuple, remove_repeats(docs).collect()), key=str)
        took[name] = time.time() - began
        assert got == brute_repeats([r[:2] for r in rows], 100)
    assert took["one"] < 2 * took["own"] + 5


def test_capture_times_are_utc_in_any_session(spark, tmp_path):
    from gridloom.llm.archives import archive_pages, captures

    ids = (0, 59, 3600, 86399, 86400, 6_000_000, 26_000_000, 999_999_999, None)
    pages = spark.createDataFrame([(i, f"http://a.example/{(i or 0) % 3}", "x" * ((i or 0) % 4)) for i in ids], "page_id long, url string, html string")
    shown = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            merged = archive_pages(pages, str(tmp_path / name.replace("/", "-"))).select("page_id", "timestamp", "capture_rank", "record_type")
            shown.append(sorted(map(tuple, merged.collect()), key=str))
            assert captures(pages.where("page_id = 0")).first()["timestamp"] == "2024-01-01T00:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert shown[0] == shown[1] == shown[2]
    want = {(datetime(2024, 1, 1) + timedelta(seconds=i or 0)).isoformat() + "Z" for i in ids}
    assert {x[1] for x in shown[0]} == want


def test_a_payload_that_many_pages_share_is_split(spark, tmp_path):
    from gridloom.llm.archives import captures

    rows = spark.range(60000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("hot "), 30)).otherwise(F.repeat(F.sha2(F.col("id").cast("string"), 256), 2)).alias("html"))
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        from gridloom.llm.archives import joined_with_responses

        joined = joined_with_responses(captures(rows))
        assert len(joined.collect()) == 60000
        assert re.search("skew=true", joined._jdf.queryExecution().executedPlan().toString())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
