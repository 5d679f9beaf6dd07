"""Keys with very many URLs: the same as the plain fold, by an aggregation over strings instead of one row's fold."""

import random

import pytest
from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.operators import dedupe
from tests.test_merging import fold, frame, plain, record


def url(rng):
    one = lambda: "https://" + rng.choice(["a", "ab", "é"]) + ".example/" + "x" * rng.randint(0, 3) + str(rng.randint(0, 12))
    kind = rng.random()
    if kind < 0.6:
        return one()
    if kind < 0.8:
        return "; ".join(one() for _ in range(rng.randint(2, 3)))
    return rng.choice(["", "h", "; ", "0; https://a", "example/x", "https://web.example/of/" + one(), one() + ";", " " + one(), "https"])


@pytest.mark.parametrize("seed", range(4))
def test_wide_keys_equal_the_fold(spark, monkeypatch, seed):
    monkeypatch.setattr(dedupe, "FOLD_URLS", 3)
    rng = random.Random(seed)
    rows = [record(rng, i) | {"source_url": url(rng)} for i in range(260)]
    df = frame(spark, rows)
    assert plain(dedupe.unique_first(df)) == fold(rows, False)
    assert plain(dedupe.unique_ranked(df)) == fold(rows, True)


def test_wide_nodes_and_sites_equal_the_fold(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "FOLD_URLS", 3)
    rng = random.Random(8)
    rows = [(i, "192.0.2.1", rng.choice([1, 2]), "addnode", f"p{i}", "BTC", url(rng), "d", f"2026-01-{rng.randint(10, 28)}", "n") for i in range(150)]
    held = {}
    for r in rows:
        now = held.setdefault(r[1:4], list(r[1:]))
        if r[6] not in now[5]:
            now[5] += "; " + r[6]
            now[7] = max(now[7], r[8])
    schema = "ord int, " + ", ".join(f"{f} {'int' if f == 'port' else 'string'}" for f in X.NODE_FIELDS)
    got = dedupe.unique_nodes(spark.createDataFrame(rows, schema).repartition(4)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, held.values()))


def test_one_key_with_many_urls(spark):
    """Half of the URLs are held by an earlier or later one; the answer is told by a set of prefixes, not by the operator's way."""
    n = 60_000
    ids = list(range(n))
    random.Random(2).shuffle(ids)
    tail = lambda i: "/index" if i % 2 else ""
    address = [f"https://pool.example/p{i // 2:07d}{tail(i)}" for i in ids]
    held, want = set(), []
    for a in address:
        if a not in held:
            want.append(a)
        held.update(a[:k] for k in range(28, len(a) + 1))
    rows = spark.createDataFrame(list(enumerate(address)), "ord long, source_url string").repartition(6)
    same = {f: F.lit("x") for f in X.ENDPOINT_FIELDS if f != "source_url"} | {"port": F.lit(1), "confidence": F.lit("candidate")}
    records = rows.select("ord", *[same.get(f, F.col(f)).alias(f) for f in X.ENDPOINT_FIELDS])
    (got,) = dedupe.unique_first(records).collect()
    assert got["source_url"].split("; ") == want
    late = records.withColumn("confidence", F.when(F.col("ord") == 30_000, "confirmed").otherwise("candidate"))
    (got,) = dedupe.unique_ranked(late).collect()
    held, want = set(), []
    for a in address[30_000:]:
        if a not in held:
            want.append(a)
        held.update(a[:k] for k in range(28, len(a) + 1))
    assert got["source_url"].split("; ") == want


def test_no_task_gathers_the_urls_of_a_key_before_they_are_decided(spark):
    plan = dedupe.urls_not_held(
        spark.createDataFrame([("k", "https://a", 1, None)], "_key string, _url string, _ord int, _seen string")
    )._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
    assert "hashpartitioning(_key" in plan and "_url" in plan
