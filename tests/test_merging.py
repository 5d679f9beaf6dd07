"""Deduplication, promotion and metrics against plain Python folds over random records."""

import random

from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.operators import dedupe, metrics, promote, validate

FIELDS = X.ENDPOINT_FIELDS
SCHEMA = "ord long, " + ", ".join(f"{f} {'int' if f == 'port' else 'string'}" for f in FIELDS)


def record(rng, ord_):
    confidence = rng.choice(["confirmed", "probable", "candidate", "candidate", "retired"])
    urls = [f"https://s{rng.randint(0, 12)}.example/{'x' * rng.randint(0, 2)}" for _ in range(2 if confidence == "probable" else 1)]
    return {
        "ord": ord_, "domain": rng.choice(["a.example", "b.example", "192.0.2.7"]), "port": rng.choice([1, 2]), "scheme": "stratum+tcp", "pool_name": f"P{rng.randint(0, 3)}",
        "coin": rng.choice(["BTC", "btc", "UNKNOWN"]), "algorithm": rng.choice(["SHA-256", "UNKNOWN", "X11"]), "region": rng.choice(["Global", "USA"]),
        "source_type": "official" if confidence == "confirmed" else rng.choice(X.SOURCE_TYPES), "source_url": "; ".join(urls), "confidence": confidence,
        "status": "retired" if confidence == "retired" else rng.choice(["active", "unknown"]), "first_seen": f"2026-01-{rng.randint(10, 28)}",
        "last_seen": f"2026-02-{rng.randint(10, 28)}", "notes": rng.choice(["", "n1", "n2"]),
    }


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f] for f in ("ord", *FIELDS)) for r in rows], SCHEMA).repartition(3)


def key(r):
    return (r["domain"], r["port"], r["scheme"], r["coin"].upper())


def fold(rows, ranked):
    held = {}
    for r in sorted(rows, key=lambda r: r["ord"]):
        now = held.get(key(r))
        if now is None or (ranked and X.CONFIDENCE_RANK[r["confidence"]] > X.CONFIDENCE_RANK[now["confidence"]]):
            held[key(r)] = dict(r)
        elif r["source_url"] not in now["source_url"]:
            now["source_url"] += "; " + r["source_url"]
    return sorted(tuple(r[f] for f in FIELDS) for r in held.values())


def plain(df):
    return sorted(tuple(r) for r in df.select(*FIELDS).collect())


def test_unique_records(spark):
    rows = [record(random.Random(s), s) for s in range(300)]
    df = frame(spark, rows)
    assert plain(dedupe.unique_ranked(df)) == fold(rows, True)
    assert plain(dedupe.unique_first(df)) == fold(rows, False)
    once = dedupe.unique_ranked(df)
    assert plain(dedupe.unique_ranked(once)) == plain(once)
    assert dedupe.unique_first(df.where("false")).count() == 0


def test_unique_nodes(spark):
    rng = random.Random(1)
    rows = [(i, "192.0.2.1", rng.choice([1, 2]), "addnode", f"p{i}", "BTC", f"https://n{rng.randint(0, 9)}.example/", "d", f"2026-01-{rng.randint(10, 28)}", "n") for i in range(80)]
    held = {}
    for r in rows:
        now = held.setdefault(r[1:4], list(r[1:]))
        if r[6] not in now[5]:
            now[5] += "; " + r[6]
            now[7] = max(now[7], r[8])
    schema = "ord int, " + ", ".join(f"{f} {'int' if f == 'port' else 'string'}" for f in X.NODE_FIELDS)
    got = dedupe.unique_nodes(spark.createDataFrame(rows, schema).repartition(4)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, held.values()))


def test_unique_sites(spark):
    rows = [("A", "x.com"), ("B", ""), ("C", "c.example"), ("D", "192.0.2.1"), ("E", "c.example"), ("F", "c.example")]
    full = [(i, n, d, "w", f"https://p.example/{i % 3}", "s", "directory", "candidate", "f", "l", "n") for i, (n, d) in enumerate(rows)]
    df = spark.createDataFrame(full, "ord int, " + ", ".join(f"{f} string" for f in X.SITE_FIELDS))
    got = dedupe.unique_sites(df).collect()
    assert [(r["pool_name"], r["profile_url"]) for r in got] == [("C", "https://p.example/2; https://p.example/1")]
    merged = dedupe.merge_existing(df.where("ord = 5"), df.where("ord < 5")).collect()
    assert [r["pool_name"] for r in merged] == ["F"]


def stays(r):
    return "UNKNOWN" in (r["coin"].upper(), r["algorithm"].upper()) or r["domain"].startswith("192.")


def urls(r):
    return list(dict.fromkeys(u.strip() for u in r["source_url"].split(";") if u.strip()))


def prepared(r, label, kind):
    r = dict(r)
    low = kind == "candidate" or (r["confidence"] == "probable" and len(urls(r)) < 2) or (r["confidence"] == "confirmed" and r["source_type"] != "official")
    if low or stays(r):
        r |= {"confidence": "candidate", "status": "unknown"}
    return r | {"notes": f"{r['notes']} auto_source={label}".strip()}


def merged(a, x):
    best = max(a["confidence"], x["confidence"], key=X.CONFIDENCE_RANK.get) if X.CONFIDENCE_RANK[x["confidence"]] > X.CONFIDENCE_RANK[a["confidence"]] else a["confidence"]
    raised, every = best != a["confidence"], list(dict.fromkeys(urls(a) + urls(x)))
    out = dict(a) | {f: x[f] if raised and x[f] else a[f] or x[f] for f in ("pool_name", "algorithm", "region")}
    if X.SOURCE_TYPE_RANK[x["source_type"]] > X.SOURCE_TYPE_RANK[a["source_type"]]:
        out["source_type"] = x["source_type"]
    out |= {"source_url": "; ".join(every), "confidence": best, "first_seen": min(a["first_seen"], x["first_seen"]), "last_seen": max(a["last_seen"], x["last_seen"])}
    out["notes"] = " | ".join(dict.fromkeys(n for n in (a["notes"].strip(), x["notes"].strip()) if n))[:900]
    if stays(out):
        out |= {"confidence": "candidate", "status": "unknown"}
    elif best == "candidate" and len(every) >= 2:
        out |= {"confidence": "probable", "status": "active"}
    else:
        out["status"] = "active" if best in ("confirmed", "probable") else "unknown"
    return out


def test_promotion(spark):
    rng = random.Random(11)
    seeds = [record(rng, i) for i in range(12)]
    sources = [(f"s{k}", kind, [record(rng, i) for i in range(15)]) for k, kind in enumerate(("trusted", "trusted", "candidate", "candidate"))]
    held, old = {}, {}
    for r in seeds:
        if len(urls(r)) >= 2 or r["confidence"] != "probable":
            held[key(r)] = old[key(r)] = r
    for label, kind, rows in sources:
        for r in rows:
            p = prepared(r, label, kind)
            held[key(p)] = merged(held[key(p)], p) if key(p) in held else p
    want = sorted((*(r[f] for f in FIELDS), "inserted" if k not in old else "unchanged" if all(old[k][f] == r[f] for f in FIELDS) else "updated") for k, r in held.items())
    good = validate.good(validate.normalize(frame(spark, seeds)))
    ready = promote.prepare(promote.tagged([(label, kind, frame(spark, rows)) for label, kind, rows in sources]))
    assert ready.where(F.size("errors") > 0).count() == 0
    done = promote.promote(good, validate.good(ready))
    assert sorted(tuple(r) for r in done.select(*FIELDS, "change").collect()) == want
    report = {(r["metric"], r["value"]): r["n"] for r in promote.promotion_report(done).collect()}
    assert report["total", "library"] + report["total", "held_back"] == len(held)


def test_upkeep(spark):
    rows = [record(random.Random(s), s) for s in range(60)]
    library = dedupe.unique_ranked(frame(spark, rows))
    stale = promote.retire_stale(library, "2026-03-10").collect()
    assert all((r["status"] == "retired") for r in stale if r["last_seen"] < "2026-02-24")
    audit = {r["change"]: r["n"] for r in promote.change_audit(library, library.where("port = 1")).collect()}
    assert audit.keys() <= {"kept", "deleted"} and audit["kept"] == library.where("port = 1").count()


def test_metrics(spark):
    endpoint = spark.createDataFrame(
        [("btc.examplepool.com", 3333, "stratum+tcp", "BTC"), ("BTC.ExamplePool.com", 3333, "STRATUM+TCP", "btc"), ("192.0.2.10", 4444, "stratum+tcp", "UNKNOWN"), ("x", 0, "a", "b")],
        "domain string, port int, scheme string, coin string",
    )
    sites = spark.createDataFrame([("ExamplePool.com",), ("examplepool.com",), ("other.example",), (None,)], "website_domain string")
    nodes = spark.createDataFrame([("192.0.2.20", 8333, None)], "node_host string, port int, node_type string")
    ips = endpoint.where("port = 4444")
    now = metrics.snapshot(sites, [endpoint, ips], ips, nodes, endpoint.limit(1), endpoint.where("false"))
    keys = {m: sorted(r["key"] for r in now.collect() if r["metric"] == m) for m in metrics.METRICS}
    assert keys["site_domains"] == ["examplepool.com", "other.example"] and len(keys["endpoint_records"]) == 2
    assert keys["blockchain_nodes"] == ["192.0.2.20|8333|node"] and keys["watchlist"] == []
    delta = {r["metric"]: (r["total"], r["new"]) for r in metrics.count_delta(now, now.where("key = 'other.example'")).collect()}
    assert delta["site_domains"] == (2, 1) and delta["watchlist"] == (0, 0)
    assert metrics.choose_baseline(now.where("false"), now) is now
    a = spark.createDataFrame([("u", True), ("v", None)], "url string, ok boolean")
    b = spark.createDataFrame([("w", False, True)], "id string, ok boolean, used_cache boolean")
    assert tuple(metrics.report_summary(a, b).first()) == (3, 1, 1, 1)
    runs = spark.createDataFrame([(1, "2026-04-20T01:00:00Z", "2026-04-20T01:02:05Z"), (2, "2026-04-20T09:00:00+08:00", "2026-04-20T00:00:00")], "run_id int, started string, ended string")
    got = {r["run_id"]: r for r in metrics.run_status(runs).collect()}
    assert got[1]["duration_seconds"] == 125 and got[1]["started_utc8"] == "2026-04-20 09:00:00" and got[2]["duration_seconds"] == 0
