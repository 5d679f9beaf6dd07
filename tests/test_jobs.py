"""Jobs, files and streams end to end, and the driver contract."""

import json
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.jobs import crawl, directory, library
from gridloom.operators import metrics
from gridloom.sources import files
from gridloom.streaming import crawl_stream, fetch_stream

PAGES = "site string, pool_name string, page_ord int, url string, content_type string, body binary"


def whole(folder):
    """The parts of a published document, put together by name."""
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def pages(spark):
    text = "<p>stratum+tcp://btc.pool.example:3333 and 192.0.2.9:4444 addnode=192.0.2.10:8333</p>"
    rows = [("pool.example", "P", i, f"https://pool.example/{i}", "text/html", bytearray(text.encode())) for i in range(3)]
    return spark.createDataFrame([*rows, ("pool.example", "P", 9, "https://pool.example/9", None, bytearray(b"nothing"))], PAGES)


def test_crawl_job(spark, tmp_path):
    pages(spark).write.parquet(str(tmp_path / "pages"))
    crawl.main(spark, str(tmp_path / "pages"), str(tmp_path / "out"), "2026-04-17")
    out = str(tmp_path / "out")
    got = files.read_published(spark, out, "endpoints")
    assert tuple(got.columns) == X.ENDPOINT_FIELDS
    assert {(r["domain"], r["port"]) for r in got.collect()} == {("btc.pool.example", 3333), ("192.0.2.9", 4444)}
    assert got.where("port = 3333").first()["source_url"] == "; ".join(f"https://pool.example/{i}" for i in range(3))
    assert whole(files.published_path(spark, out, "endpoints", "csv")).splitlines()[0] == ",".join(X.ENDPOINT_FIELDS)
    assert [list(r) for r in json.loads(whole(files.published_path(spark, out, "endpoints", "json")))] == [list(X.ENDPOINT_FIELDS)] * 2
    assert files.read_records(spark, files.published_path(spark, out, "endpoints", "json")).count() == 2
    assert files.read_published(spark, out, "nodes").count() == 1 and files.read_published(spark, out, "quarantine").count() == 0


def test_prefilter_keeps_every_page_with_a_hit(spark):
    texts = ["STRATUM+TCP://pool.example:5", "Stratum+Ssl://eu.pool.example : 7", "at btc.POOL.EXAMPLE:3333", "nothing"]
    rows = [("pool.example", "P", i, f"https://pool.example/{i}", "text/plain", bytearray(t.encode())) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, PAGES)
    assert {r["page_ord"] for r in crawl.page_texts(frame).collect()} == {0, 1, 2}
    found = {(r["domain"].lower(), r["port"]) for r in crawl.crawl(frame, "2026-04-17")[0].collect()}
    assert found == {("pool.example", 5), ("eu.pool.example", 7), ("btc.pool.example", 3333)}


def test_library_and_directory_jobs(spark, tmp_path):
    crawl.crawl(pages(spark), "2026-04-17")[0].drop("errors").write.parquet(str(tmp_path / "seeds"))
    library.main(spark, str(tmp_path / "seeds"), str(tmp_path / "lib"), f"crawl:trusted:{tmp_path}/seeds")
    lib = str(tmp_path / "lib")
    assert files.read_published(spark, lib, "library").count() == 2
    first = files.read_published(spark, lib, "run").first()
    assert (first["endpoint_records_total"], first["endpoint_records_new"], first["sources"]) == (2, 0, "crawl")
    inputs = {(r["metric"], r["value"]): r["n"] for r in files.read_published(spark, lib, "inputs").collect()}
    assert inputs == {("input", "crawl"): 2, ("skipped", "crawl"): 0, ("total", "seeds"): 2}
    library.main(spark, str(tmp_path / "seeds"), lib, f"crawl:trusted:{tmp_path}/seeds", "--without=crawl")
    assert files.read_published(spark, lib, "library").count() == 2 and files.read_published(spark, lib, "run").first()["without"] == "crawl"
    listing = spark.createDataFrame([("btc", 1, "https://a.example/x", None), ("btc", 2, "http://192.0.2.5:3333", "p")], "coin_slug string, item int, url string, pool_id string")
    existing = spark.createDataFrame([], "ord int, " + ", ".join(f"{f} string" for f in X.SITE_FIELDS))
    merged, found = directory.build(listing, existing, {"url": "u", "source_type": "directory", "confidence": "candidate"}, "https://d.example/", "2026-04-17")
    assert merged.count() == 1 and [r["domain"] for r in found.collect()] == ["192.0.2.5"]


def test_a_killed_job_leaves_the_old_version(spark, tmp_path, monkeypatch):
    folder, table = str(tmp_path / "out"), lambda n: spark.range(n).toDF("k")
    assert files.manifest(spark, folder)["version"] == ""
    for n in (1, 2, 3):
        files.publish(spark, folder, {"a": (table(n), ("k",)), "b": (table(n), ("k",))})
    counts = lambda: [files.read_published(spark, folder, name).count() for name in ("a", "b")]
    assert counts() == [3, 3] and len(list((tmp_path / "out/versions").iterdir())) == 2
    with pytest.raises(Exception):  # noqa: B017
        files.publish(spark, folder, {"a": (table(9), ("k",)), "b": (table(9).select(F.raise_error(F.lit("killed")).alias("k")), ("k",))})
    assert counts() == [3, 3]
    monkeypatch.setattr(files, "swap_manifest", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        files.publish(spark, folder, {"a": (table(9), ("k",)), "b": (table(9), ("k",))})
    monkeypatch.undo()
    assert counts() == [3, 3]
    files.publish(spark, folder, {"a": (table(4), ("k",)), "b": (table(4), ("k",))})
    assert counts() == [4, 4] and len(list((tmp_path / "out/versions").iterdir())) == 2


def test_files(spark, tmp_path):
    registry = {"sources": [{"id": "a", "name": "A"}, {"id": "b", "enabled": False}], "optional_sources": [{"id": "c", "enabled": True}, {"id": "d"}]}
    (tmp_path / "registry.json").write_text(json.dumps(registry))
    read = lambda **k: sorted(r["id"] for r in files.read_registry(spark, str(tmp_path / "registry.json"), **k).collect())
    assert read() == ["a"] and read(include_optional=True) == ["a", "c"] and read(only=["x"]) == []
    record = dict.fromkeys(X.ENDPOINT_FIELDS, "v") | {"port": 1}
    (tmp_path / "list.json").write_text(json.dumps([record, record]))
    (tmp_path / "wrapped.json").write_text(json.dumps({"records": [record]}))
    assert [files.read_records(spark, str(tmp_path / n)).count() for n in ("list.json", "wrapped.json", "missing.json")] == [2, 1, 0]
    (tmp_path / "data").mkdir()
    (tmp_path / "data/x").write_text("")
    assert files.artifact_path(spark, str(tmp_path), "x").endswith("data/x") and files.artifact_path(spark, str(tmp_path), "y") == f"{tmp_path}/y"
    (tmp_path / "t.txt").write_text("stratum+tcp://a.example:1\nstratum+tcp://a.example:1")
    row = files.read_local_texts(spark, str(tmp_path / "t.txt")).first()
    assert row["path"].endswith("/t.txt") and row["text"].count("\n") == 1
    (tmp_path / "cache.json").write_text(json.dumps({"url": "u", "status": 200, "content_type": "t", "body": "é"}))
    assert bytes(files.read_pages(spark, str(tmp_path / "cache.json")).first()["body"]) == b"\xe9"


def test_stream(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "table")
    pages(spark).where("page_ord < 2").coalesce(1).write.parquet(str(source))
    stream = lambda: spark.readStream.schema(PAGES).parquet(str(source))
    assert crawl_stream.read_table(spark, table).count() == 0
    for _ in range(2):
        crawl_stream.start(stream(), table, str(tmp_path / "state"), "2026-04-17").awaitTermination()
        pages(spark).where("page_ord = 2").coalesce(1).write.mode("append").parquet(str(source))
    got = crawl_stream.read_table(spark, table)
    assert got.where("port = 3333").select("source_url").first()[0] == "; ".join(f"https://pool.example/{i}" for i in range(3))


def test_a_batch_rewrites_its_own_buckets_alone(spark, tmp_path):
    folder = tmp_path / "table"
    files_of = lambda: {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("part-*.parquet")}

    def batch(*hosts):
        rows = [(h, 1, *["x"] * (len(X.ENDPOINT_FIELDS) - 2), "site", 1) for h in hosts]
        names = [f"{f} {'int' if f == 'port' else 'string'}" for f in X.ENDPOINT_FIELDS]
        return spark.createDataFrame(rows, ", ".join([*names, "site string", "page_ord int"]))

    crawl_stream.merge_batch(spark, str(folder), batch(*[f"h{i}.example" for i in range(40)]), 0, buckets=8)
    first = files_of()
    crawl_stream.merge_batch(spark, str(folder), batch("h0.example", "new.example"), 1)
    second = files_of()
    assert first.items() <= second.items() and 1 <= len(second) - len(first) <= 2
    crawl_stream.merge_batch(spark, str(folder), batch("h0.example"), 1)  # run again after a restart
    assert files_of() == second and crawl_stream.read_table(spark, str(folder)).count() == 41
    crawl_stream.merge_batch(spark, str(folder), batch("h0.example"), 2)
    third = files_of()
    assert 1 <= len(first.keys() - third.keys()) <= 2 and crawl_stream.read_table(spark, str(folder)).count() == 41
    crawl_stream.merge_batch(spark, str(folder), batch(), 3)
    assert crawl_stream.read_table(spark, str(folder)).count() == 41


def test_fetch_stream_equals_the_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(run, f"s{rng.randint(0, 6)}", rng.random() < 0.5, run * 100 + i) for run in range(9) for i in range(12)]
    schema = "run int, source_id string, ok boolean, ord int"
    for runs in ((0, 1, 2), (3,), (4, 5), (6, 7, 8)):
        # The runs of a batch come in any order.
        some = [r for r in rows if r[0] in runs]
        rng.shuffle(some)
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    told = {}
    keep = lambda frame, _: told.update({(r["source_id"], r["run"]): (r["taken"], r["used_cache"]) for r in frame.collect()})
    fetch_stream.last_good_runs(stream).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    fetches = spark.createDataFrame(rows, schema)
    records = fetches.where("ok").select("source_id", "run").distinct()
    want = {}
    for run in range(9):
        for r in metrics.last_good_records(fetches, records, run).collect():
            want[r["source_id"], run] = (r["run"], r["used_cache"])
    assert {k: v for k, v in told.items() if v[0] is not None} == want
    assert all(not used for taken, used in told.values() if taken is None)


def test_contract(spark, sf_dir):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name in ("extract_site_endpoints", "unique_ranked", "retire_stale"):
        assert entry.queries()[name](spark, sf_dir).where(F.lit(True)).count() > 0


def test_oracles(spark, sf_dir):
    import duckdb

    from gridloom.oracles import ORACLES
    from gridloom.queries import QUERIES

    db = duckdb.connect()
    for table in ("events", "pages", "documents", "supplier"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    for name in ("normalize_record", "unique_first", "extract_site_endpoints", "page_links", "merge_existing"):
        got = QUERIES[name](spark, sf_dir)
        want = db.sql(ORACLES[name])
        columns = sorted(want.columns)
        assert columns == sorted(got.columns)
        mine = sorted(str(tuple(r)) for r in got.select(*columns).collect())
        assert mine == sorted(str(r) for r in want.select(*columns).fetchall()), name
