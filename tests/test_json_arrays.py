"""JSON arrays of many splits, and published versions."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from gridloom.sources import json_arrays

SCHEMA = "a string, n long, inner struct<x: string, list: array<struct<y: string>>>"


def schema():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(SCHEMA)


def objects(rng, n):
    text = lambda: "".join(rng.choice('ab{}[]",:\\\n é😀/') for _ in range(rng.randint(0, 12)))
    return [{"a": text(), "n": i, "inner": {"x": text(), "list": [{"y": text()} for _ in range(rng.randint(0, 3))]}} for i in range(n)]


def shown(rows):
    return sorted((r["n"], r["a"], r["inner"] and (r["inner"]["x"], [y["y"] for y in r["inner"]["list"]])) for r in rows)


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [77, 1 << 20])
def test_an_array_of_several_splits(spark, tmp_path, small_splits, indent, size):
    rng = random.Random(size)
    rows = objects(rng, 60)
    mixed = [*rows[:30], None, 3, "{not an object}", ["{", {"n": -1}], True, *rows[30:]]
    (tmp_path / "a.json").write_text(json.dumps(mixed, indent=indent, ensure_ascii=bool(indent)))
    small_splits(size)
    read = json_arrays.read_json_array(spark, str(tmp_path / "a.json"), schema())
    if size < 1000:
        assert spark.read.option("lineSep", "}").text(str(tmp_path / "a.json")).rdd.getNumPartitions() > 3
    assert shown(read.collect()) == shown(rows)


def test_parts_and_odd_files(spark, tmp_path, small_splits):
    rows = objects(random.Random(1), 30)
    text = json.dumps(rows, ensure_ascii=False)
    for size in (150, 1 << 20):
        small_splits(size)
        folder = tmp_path / f"parts{size}"
        folder.mkdir()
        for i in range(4):
            (folder / f"part-{i}").write_text(text[i * len(text) // 4 : (i + 1) * len(text) // 4])
        assert shown(json_arrays.read_json_array(spark, str(folder), schema()).collect()) == shown(rows)
        for name, body in (("empty", "[]"), ("nothing", ""), ("space", " \n[ ]\n"), ("one", json.dumps(rows[:1]) + "\n")):
            (tmp_path / f"{name}.json").write_text(body)
            assert json_arrays.read_json_array(spark, str(tmp_path / f"{name}.json"), schema()).count() == (name == "one")


def test_written_parts_make_one_array_and_one_csv(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice(['plain', 'a "quoted", one', "two\nlines", "é", ""]), None if i % 7 == 0 else i) for i in range(500)]
    spark.createDataFrame(rows, "k int, t string, v int").repartition(5).orderBy("k").write.parquet(str(tmp_path / "t"))
    for name, stored in (("full", spark.read.parquet(str(tmp_path / "t"))), ("none", spark.read.parquet(str(tmp_path / "t")).where("false"))):
        json_arrays.write_json_array(stored, str(tmp_path / f"{name}.json"), ("k", "t", "v"))
        json_arrays.write_csv_document(stored, str(tmp_path / f"{name}.csv"), ("k", "t", "v"))
        whole = lambda kind, name=name: "".join(p.read_text() for p in sorted((tmp_path / f"{name}.{kind}").glob("part-*")))
        want = rows if name == "full" else []
        assert [tuple(r.values()) for r in json.loads(whole("json"))] == want
        header, *lines = csv.reader(whole("csv").splitlines(keepends=True))
        assert header == ["k", "t", "v"] and [(int(a), b, int(c) if c else None) for a, b, c in lines] == want
    back = json_arrays.read_json_array(spark, str(tmp_path / "full.json"), spark.read.parquet(str(tmp_path / "t")).schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == rows and back.where(F.col("v").isNull()).count() == 72
