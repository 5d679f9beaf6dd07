"""Profiles and floors come from all labelled rows."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string"


def learned(monkeypatch, f, docs):
    from gridloom.llm import language as L

    seen, real = [], L.predict
    monkeypatch.setattr(L, "predict", lambda profiles, *a: seen.append(profiles) or real(profiles, *a))
    f(docs)
    return seen[0]


def test_profiles_are_learned_from_all_labelled_rows(spark, monkeypatch):
    from gridloom.llm import language as L

    docs = spark.createDataFrame([(i, chr(0x4E00 + i) * 3, "xx") for i in range(1300)] + [(5000, "abc", None)], SCHEMA).repartition(3)
    # The letter of a text occurs three times and all else less often: the first 400 letters of all rows, not of a sample.
    assert learned(monkeypatch, L.keep_known_languages, docs)["xx"] == [0x4E00 + i for i in range(400)]
    fitted = docs.where(~L.held_out_row(F.col("doc_id"))).where("lang is not null").select(F.ascii("text")).collect()
    assert learned(monkeypatch, L.identify, docs)["xx"] == sorted(r[0] for r in fitted)[:400]


def test_floor_is_that_of_the_lowest_of_all_rows(spark):
    from gridloom.llm import language as L

    common = "the cat sat on the mat and the dog "
    odd = "zzyx qqvk " * 3 + "the"
    for at in (3, 700, 1500, 2200):
        rows = [(i, odd if i == at else common * (1 + i % 3) + f"word{i}", "en") for i in range(2300)]
        kept = {r["doc_id"] for r in L.keep_known_languages(spark.createDataFrame(rows, SCHEMA)).select("doc_id").collect()}
        assert len(kept) == 2300
