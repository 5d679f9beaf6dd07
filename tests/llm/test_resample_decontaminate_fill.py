"""Resampling, decontamination and fill-in-middle against brute force, with nulls, long texts, repeated rows, ties and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OTHERS = ("words", "bucket", "_row", "hits", "n", "form", "rank", "place", "batch")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in OTHERS)


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def random_texts(seed, rows=120):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "GAMMA", "Ünï", "İstanbul", "中文", "x1", "7", "é", "ǅ", "the", "of"]
    ends = [" ", ", ", "\n", "--", "\x00", " 😀 ", "/"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(n))
    rows = [(i, text(rng.choice([0, 1, 2, 5, 19, 20, 21, 60]))) for i in range(rows)]
    return [*rows, (500, None), (501, ""), (502, " .. "), (503, text(9000)), (None, text(30)), (None, text(30)), (7, rows[7][1]), (7, rows[8][1]), (504, "<P> marks of its own " * 9)]


@pytest.fixture(scope="module")
def texts():
    return random_texts(3)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *OTHERS) for i, t in texts], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "item_id long, text string, hash string, length string")


def same(rows, want):
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def brute_resample(texts, target, longest, buckets, least, percent, seed):
    def features(text):
        w = words_of(text)
        grams = [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
        return [zlib.crc32(g.encode()) % buckets for g in grams]

    s, t = Counter(b for _, x in texts for b in features(x)), Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    rows = []
    for i, x in texts:
        f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words_of(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return rows, order[: percent * len(order) // 100]


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(2, 10000, 25), (1, 50, 100), (3, 7, 40)])
def test_resample(spark, docs, texts, longest, buckets, percent):
    from gridloom.llm.importance import resample

    target = ["alpha beta gamma the of", None, "", "中文 é the the"]
    got = resample(docs, items_of(spark, enumerate(target)), longest, buckets, 20, percent, 7).collect()
    rows, drawn = brute_resample(texts, target, longest, buckets, 20, percent, 7)
    same([r[:5] for r in got], rows)
    ranked = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    key = lambda r: (-r[4], r[0] is not None, r[0] or 0)
    assert [key(r) for r in ranked] == [key(r) for r in drawn]


def test_resample_of_nothing(spark, docs, empty):
    from gridloom.llm.importance import resample

    target = items_of(spark, [(1, "alpha beta")])
    assert resample(empty, target).count() == 0
    assert all(r["weight"] <= 0 or r["n_features"] for r in resample(docs, target.limit(0)).collect())
    tied = docs.where("doc_id = 503").unionAll(docs.where("doc_id = 503"))
    assert sorted(r["rank"] or 0 for r in resample(tied, target, percent=50).collect()) == [0, 1]


def brute_overlaps(texts, items, length):
    windows = {}
    for i, x in items:
        w = words_of(x)
        n = min(len(w), length)
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, x in texts:
        w, hit, owners = words_of(x), set(), set()
        for n in {len(g) for g in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    owners |= windows[tuple(w[k : k + n])]
        ids = sorted(str(o) for o in owners if o is not None)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_overlaps(spark, docs, texts, block_bytes, monkeypatch):
    from gridloom.llm import decontaminate

    long = " ".join(words_of(texts[-6][1])[100:140])
    items = [(1, long), (2, long + " alpha"), (10, "x1 7"), (3, None), (4, " . "), (None, "the, of"), (5, "中文 é ÜNÏ"), (5, texts[7][1]), (6, "never seen words here at all in any of these texts")]
    monkeypatch.setattr(decontaminate.find_overlaps, "__defaults__", (10, block_bytes))
    for length in (10, 3):
        got = decontaminate.overlap_report(docs, items_of(spark, items), length).collect()
        same(got, brute_overlaps(texts, items, length))


def test_overlaps_of_nothing(spark, docs, empty, texts):
    from gridloom.llm.decontaminate import decontaminate, overlap_report

    items = items_of(spark, [(1, "alpha beta")])
    assert overlap_report(empty, items).count() == 0
    same(overlap_report(docs, items.limit(0)).collect(), brute_overlaps(texts, [], 10))
    assert decontaminate(docs, items.limit(0)).count() == len(texts)


def test_spans_and_documents_are_removed(spark, docs, texts):
    from gridloom.llm.decontaminate import decontaminate

    rows = [(1, "Keep this; one two three FOUR, five - and the end."), (1, "one two three four five"), (2, None), (3, "one two! three four five six one two three"), (4, "é one\ntwo three four five. ")]
    few = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *OTHERS) for i, t in rows], SCHEMA)
    items = items_of(spark, [(1, "two three four"), (2, "Three four five")])
    spans = decontaminate(few, items, 3, "spans").collect()
    same([(r["doc_id"], r["text"], r["n_chars"]) for r in spans], [(1, "Keep this; one - and the end.", 29), (1, "one", 3), (2, None, 0), (3, "one six one two three", 21), (4, "é one. ", 7)])
    assert [r["doc_id"] for r in decontaminate(few, items, 3).collect()] == [2]
    whole = decontaminate(docs, items_of(spark, [(1, "alpha beta")]), 2)
    assert whole.columns == docs.columns
    assert whole.count() == sum(not r[5] for r in brute_overlaps(texts, [(1, "alpha beta")], 2))
    with pytest.raises(ValueError):
        decontaminate(docs, items, 3, "words")


def test_decontamination_runs_no_python(spark, docs):
    from gridloom.llm.decontaminate import overlap_report

    plan = overlap_report(docs, items_of(spark, [(1, "alpha beta")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize(("seed", "percent", "spm"), [(1, 90, 20), (2, 100, 100), (3, 100, 0), (4, 0, 50)])
def test_fill_in_middle(docs, texts, seed, percent, spm):
    from gridloom.llm.fill_middle import fill_in_middle, restored

    want = []
    for i, text in texts:
        t = text or ""
        digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
        form = "plain" if not t or re.search("<[PSM]>", t) or h[2] % 100 >= percent else "spm" if h[3] % 100 < spm else "psm"
        output = {"plain": t, "psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}[form]
        counts = (None, None) if form == "plain" else (a, b - a)
        want.append((i, len(t), form, *counts, output, t))
    same(fill_in_middle(docs, seed, percent, spm).withColumn("back", restored(F.col("output"), F.col("form"))).collect(), want)


def test_fill_in_middle_restores_what_looks_like_marks(spark, empty):
    from gridloom.llm.fill_middle import fill_in_middle, restored

    assert fill_in_middle(empty).count() == 0
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("<PSM>>é") for _ in range(rng.randint(1, 9))), None, None, None, *OTHERS) for i in range(400)]
    cut = fill_in_middle(spark.createDataFrame(rows, SCHEMA), 5, 100, 50).withColumn("back", restored(F.col("output"), F.col("form")))
    same([(r["doc_id"], r["back"]) for r in cut.collect()], [(r[0], r[1]) for r in rows])
    with pytest.raises(ValueError):
        fill_in_middle(empty, marks=("<P>", "P>", "<M>"))
