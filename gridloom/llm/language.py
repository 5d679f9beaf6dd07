"""Language ID by rank-order n-gram profiles.

A profile ranks the most frequent letter n-grams (1 to 3 letters, words padded) of all labelled texts of a language.
A document ranks its own most frequent n-grams; its distance to a language sums how far each is out of place,
with the profile's length for one that the profile lacks, and the nearest language is the answer.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, text_of

#: Labelled rows of each language in a ``fit_sample``; the queries and the pipeline learn from all rows.
FIT_ROWS = 500
#: Bytes of texts whose n-grams a task counts together.
COUNTED_BYTES = 4 << 20
#: N-grams in a language's profile, and in a document's.
PROFILE_SIZE = 400
#: A text is in a language only if its score is at least this share of the lowest of the rows that the language was learned from.
FLOOR_SHARE = 0.8
UNKNOWN = "und"
PAD, BITS = 1, 21

_folded = None


def folded_letters():
    """For each code point, its lower-case letter, or the pad where it is no letter."""
    global _folded
    if _folded is None:
        import unicodedata

        import numpy as np

        _folded = np.full(0x110000, PAD, np.int64)
        for c in range(0x110000):
            if unicodedata.category(x := chr(c))[0] == "L":
                _folded[c] = ord(x.lower()) if len(x.lower()) == 1 else c
    return _folded


def ngrams(text: str):
    """(n-grams as integers, their counts) of a text, over letters alone; empty where there is no letter."""
    import numpy as np

    code = folded_letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    code = np.concatenate([[PAD], code, [PAD]])
    code = code[np.r_[True, (code[1:] != PAD) | (code[:-1] != PAD)]]
    if len(code) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    two = (code[:-1] << BITS) | code[1:]
    three = (two[:-1] << BITS) | code[2:]
    return np.unique(np.concatenate([code[code != PAD], two, three[code[1:-1] != PAD]]), return_counts=True)


def ranked(grams, counts, size: int):
    """The most frequent n-grams first; ties by the n-gram itself."""
    import numpy as np

    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:size]]


def held_out_row(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit_sample(docs: DataFrame, rows_per_language: int = FIT_ROWS) -> DataFrame:
    """(lang, text) of at most ``rows_per_language`` different rows of each lang of ``docs`` (doc_id, text, lang), those whose id and text hash lowest.

    Ids alone would not do: rows that share one, or have none, would all be in the sample or none of them, and their language might be lost. Rows
    that share the text too count once, and the lowest hash of a language is always in.
    """
    labelled = docs.where(F.col("lang").isNotNull()).select("doc_id", "lang", text_of().alias("text"))
    labelled = labelled.withColumn("_hash", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("_hash").alias("lowest"))
    known = {r["lang"]: (r["n"], r["lowest"]) for r in counts.collect()}
    # Twice the share that is needed, by hash, then the lowest of those: a few rows of each language move, whatever its size.
    scale = 1 << 40
    shares = docs.sparkSession.createDataFrame(
        [(k, max(lowest + 1, min(scale, 2 * (rows_per_language + 10) * scale // n))) for k, (n, lowest) in known.items()], "lang string, share long"
    )
    lowest = Window.partitionBy("lang").orderBy("_hash", "doc_id", "text")
    return (
        labelled.join(F.broadcast(shares), "lang")
        .where(F.col("_hash") < F.col("share"))
        .dropDuplicates(["lang", "_hash"])
        .withColumn("_place", F.row_number().over(lowest))
        .where(F.col("_place") <= rows_per_language)
        .select("lang", "text")
    )


def labelled_rows(docs: DataFrame) -> DataFrame:
    """(lang, text) of every row of ``docs`` that has a lang."""
    return docs.where(F.col("lang").isNotNull()).select("lang", text_of().alias("text"))


def learn_profiles(labelled: DataFrame, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """N-grams of each language, most frequent first, counted over all rows of ``labelled`` (lang, text).

    Tasks sum the counts of a part of a batch before they are shuffled; what comes to the driver is bound by ``size`` and the number of languages.
    """
    import pyarrow as pa

    def count(batches):
        import numpy as np

        for batch in bounded(batches, COUNTED_BYTES):
            found: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, []).append(ngrams(text))
            for lang, each in found.items():
                grams, at = np.unique(np.concatenate([g for g, _ in each]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in each]), len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        labelled.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= size)
    )
    profiles: dict[str, list[int]] = {}
    for r in sorted(top.select("lang", "rank", "gram").collect()):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


def predict(profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
    """A function of a text column: struct of lang_pred and score (1: in place throughout, 0: nothing in common).

    It is marked as not to be evaluated again: otherwise a filter on its result would copy it into the scan's stage, and each
    text would be read twice, by two Python workers a task.
    """
    import numpy as np

    languages = sorted(profiles)
    vocabulary = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
    place = np.full((len(languages), len(vocabulary) + 1), -1, np.int32)
    for i, lang in enumerate(languages):
        place[i, np.searchsorted(vocabulary, profiles[lang])] = np.arange(len(profiles[lang]))

    def nearest(text: str) -> tuple[str, float]:
        own = ranked(*ngrams(text), size) if text else ()
        if not len(own) or not languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(vocabulary, own)
        at[(at == len(vocabulary)) | (vocabulary[np.minimum(at, len(vocabulary) - 1)] != own)] = len(vocabulary)
        theirs = place[:, at]
        distance = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(distance))
        return languages[best], float(1 - min(1.0, distance[best] / (size * len(own))))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([nearest(t) for t in texts], columns=["lang_pred", "score"])

    return predicted.asNondeterministic()


def floors(labelled: DataFrame, predicted, share: float = FLOOR_SHARE) -> dict[str, float]:
    """For each language ``share`` of the lowest score of the rows of ``labelled`` (lang, text) that are told to be in it; one number a language."""
    scored = labelled.select("lang", predicted("text").alias("found")).where(F.col("found.lang_pred") == F.col("lang"))
    return {r["lang"]: share * r["low"] for r in scored.groupBy("lang").agg(F.min("found.score").alias("low")).collect()}


def identify(docs: DataFrame) -> DataFrame:
    """The language of every whole text: doc_id, held_out, lang_pred, score.

    Profiles are learned from all labelled rows whose crc32(doc_id) mod 4 is not 2; the others are held out. A text that
    is null or has no letter is ``und`` with score 0, and so is every text where there is nothing to learn
    from; ties go to the language that sorts first. Repeated rows are treated alike, a null doc_id
    hashes as the empty text, an empty table gives an empty table, other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    predicted = predict(learn_profiles(labelled_rows(rows.where(~held_out_row(F.col("doc_id"))))))
    found = rows.select("doc_id", held_out_row(F.col("doc_id")).alias("held_out"), predicted(text_of()).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def keep_known_languages(docs: DataFrame, share: float = FLOOR_SHARE) -> DataFrame:
    """``docs`` without the documents whose language cannot be told, and with the language of those that had none.

    A document goes if it is ``und``, or if its score is below the floor of its language: then it is junk, or in a language that
    was not learned. Profiles and floors come from all labelled rows. Where no row has a lang nothing is learned, and all go. A lang that is there stays; a null one becomes
    the predicted one.
    """
    columns = docs.columns
    labelled = labelled_rows(docs)
    predicted = predict(learn_profiles(labelled))
    low = F.create_map(*[F.lit(x) for pair in floors(labelled, predicted, share).items() for x in pair]).cast("map<string,double>")
    found = docs.withColumn("_found", predicted(text_of()))
    kept = found.where((F.col("_found.lang_pred") != UNKNOWN) & (F.col("_found.score") >= F.coalesce(F.try_element_at(low, F.col("_found.lang_pred")), F.lit(0.0))))
    return kept.withColumn("lang", F.coalesce("lang", "_found.lang_pred")).select(*columns)
