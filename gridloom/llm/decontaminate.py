"""Benchmark decontamination: documents that hold word windows of test items, found by a broadcast hash set of the windows.

Column functions only. A document's words are cut once; each window of them is hashed in its row, exploded beside the row and looked
up among the hashed windows of the test items, which are sent to every task in blocks of a checked size. Hits are verified word by
word; then one shuffle, of the documents' keys and of the hits alone, gathers what a document has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import row_key, shared_checkpoint, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words: runs of ASCII letters and digits and of everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word as the text has it, upper case too, with what stands before it; and what stands after the last word.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+$"

#: Bytes of windows and item ids that are broadcast at once.
BLOCK_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """The words of a text, with A to Z, and nothing else, in lower case."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.regexp_extract_all(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER)), F.lit(WORD), F.lit(0))


def _starts(n_words: Column, length: int) -> Column:
    """The places at which a window of ``length`` words can begin."""
    return F.when(n_words >= length, F.sequence(F.lit(0), n_words - length)).otherwise(F.array().cast("array<int>"))


def _window_hash(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words, start + i) for i in range(length)])


def _window_hashes(words: Column, length: int) -> Column:
    return F.transform(_starts(F.size(words), length), lambda start: _window_hash(words, start, length))


def test_windows(items: DataFrame, length: int) -> DataFrame:
    """One row per distinct window of the test items: length, window (its words, joined by spaces), hash, ids (of the items that have it, as strings).

    An item of fewer words than ``length`` is one window, one without words none.
    """
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(text_of()).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(length))
    placed = words.select("item_id", "words", size.alias("length"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
    grams = placed.select("item_id", "length", F.slice("words", F.col("start") + 1, F.col("length")).alias("gram"))
    hashed = F.lit(None).cast("long")
    for k in range(1, length + 1):
        hashed = F.when(F.col("length") == k, _window_hash(F.col("gram"), F.lit(0), k)).otherwise(hashed)
    kept = grams.select("item_id", "length", F.array_join("gram", " ").alias("window"), hashed.alias("hash"))
    return kept.groupBy("length", "window", "hash").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))


def _found(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Documents with what they hold of ``windows``, which are broadcast: a row (_row, hit, ids) a hit, and one without a hit a document.

    Every window of a document is exploded beside its words, but in one stage with the lookup, so that nothing is copied for windows that
    are not found. After the windows comes one entry that no test window equals, which keeps the document where nothing is found; so the
    array is never empty, and the outer form of the generator only spares the filter that Spark would else compute all hashes for.
    """
    hashes = F.concat(*[_window_hashes(F.col("words"), k) for k in lengths], F.array(F.lit(None).cast("long")))
    each = docs.withColumn("n_words", F.size("words")).withColumn("_hashes", hashes)
    each = each.select("_row", "doc_id", "_doc", "_mark", "n_words", "words", F.posexplode_outer("_hashes").alias("_place", "hash"))
    start, before = F.lit(None).cast("int"), F.lit(0)
    for k in lengths:
        start = F.when(F.col("length") == k, F.col("_place") - before).otherwise(start)
        before = before + F.greatest(F.col("n_words") - (k - 1), F.lit(0))
    kept = each.withColumn("_last", before == F.col("_place"))
    looked_up = kept.join(F.broadcast(windows), "hash", "left")
    same = F.array_join(F.slice("words", start + 1, F.col("length")), " ") == F.col("window")
    hit = F.when(F.coalesce(same, F.lit(False)), F.struct(start.alias("start"), (start + F.col("length")).alias("end")))
    return looked_up.select("_row", "doc_id", "_doc", "_mark", "n_words", "_last", hit.alias("hit"), "ids").where("_last OR hit IS NOT NULL")


def _covered(hits: Column) -> Column:
    """How many words lie in any of the intervals ``hits``, sorted by their start."""
    step = lambda at, x: F.struct(
        (at["held"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], at["reach"]))).alias("held"), F.greatest(at["reach"], x["end"]).alias("reach")
    )
    return F.aggregate(hits, F.struct(F.lit(0).alias("held"), F.lit(0).alias("reach")), step, lambda at: at["held"])


def find_overlaps(docs: DataFrame, items: DataFrame, length: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a document: doc_id, n_words, hits, item_ids; and ``_doc``, ``_mark``, which tell rows apart that differ, whatever their ids.

    ``docs`` has doc_id and text, ``items`` item_id and text. ``hits`` are the sorted (start, end) of the occurrences of test windows, in words,
    end exclusive; ``item_ids`` the sorted distinct ids, as strings, of the items that own them. Windows of ``length`` words of an item
    count, and whole items of fewer. Null text has no words; items without an id have windows but are not listed; a document without an id
    and repeated rows are rows of their own; empty tables give no rows or no hits; other columns are not looked at.

    The windows are broadcast in blocks of about ``block_bytes`` by a count of their real size; the documents are scanned once a block.
    """
    windows = shared_checkpoint(test_windows(items, length))
    size = F.length("window") + F.coalesce(F.aggregate("ids", F.lit(0).cast("long"), lambda n, i: n + F.length(i) + 16), F.lit(0)) + 64
    lengths, total = windows.agg(F.array_sort(F.collect_set("length")), F.sum(size)).first()
    blocks = max(1, -(-(total or 0) // block_bytes))
    base = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), *[c.alias(k) for k, c in row_key().items()], words_of(text_of()).alias("words"))
    found = None
    for b in range(blocks):
        part = _found(base, windows.where(F.pmod("hash", F.lit(blocks)) == b), lengths)
        found = part if found is None else found.unionByName(part.where("hit IS NOT NULL"))
    gathered = found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("_doc").alias("_doc"),
        F.first("_mark").alias("_mark"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("hit").isNotNull(), F.col("ids")))))).alias("item_ids"),
    )
    return gathered.select("_doc", "_mark", "doc_id", F.col("n_words").cast("long").alias("n_words"), "hits", "item_ids")


def overlap_report(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; nulls, repeats and empty tables as in ``find_overlaps``."""
    found = find_overlaps(docs, items, length)
    n_hit = _covered(F.col("hits")).cast("long")
    listed = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), listed.alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def without_spans(text: Column, hits: Column) -> Column:
    """A text without the words that lie in ``hits``, and without what stands before each of them; the rest is as it was."""
    pieces = F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))
    between = lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a), "")
    more = lambda at, x: F.when(x["start"] > at["reach"], F.array(between(at["reach"], x["start"]))).otherwise(F.array().cast("array<string>"))
    step = lambda at, x: F.struct(F.concat(at["kept"], more(at, x)).alias("kept"), F.greatest(at["reach"], x["end"]).alias("reach"))
    start = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("reach"))
    return F.aggregate(hits, start, step, lambda at: F.concat(F.array_join(at["kept"], ""), between(at["reach"], F.size(pieces))))


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` (any columns) without what they hold of the test items: ``remove`` says whether whole ``documents`` go or only the ``spans``.

    Documents that hold nothing come back as they were, null texts among them. Where spans go, so does what stands before each of their words,
    and ``n_chars``, if there is one, is counted anew. Only keys and hits of documents that have any are joined with the texts.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    dirty = find_overlaps(docs, items, length).where(F.size("hits") > 0).select("_doc", "_mark", F.col("hits").alias("_hits")).dropDuplicates(["_doc", "_mark"])
    keyed = docs.withColumns(row_key())
    if remove == "documents":
        return keyed.join(dirty, ["_doc", "_mark"], "left_anti").select(*docs.columns)
    joined = keyed.join(dirty, ["_doc", "_mark"], "left")
    text = F.when(F.col("_hits").isNotNull(), without_spans(text_of(), F.col("_hits"))).otherwise(F.col("text"))
    changed = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("_hits").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)
