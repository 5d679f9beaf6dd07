"""Document fingerprints by one-permutation MinHash with optimal densification.

Every shingle is hashed once: the top bits name a bin, the bin keeps its least value. An empty bin takes the
value of another, found by hashing (bin, attempt) until a full bin is met, so that all bins are
uniform and independent of the order of bins. Values are then hashed with their bin, so that bins which hold
one value agree with another text's by chance one by one, not all together. A fingerprint packs the low bits of all
bins as hex; the share of equal bins, corrected for that chance, estimates the likeness of two texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, shuffle_partitions, text_of
from gridloom.llm.shingles import Shingler, mixed

WORDS, BIN_BITS, LOW_BITS = 5, 9, 4
#: Attempts that are tried together at first; a bin that finds no full one in them is looked up in the table of all attempts.
ATTEMPTS = 16


class Fingerprinter:
    def __init__(self, words: int = WORDS, bin_bits: int = BIN_BITS, low_bits: int = LOW_BITS):
        self.shingler, self.bin_bits, self.low_bits = Shingler(words), bin_bits, low_bits
        self.bins = 1 << bin_bits
        self.own = mixed(np.arange(1, self.bins + 1, dtype=np.uint64))
        self.first = self._tried(0)
        self.met: np.ndarray | None = None

    def _tried(self, turn: int) -> np.ndarray:
        """The bins that each bin tries in attempts ATTEMPTS * turn and on."""
        attempt = np.arange(ATTEMPTS * turn, ATTEMPTS * (turn + 1), dtype=np.uint64)
        seed = np.arange(self.bins, dtype=np.uint64)[:, None] * np.uint64(1_000_003) + attempt + np.uint64(1)
        return (mixed(mixed(seed)) >> np.uint64(64 - self.bin_bits)).astype(np.int64)

    def _met(self) -> np.ndarray:
        """The attempt in which each bin (row) first tries each other one: attempts go on until every bin has tried all."""
        if self.met is None:
            never = np.iinfo(np.int32).max
            met, turn = np.full((self.bins, self.bins), never, np.int32), 0
            rows = np.arange(self.bins)
            while (met == never).any():
                for k, tried in enumerate(self._tried(turn).T):
                    met[rows, tried] = np.minimum(met[rows, tried], ATTEMPTS * turn + k)
                turn += 1
            self.met = met
        return self.met

    def bins_of(self, text: str) -> np.ndarray | None:
        """The low bits of every bin, or None for a text without words."""
        hashes = self.shingler.shingles(text)
        if not len(hashes):
            return None
        hashes.sort()
        where = (hashes >> np.uint64(64 - self.bin_bits)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        value = np.zeros(self.bins, np.uint64)
        value[where[first]] = hashes[first]
        full = np.zeros(self.bins, bool)
        full[where[first]] = True
        empty = np.flatnonzero(~full)
        tried = self.first[empty]
        hit = full[tried]
        found = hit.any(axis=1)
        source = np.empty(len(empty), np.int64)
        source[found] = tried[found, hit[found].argmax(axis=1)]
        if not found.all():
            some = where[first]
            source[~found] = some[self._met()[np.ix_(empty[~found], some)].argmin(axis=1)]
        value[empty] = value[source]
        return (mixed(value + self.own) & np.uint64((1 << self.low_bits) - 1)).astype(np.uint8)

    def pack(self, low: np.ndarray | None) -> str:
        if low is None:
            return ""
        bits = np.unpackbits(low[:, None], axis=1)[:, 8 - self.low_bits :]
        return np.packbits(bits).tobytes().hex()

    def likeness(self, a: np.ndarray | None, b: np.ndarray | None) -> float:
        """Estimated share of common shingles; two texts without words are alike, one of them is unlike any other."""
        if a is None or b is None:
            return float(a is None and b is None)
        chance = 1 / (1 << self.low_bits)
        return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half (in code points, rounded down) replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_pairs(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, edited with the next document by descending doc_id.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. After the last
    document comes the first. Null text counts as empty; a text without words has the empty fingerprint; a null
    doc_id comes last; rows with one doc_id follow each other by text; an empty table gives an empty
    table; other columns are not looked at.

    Documents are cut into ranges of doc_id, and the first document of a range also goes to the range
    before it, so texts are shuffled once and a range is read as a stream that holds two rows.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    least = -(1 << 63)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    keys = rows.select(F.coalesce("doc_id", F.lit(least)).alias("key"))
    # Not more than a few numbers per range come to the driver.
    shares = [i / (4 * n) for i in range(1, 4 * n)]
    borders = np.unique(np.array(keys.agg(F.percentile_approx("key", shares, 10_000)).first()[0] or [], np.int64))

    def range_of(key):
        return len(borders) - np.searchsorted(borders, key, "left")

    @F.pandas_udf("int")
    def ranged(key: pd.Series) -> pd.Series:
        return pd.Series(range_of(key.to_numpy()))

    heads = sorted(keys.groupBy(ranged("key").alias("range")).agg(F.max("key").alias("key")).collect())
    before = {h["key"]: heads[i - 1]["range"] for i, h in enumerate(heads)}

    @F.pandas_udf("int")
    def also(key: pd.Series) -> pd.Series:
        return key.map(before).astype("Int64")

    key = F.coalesce("doc_id", F.lit(least))
    places = rows.select("*", key.alias("key"), ranged(key).alias("own"), also(key).alias("also"))
    own = F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("also").alias("range"), F.lit(True).alias("guest"))
    dealt = (
        places.withColumn("place", F.explode(F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, guest))))
        .select("place.range", "place.guest", "key", "doc_id", "text")
        .repartition(n, "range")
        .sortWithinPartitions("range", "guest", F.desc("key"), "text")
        .select("range", "guest", "doc_id", "text")
    )
    fields = [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]

    def fingerprints(batches):
        import hashlib

        printer = Fingerprinter(words)
        held = None  # (range, doc_id, text, bins) of the row whose next one is awaited
        for batch in bounded(batches):
            out = []
            for span, is_guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                bins = printer.bins_of(text)
                if held and held[0] == span:
                    _, held_id, held_text, held_bins = held
                    edited = edited_text(held_text, text)
                    edited_bins = printer.bins_of(edited)
                    out.append((
                        held_id, len(held_text), hashlib.sha256(edited.encode()).hexdigest(), printer.pack(held_bins),
                        printer.pack(edited_bins), printer.likeness(held_bins, edited_bins), printer.likeness(held_bins, bins),
                    ))
                held = None if is_guest else (span, doc_id, text, bins)
            columns = list(zip(*out, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[f for f, _ in fields])

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(fingerprints, schema)
