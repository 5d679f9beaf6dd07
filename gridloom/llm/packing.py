"""Best-fit packing of tokenised documents into sequences of a fixed capacity, in bulk-synchronous rounds.

Documents and gaps are rows of tables. A round puts both in one order, the largest first and gaps before documents of
their size, and cuts it into ranges. Each task sweeps a range: a document takes its successor, the smallest gap that
holds it, and what is left of the gap goes back into the order. Documents that found no gap in their range take those
left in higher ranges: of all that want them, which document gets which gap follows from ranks alone, counted per range as
in matching brackets, so no gap is given twice. Gaps are updated, and the next round begins with the
documents that are left. When nothing fits any more, new sequences are opened for the documents left.

Larger documents go first: those over half the capacity open a sequence each, then the others down to a quarter are placed,
then the rest. Ids and lengths travel, never texts; the driver sees a few numbers per range.
"""

from __future__ import annotations

import heapq
import struct
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, shared_checkpoint, text_of

#: Words whose ids a Python worker keeps, in each of two generations, and parts of words.
KEPT_WORDS = 500_000
#: Documents and gaps that a task sweeps, on average.
RANGE_ROWS = 100_000
#: Documents longer than capacity / level are placed before shorter ones.
LEVELS = (2, 4)

SWEPT = "part int, kind int, id long, size long, slot long, sequence long, offset long"
GAP, DOCUMENT, PLACED = 0, 1, 2


class Sweep:
    """Best fit over rows that come the largest first, gaps before documents of their size."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.open: list[tuple[int, int]] = []  # (size, sequence), the smallest last; each holds the next document
        self.rest: list[tuple[int, int]] = []  # (-size, sequence) of what is left of gaps, too small so far
        self.last = 0

    def _until(self, size: int) -> None:
        self.last = size
        while self.rest and -self.rest[0][0] >= size:
            left, sequence = heapq.heappop(self.rest)
            self.open.append((-left, sequence))

    def gap(self, size: int, sequence: int) -> None:
        self._until(size)
        self.open.append((size, sequence))

    def document(self, size: int) -> tuple[int, int] | None:
        """(sequence, offset) of a document, or None where no gap holds it."""
        self._until(size)
        if not self.open:
            return None
        gap, sequence = self.open.pop()
        if gap - size >= size:
            self.open.append((gap - size, sequence))
        elif gap > size:
            heapq.heappush(self.rest, (size - gap, sequence))
        return sequence, self.capacity - gap

    def left(self) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
        """Gaps left, the largest first: those that hold any later document, and smaller ones."""
        self._until(self.last)
        return self.open, [(-size, sequence) for size, sequence in sorted(self.rest)]


def brackets(ranges: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Which left documents take which left gaps of higher ranges, by rank.

    ``ranges`` has (range, documents left, largest of them, gaps left, smallest of them) in order. A run of documents
    of ``part`` with slots from ``first`` to before ``end`` takes gaps of range ``other`` from slot ``top`` downwards, ``each``
    documents a gap: returns (part, first, end, other, top, each).
    """
    runs, stack = [], []
    for part, documents, longest, gaps, smallest in ranges:
        slot = 0
        while slot < documents and stack:
            other, top, size = stack.pop()
            each = size // longest
            used = min(top + 1, -(-(documents - slot) // each))
            end = min(documents, slot + used * each)
            runs.append((part, slot, end, other, top, each))
            slot = end
            if used <= top:
                stack.append((other, top - used, size))
        if gaps:
            stack.append((part, gaps - 1, smallest))
    return runs


class WordIds:
    """Ids of words between white space, as little-endian 32-bit bytes.

    Where the tokenizer lower-cases and cuts words into runs of letters and runs of punctuation, a word that is letters and
    then punctuation is its two parts: the letters go straight to the tokenizer's BPE model, the few endings there are
    through the whole tokenizer. Any other word goes through the whole tokenizer. The string of a special token in a text
    is that token, as by the library's default.
    """

    # The steps of such a tokenizer, and the endings that no rule of its pattern joins with letters.
    NORMALIZER = ("NFC", "Replace", "Lowercase")
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    ENDINGS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, tokenizer_file: str):
        import json

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_file)
        steps = json.loads(self.whole.to_str())
        cut = (steps["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.split = (
            tuple(x["type"] for x in (steps["normalizer"] or {}).get("normalizers", [])) == self.NORMALIZER
            and [x.get("type") for x in cut] == ["Split", "ByteLevel"]
            and cut[0]["pattern"].get("Regex") == self.PATTERN
            and not cut[1]["add_prefix_space"]
        )
        self.model, self.bytes_of = self.whole.model, {}
        self.parts: dict[str, bytes] = {}

    def _packed(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _letters(self, word: str) -> bytes:
        from tokenizers.pre_tokenizers import ByteLevel

        if not word.isascii():  # the characters that stand for its bytes
            for c in word:
                if c not in self.bytes_of:
                    self.bytes_of[c] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
            word = "".join([self.bytes_of[c] for c in word])
        return self._packed([t.id for t in self.model.tokenize(word)])

    def _part(self, part: str, find) -> bytes:
        if (found := self.parts.get(part)) is None:
            if len(self.parts) > KEPT_WORDS:
                self.parts.clear()
            found = self.parts[part] = find(part)
        return found

    def _through(self, word: str) -> bytes:
        return self._packed(self.whole.encode(word, add_special_tokens=False).ids)

    def of(self, word: str) -> bytes:
        import unicodedata

        core = word.rstrip(self.ENDINGS)
        if not (self.split and core.isalpha() and "Σ" not in core and (core.isascii() or unicodedata.is_normalized("NFC", core))):
            return self._through(word)
        low = core.lower()
        if not low.isalpha():
            return self._through(word)
        ending = word[len(core) :]
        return self._part(low, self._letters) + (self._part(ending, self._through) if ending else b"")


class KnownWords:
    """Ids of words, with those of the words seen last kept: two generations, so that what is still used outlives a full one."""

    def __init__(self, tokenizer_file: str):
        self.ids = WordIds(tokenizer_file)
        self.kept: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def joined(self, text: str) -> bytes:
        """Ids of the words of a text between spaces and line ends."""
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.kept.get, words))
        if None in found:
            if len(self.kept) > KEPT_WORDS:
                self.kept, self.old = {"": b""}, self.kept
            for i, x in enumerate(found):
                if x is None:
                    w = words[i]
                    if (x := self.kept.get(w)) is None:
                        x = self.kept[w] = self.old[w] if w in self.old else self.ids.of(w)
                    found[i] = x
        return b"".join(found)


_known: dict[str, tuple[tuple[int, int], KnownWords]] = {}


def known_words(tokenizer_file: str) -> KnownWords:
    """The words of a tokenizer that this Python worker keeps from task to task; a file that has changed begins anew."""
    import os

    at = os.stat(tokenizer_file)
    version = (at.st_size, at.st_mtime_ns)
    if tokenizer_file not in _known or _known[tokenizer_file][0] != version:
        _known.clear()  # one tokenizer's words at a time
        _known[tokenizer_file] = version, KnownWords(tokenizer_file)
    return _known[tokenizer_file][1]


#: Texts that show whether a tokenizer sees spaces and line ends as borders.
PROBES = ("a b", "word another", " lead", "trail ", "two  spaces", "line\nend", "1 2", "a, b! c", "ünï cödé", "don't stop 'tis")


def require_borders(tokenizer_file: str) -> None:
    """Raise unless the ids of a text are those of its words between spaces and line ends, as they are not where tokens hold the space."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    for probe in PROBES:
        if ids(probe) != [i for word in probe.replace("\n", " ").split(" ") for i in ids(word)]:
            raise ValueError(f"{tokenizer_file} does not split texts at white space: {probe!r} has other ids than its words")


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32.

    A document is its ids and ``end_id``; only longer ones are cut. Null text counts as empty (one piece
    that holds ``end_id``). Words between spaces and line ends go through the tokenizer once a Python worker, while they are kept; a tokenizer that does
    not see white space as a border is refused.
    """
    require_borders(tokenizer_file)
    import pyarrow as pa

    def cut(batches):
        import os
        import zlib

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        known = known_words(tokenizer_file)
        end = end_id.to_bytes(4, "little")
        for batch in bounded(batches):
            out: list[list] = [[], [], [], [], []]
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, text in zip(ids, texts, strict=True):
                whole = known.joined(text) + end
                for piece, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _sweep(rows: DataFrame, capacity: int, n_rows: int) -> DataFrame:
    """Documents and gaps (kind, id, size) after a sweep of each range: placed documents, and what is left with its slot in its range.

    Slots count documents left, and gaps that hold any document of a later range; other gaps have none.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    def swept(batches):
        part, sweep, waiting = TaskContext.get().partitionId(), Sweep(capacity), 0

        def table(found):
            columns = list(zip(*found, strict=True)) or [()] * 6
            kinds = [pa.int32()] + [pa.int64()] * 5
            arrays = [pa.array([part] * len(found), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "kind", "id", "size", "slot", "sequence", "offset"])

        for batch in batches:
            found = []
            for kind, i, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kind == GAP:
                    sweep.gap(size, i)
                elif place := sweep.document(size):
                    found.append((PLACED, i, size, None, *place))
                else:
                    found.append((DOCUMENT, i, size, waiting, None, None))
                    waiting += 1
            yield table(found)
        whole, small = sweep.left()
        left = [(GAP, i, size, slot, None, None) for slot, (size, i) in enumerate(whole)] + [(GAP, i, size, None, None, None) for size, i in small]
        for at in range(0, len(left), 10_000):
            yield table(left[at : at + 10_000])

    # Rows of one size are spread over ranges by a hash of their id.
    mixed = rows.select("kind", "id", "size", (-F.col("size")).alias("_low"), F.xxhash64("id").alias("_mix"))
    ranges = mixed.repartitionByRange(max(1, -(-n_rows // RANGE_ROWS)), "_low", "_mix")
    return ranges.sortWithinPartitions("_low", "kind", "_mix").select("kind", "id", "size").mapInArrow(swept, SWEPT)


def _round(rows: DataFrame, capacity: int, n_rows: int) -> tuple[list[DataFrame], DataFrame, int, int]:
    """(placed documents, documents and gaps left, documents placed, documents left) of one round over ``rows`` (kind, id, size)."""
    spark, c = rows.sparkSession, F.col
    swept = shared_checkpoint(_sweep(rows, capacity, n_rows))
    waiting, able = c("kind") == DOCUMENT, (c("kind") == GAP) & c("slot").isNotNull()
    # A few numbers per range come to the driver.
    counts = swept.groupBy("part").agg(
        F.count_if(waiting).alias("documents"), F.max(F.when(waiting, c("size"))).alias("longest"), F.count_if(able).alias("gaps"),
        F.min(F.when(able, c("size"))).alias("smallest"), F.count_if(c("kind") == PLACED).alias("placed"),
    ).collect()
    placed, left = sum(r["placed"] for r in counts), sum(r["documents"] for r in counts)
    done = [swept.where(c("kind") == PLACED).select("id", "sequence", "offset")]
    runs = brackets([(r["part"], r["documents"], r["longest"], r["gaps"], r["smallest"]) for r in sorted(counts, key=lambda r: r["part"])])
    rest = swept.where(c("kind") != PLACED)
    if not runs:
        return done, rest.select("kind", "id", "size"), placed, left
    # Not more than two rows per range.
    taken = spark.createDataFrame(runs, "part int, first long, end long, other int, top long, each long")
    taken = F.broadcast(taken.select("part", "first", "end", "other", "top", "each"))
    documents = rest.where(waiting).join(taken, "part").where((c("slot") >= c("first")) & (c("slot") < c("end")))
    documents = documents.select("id", "size", "slot", c("other").alias("part"), F.expr("top - (slot - first) div each").alias("gap"))
    gaps = rest.where(able).select("part", c("slot").alias("gap"), c("id").alias("sequence"), c("size").alias("room"))
    before = Window.partitionBy("part", "gap").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("size").over(before), F.lit(0))
    matched = documents.join(gaps, ["part", "gap"]).select("id", "size", "sequence", (F.lit(capacity) - c("room") + used).alias("offset"))
    matched = shared_checkpoint(matched)
    done.append(matched.select("id", "sequence", "offset"))
    moved = sum(end - first for _, first, end, *_ in runs)
    highest = {part: end for part, _, end, *_ in runs}
    until = F.broadcast(spark.createDataFrame(list(highest.items()), "part int, until long"))
    documents = rest.where(waiting).join(until, "part", "left").where(c("until").isNull() | (c("slot") >= c("until")))
    filled = matched.groupBy(c("sequence").alias("id")).agg(F.sum("size").alias("filled"))
    gaps = rest.where(c("kind") == GAP).join(filled, "id", "left").withColumn("size", c("size") - F.coalesce("filled", F.lit(0))).where("size > 0")
    return done, documents.select("kind", "id", "size").unionByName(gaps.select("kind", "id", "size")), placed + moved, left - moved


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``, and a number ``_id`` of its own per row) with sequence_id and offset.

    Sequences are gapless from offset 0; their ids are any numbers. ``_id`` goes.
    """
    spark, c = pieces.sparkSession, F.col
    documents = pieces.select(F.lit(DOCUMENT).alias("kind"), c("_id").alias("id"), c("length").alias("size"))
    large = documents.where(c("size") > capacity // LEVELS[0])
    placed = [large.select("id", c("id").alias("sequence"), F.lit(0).cast("long").alias("offset"))]
    gaps = large.select(F.lit(GAP).alias("kind"), "id", (F.lit(capacity) - c("size")).alias("size")).where("size > 0")
    opened = 0
    for above, upto in zip((*(capacity // level for level in LEVELS[1:]), 0), (capacity // level for level in LEVELS), strict=True):
        new = documents.where((c("size") > above) & (c("size") <= upto))
        rows = new.unionByName(gaps)
        left, n_rows = new.count(), rows.count()
        while left:
            done, rows, moved, left = _round(rows, capacity, n_rows)
            placed += done
            if left and not moved:
                # Nothing fits: as many new sequences as the documents left fill if each lies among its like.
                need = rows.where(c("kind") == DOCUMENT).agg(F.sum(1 / F.floor(F.lit(capacity) / c("size")))).first()[0]
                n = max(1, -int(-need // 1))
                rows = rows.unionByName(spark.range(n).select(F.lit(GAP).alias("kind"), (-c("id") - 1 - opened).alias("id"), F.lit(capacity).cast("long").alias("size")))
                opened += n
                n_rows += n
        gaps = rows.where(c("kind") == GAP)
    found = reduce(DataFrame.unionByName, placed).select(c("id").alias("_id"), c("sequence").alias("sequence_id"), "offset")
    return pieces.join(found, "_id").drop("_id")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are packed as the end id alone; repeated rows and null ids each take their own
    place; an empty table gives an empty table; other columns are not looked at. Texts are read and
    tokenised once; what is sorted are narrow rows of pieces.
    """
    pieces = token_pieces(docs, tokenizer_file, capacity, end_id).withColumn("_id", F.monotonically_increasing_id())
    return pack(shared_checkpoint(pieces), capacity)
