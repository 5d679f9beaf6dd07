"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if some string of ``length`` bytes that covers it also starts earlier (a smaller doc_id, or an earlier start in
the same document). Finding these strings takes four steps, and matches never cross documents. A row is known by its id and
the hash of its text (``doc``, ``mark``), so that rows without an id, or two texts under one id, are never taken for each other:

1. Every window of ``length`` bytes has an anchor, the leftmost of its k-grams with the least hash. Equal windows have equal
   anchors at equal places, so only windows whose anchor occurs more than once in the corpus can repeat.
2. Those windows are dealt by their anchor. The windows that one occurrence of an anchor owns start in a row, so they travel
   as one piece of text; pieces that are equal byte for byte need no search, the first of them is kept and the others
   are repeats throughout.
3. A task reads its pieces in the order of their anchors and holds a bounded run of whole anchors at a time, whose
   differing pieces are cut into shards. Each shard gets its own suffix order and Burrows-Wheeler transform; the
   transforms are merged by interleave refinement: round i orders the interleave by the first i symbols with one stable
   pass over the symbols that precede, and splits the intervals of suffixes that share i symbols. After ``length``
   rounds an interval of more than one suffix is a repeated string. Suffixes are not sorted again across shards.
   An anchor that occurs more than HOT times would make one large group. Its windows are not searched but dealt one by one, by
   a 128-bit hash of their bytes: windows that repeat within a chunk are settled there, so a window that a third of all
   documents share costs one row a chunk, and those that differ in every document spread over all tasks. A bitmap of
   fixed size tells hot anchors; one that it names by chance is treated like them, with the same result.
4. Repeated windows come back to their documents as byte ranges, and what they cover is cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, row_keys, shared_checkpoint, shuffle_partitions

LENGTH, GRAM = 100, 24
#: Windows that are ruled out together, by the bytes they share.
STEP = 12
#: An anchor that occurs more often has its windows dealt one by one, so many of them at a time.
HOT, HOT_WINDOWS = 2000, 1 << 18
#: Bits of the map that tells hot anchors.
HOT_BITS = 1 << 23
#: Symbols of one shard, and bytes of pieces that a task holds at a time (more only where one anchor has more).
SHARD_SYMBOLS, HELD_BYTES = 1 << 14, 32 << 20
#: Pieces and their bytes that are compared before they are dealt.
CUT_PIECES, CUT_BYTES = 200_000, 32 << 20
#: Bytes of a document that are looked at together; places are kept in 24 bits.
SLICE = 1 << 20

_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every place, by doubling."""
    base = 0x9E3779B97F4A7C15
    power = lambda n: np.uint64(pow(base, n, 1 << 64))
    run, width, out, done = _TABLE[data], 1, None, 0
    n = len(data) - GRAM + 1
    while True:
        if GRAM & width:
            out = run[:n] if out is None else out * power(width) + run[done : done + n]
            done += width
        if done == GRAM:
            break
        run = run[:-width] * power(width) + run[width:]
        width *= 2
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(29))


def anchors(text: bytes, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(hash, place, first window, last window) of each anchor, slice by slice; the windows that an anchor owns start in a row."""
    for at in range(0, max(1, len(text) - length + 1), SLICE):
        part = np.frombuffer(text, np.uint8, min(len(text) - at, SLICE + length - 1), at)
        if len(part) < length:
            return
        hashes = _gram_hashes(part)
        least = (hashes & ~np.uint64((1 << 24) - 1)) | np.arange(len(hashes), dtype=np.uint64)
        span, width, n = length - GRAM + 1, 1, len(part) - length + 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[span - width : span - width + n])
        place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        yield hashes[place[first]].astype(np.int64), place[first] + at, first + at, np.r_[first[1:] - 1, n - 1] + at


def suffix_order(text: np.ndarray, strings: int) -> np.ndarray:
    """Suffix order of a shard: ``text`` holds ``strings`` strings of symbols over 0, each closed by a 0 of its own."""
    ends, n = text == 0, len(text)
    rank = np.where(ends, np.cumsum(ends) - 1, strings + text.astype(np.int64))
    width = int(rank.max()) + 2
    step = 3 if width < 1 << 20 else 1
    key = rank
    for k in range(1, step):  # the first symbols together
        key = key * width
        key[:-k] += rank[k:] + 1
    while True:
        order = np.argsort(key)
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.r_[0, key[order[1:]] != key[order[:-1]]])
        if fresh[order[-1]] == n - 1 or step >= n:
            return order
        key = fresh * (n + 1)
        key[:-step] += fresh[step:] + 1
        step *= 2


def merged_intervals(shards: list[tuple[np.ndarray, int]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of each suffix in the shards' joined text, interval) in merged order; suffixes of an interval share ``depth`` symbols.

    ``shards`` are (text, strings) as ``suffix_order`` takes them, all of one unsigned type of at most 16 bits, which sorts by digits.
    """
    orders = [suffix_order(t, k) for t, k in shards]
    starts = np.cumsum([0, *(len(t) for t, _ in shards)])
    transforms = np.concatenate([t[o - 1] for (t, _), o in zip(shards, orders, strict=True)])  # a first symbol is preceded by an end
    shard = np.repeat(np.arange(len(shards), dtype=np.uint16), np.diff(starts))
    if len(shards) <= 256:
        shard = shard.astype(np.uint8)
    strings = sum(k for _, k in shards)
    closing = np.repeat(np.arange(len(shards), dtype=shard.dtype), [k for _, k in shards])
    interleave, interval = shard.copy(), np.zeros(len(shard), np.int32)
    symbol = np.empty(len(shard), transforms.dtype)
    edge = np.ones(len(shard), bool)
    for _ in range(depth):
        # Each shard's transform is read in its own order, wherever the interleave has put its rows.
        if len(shards) > 8:
            symbol[np.argsort(interleave, kind="stable")] = transforms
        else:
            for k, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
                symbol[interleave == k] = transforms[a:b]
        order = np.argsort(symbol, kind="stable")
        sorted_symbol, sorted_interval = symbol[order], interval[order]
        np.not_equal(sorted_symbol[1:], sorted_symbol[:-1], out=edge[1:])
        edge[1:] |= sorted_interval[1:] != sorted_interval[:-1]
        edge[:strings] = True  # ends of strings are all different, and lie in the order of their strings
        edge[strings : strings + 1] = True
        interleave = interleave[order]
        interleave[:strings] = closing
        interval = np.cumsum(edge, dtype=np.int32)
        if interval[-1] == len(interval):
            break
    place = np.empty(len(shard), np.int64)
    place[np.argsort(interleave, kind="stable")] = np.concatenate([o + s for o, s in zip(orders, starts[:-1], strict=True)])
    return place, interval


def repeated_windows(pieces: list[bytes], doc: np.ndarray, mark: np.ndarray, first: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(piece, offset) of the windows of ``pieces`` that an earlier one equals; a piece starts at ``first`` in its document."""
    # Two bytes make a symbol where the length is even: a piece is one string of symbols from each of its first two bytes.
    wide = 2 if length % 2 == 0 else 1
    strings = [p[k:] + b"\0" * (-len(p[k:]) % wide) for p in pieces for k in range(wide)]
    counts = np.array([len(x) // wide for x in strings], np.int64)
    seen, symbols = np.unique(np.frombuffer(b"".join(strings), f">u{wide}"), return_inverse=True)
    if len(seen) >= 1 << 16:
        raise ValueError("text in UTF-8 has fewer pairs of bytes")
    ends = np.cumsum(counts + 1) - 1
    coded = np.zeros(int(ends[-1]) + 1, np.uint16)
    coded[np.arange(len(symbols)) + np.repeat(np.arange(len(strings)), counts)] = symbols + 1
    cuts = np.unique(np.searchsorted(ends, np.arange(SHARD_SYMBOLS, len(coded), SHARD_SYMBOLS)) + 1)
    cuts = [0, *cuts[cuts < len(strings)].tolist(), len(strings)]
    shards = [(coded[(ends[a - 1] + 1 if a else 0) : ends[b - 1] + 1], b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    place, interval = merged_intervals(shards, length // wide)
    string = np.searchsorted(ends, place)
    piece, offset = string // wide, string % wide + wide * (place - (ends[string] - counts[string]))
    window = offset + length <= np.array([len(x) for x in pieces], np.int64)[piece]
    piece, offset, interval = piece[window], offset[window], interval[window]
    again = _again((interval,), doc[piece], mark[piece], first[piece] + offset)
    return piece[again], offset[again]


def _repeated_anchors(plain: DataFrame, length: int) -> DataFrame:
    """(doc, anchor) of the anchors that occur more than once in the corpus, and (null, anchor) of those that occur more than HOT times.

    What a batch sees more than once is settled there: its documents are told at once, and one row speaks for all of them in the
    count. So an anchor of a passage that a third of all documents share costs one row a batch.
    """
    import pyarrow as pa

    n, hot = shuffle_partitions(plain.sparkSession), HOT

    def seen(batches):
        for batch in bounded(batches):
            docs, found, times = [], [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for h, _, _, _ in anchors(text.encode(), length):
                    own, count = np.unique(h, return_counts=True)
                    docs.append(np.full(len(own), doc))
                    found.append(own)
                    times.append(count)
            if not found:
                continue
            anchor, doc, count = np.concatenate(found), np.concatenate(docs), np.concatenate(times)
            order = np.lexsort((doc, anchor))
            anchor, doc = anchor[order], doc[order]
            new = np.r_[True, anchor[1:] != anchor[:-1]]
            count = np.add.reduceat(count[order], np.flatnonzero(new))
            several = (count > 1)[np.cumsum(new) - 1]
            told = several & (new | np.r_[True, doc[1:] != doc[:-1]])
            out = (np.r_[anchor[told], anchor[new]], np.r_[doc[told], doc[new]], np.r_[np.zeros(told.sum(), np.int32), count.astype(np.int32)])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["anchor", "doc", "times"])

    def counted(batches):
        table = pa.Table.from_batches(b) if (b := list(batches)) else None
        if table is None:
            return
        anchor, doc, times = (table.column(c).to_numpy() for c in ("anchor", "doc", "times"))
        yield pa.RecordBatch.from_arrays([pa.array(doc[times == 0]), pa.array(anchor[times == 0])], names=["doc", "anchor"])
        anchor, doc, times = (x[times > 0] for x in (anchor, doc, times))
        if not len(anchor):
            return
        distinct, where = np.unique(anchor, return_inverse=True)
        count = np.bincount(where, times)
        # A row that stands for several has told its documents already; telling one again does no harm.
        told = count[where] > 1
        yield pa.RecordBatch.from_arrays([pa.array(doc[told]), pa.array(anchor[told])], names=["doc", "anchor"])
        often = distinct[count > hot]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(often), pa.int64()), pa.array(often)], names=["doc", "anchor"])

    rows = plain.mapInArrow(seen, "anchor long, doc long, times int")
    dealt = rows.repartition(n, F.when(F.col("times") == 0, F.col("doc")).otherwise(F.col("anchor")))
    return dealt.mapInArrow(counted, "doc long, anchor long")


def _hot_bits(repeated: DataFrame) -> np.ndarray:
    """The map of hot anchors: a bit each, of HOT_BITS; what comes to the driver is at most that many bits."""
    slot = F.pmod(F.col("anchor"), F.lit(HOT_BITS))
    words = repeated.where(F.col("doc").isNull()).groupBy(F.shiftright(slot, 6).alias("word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(pmod(anchor, 64) AS int))) AS bits")).collect()
    bits = np.zeros(HOT_BITS // 64, np.int64)
    bits[[r["word"] for r in found]] = [r["bits"] for r in found]
    return bits.view(np.uint64)


def _is_hot(bits: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    slot = anchor & np.int64(HOT_BITS - 1)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def _likely_parts(pieces: list[tuple[int, int, bytes]], length: int) -> Iterator[tuple[int, int, bytes]]:
    """(number, bytes skipped, part) of the parts of ``pieces`` (anchor, its place, text) with windows that may repeat, in order.

    Windows that begin within STEP bytes of each other share all but STEP of their bytes. Where this core, at its
    distance from the anchor, is in one piece only, none of its windows is in another. Runs of likely windows are
    told once each.
    """
    times: dict[tuple[int, int, int], int] = {}
    cores: list[list[tuple[tuple[int, int, int], int, int]]] = []
    for anchor, place, piece in pieces:
        own, last = [], len(piece) - length
        # Steps are counted from the anchor, so that equal windows fall into equal steps.
        for step in range((place - last) // STEP, place // STEP + 1):
            lo, hi = place - step * STEP - STEP + 1, place - step * STEP  # windows of this step
            key = (anchor, step, hash(piece[hi : lo + length]))
            times[key] = times.get(key, 0) + 1
            own.append((key, max(lo, 0), min(hi, last)))
        cores.append(own)
    for i, own in enumerate(cores):
        begin = end = None
        for key, lo, hi in reversed(own):  # from the first window on
            if times[key] == 1:
                continue
            if begin is not None and lo > end + 1:
                yield i, begin, pieces[i][2][begin : end + length]
                begin = None
            begin, end = lo if begin is None else begin, hi
        if begin is not None and begin <= end:
            yield i, begin, pieces[i][2][begin : end + length]


def _again(key: tuple[np.ndarray, ...], doc: np.ndarray, mark: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which rows have the ``key`` of an earlier row: one with a smaller id (no id is smaller than any), or with an earlier start in the same text.

    Rows of one place, as of a document that is read twice, are no repeats of one another.
    """
    if not len(doc):
        return np.zeros(0, bool)
    known = mark >= 0
    ids = np.where(known, doc, 0)
    order = np.lexsort((start, mark, doc, ids, known, *key))

    def edges(parts, before=False):
        new = np.zeros(len(order), bool)
        new[0] = True
        for part in parts:
            part = part[order]
            new[1:] |= part[1:] != part[:-1]
        return new | before

    group = edges(key)
    one_id = edges((ids, known), group)
    row = edges((doc, mark), one_id)
    place = edges((start,), row)
    later = lambda inner, outer: np.cumsum(inner) - np.cumsum(inner)[np.flatnonzero(outer)][np.cumsum(outer) - 1] > 0
    again = np.zeros(len(doc), bool)
    again[order] = later(one_id, group) | later(place, row)
    return again


def _runs(doc: np.ndarray, mark: np.ndarray, first: np.ndarray, last: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each run of windows, or of stretches of windows, that start in a row; rows are in order."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = first if last is None else last
    begin = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (first[1:] != last[:-1] + 1)])
    return begin, np.r_[begin[1:] - 1, len(doc) - 1]


#: What travels to the search: pieces of text (``last`` unused), windows dealt one by one (an empty piece), and runs of windows known to repeat (a null one).
PIECES = ("anchor", "at", "piece", "doc", "mark", "first", "last")
PIECES_SCHEMA = "anchor long, at long, piece binary, doc long, mark long, first long, last long"
RANGES = ("doc", "mark", "start", "end")
RANGES_SCHEMA = "doc long, mark long, start long, end long"


def _piece_rows(anchor, at, piece, doc, mark, first, last):
    import pyarrow as pa

    long = lambda x: pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([long(anchor), long(at), pa.array(piece, pa.binary()), *map(long, (doc, mark, first, last))], names=list(PIECES))


def _known(doc, mark, first, last):
    """Rows of runs of windows that are known to repeat; dealt by their document."""
    return _piece_rows(doc, np.zeros_like(first), [None] * len(first), doc, mark, first, last)


def _dealt_windows(pieces: list[tuple[int, int, int, bytes]], length: int):
    """Rows of windows of ``pieces`` (doc, mark, first window, text; in order): runs that repeat an earlier window of ``pieces``, then the hashes of the others."""
    from hashlib import blake2b

    counts = np.array([len(x) - length + 1 for *_, x in pieces], np.int64)
    hashed = b"".join([blake2b(x[i : i + length], digest_size=16).digest() for *_, x in pieces for i in range(len(x) - length + 1)])
    high, low = np.frombuffer(hashed, np.int64).reshape(-1, 2).T
    doc, mark, first = (np.repeat(np.array([p[k] for p in pieces], np.int64), counts) for k in range(3))
    start = first - np.repeat(np.cumsum(counts) - counts, counts) + np.arange(len(doc))
    again = _again((high, low), doc, mark, start)
    begin, end = _runs(doc[again], mark[again], start[again])
    yield _known(doc[again][begin], mark[again][begin], start[again][begin], start[again][end])
    high, low, doc, mark, start = (x[~again] for x in (high, low, doc, mark, start))
    yield _piece_rows(high, low, [b""] * len(doc), doc, mark, start, np.zeros_like(start))


def _ranges(doc, mark, start, end):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (doc, mark, start, end)], names=list(RANGES))


def _whole_anchors(batches) -> Iterator:
    """Tables of about HELD_BYTES from batches in the order of anchors; no anchor lies in two of them."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.nbytes
        if size < HELD_BYTES:
            continue
        table = pa.Table.from_batches(held)
        anchor = table.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1]))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _matched(table, length: int) -> Iterator:
    """Ranges of windows that occur earlier too, from the rows of whole anchors."""
    import pyarrow.compute as pc

    known = table.filter(pc.is_null(table.column("piece")))
    doc, mark, first, last = (known.column(c).to_numpy() for c in ("doc", "mark", "first", "last"))
    yield _ranges(doc, mark, first, last + length)
    table = table.filter(pc.is_valid(table.column("piece")))
    single = pc.equal(pc.binary_length(table.column("piece")), 0)
    high, low, doc, mark, first = (table.filter(single).column(c).to_numpy() for c in ("anchor", "at", "doc", "mark", "first"))
    again = _again((high, low), doc, mark, first)
    yield _ranges(doc[again], mark[again], first[again], first[again] + length)
    table = table.filter(pc.invert(single))
    doc, mark, first = (table.column(c).to_numpy() for c in ("doc", "mark", "first"))
    anchor, place, piece = (table.column(c).to_pylist() for c in ("anchor", "at", "piece"))
    names: dict[tuple[int, int, bytes], int] = {}
    name = np.array([names.setdefault(key, len(names)) for key in zip(anchor, place, piece, strict=True)], np.int64)
    again = _again((name,), doc, mark, first)
    yield _ranges(doc[again], mark[again], first[again], first[again] + np.array([len(piece[i]) for i in np.flatnonzero(again).tolist()], np.int64))
    # The parts of the other pieces whose windows may repeat; the rest needs no search. A text that is read twice counts once.
    order = np.lexsort((first, mark, doc))
    order = order[~again[order]]
    if len(order):
        new = np.zeros(len(order), bool)
        new[0] = True
        for column in (doc, mark, first):
            new[1:] |= column[order][1:] != column[order][:-1]
        order = order[new]
    left = order.tolist()
    parts = list(_likely_parts([(anchor[i], place[i], piece[i]) for i in left], length))
    if not parts:
        return
    rows = np.array([left[k] for k, _, _ in parts])
    doc, mark, first = doc[rows], mark[rows], first[rows] + np.array([skip for _, skip, _ in parts], np.int64)
    at, offset = repeated_windows([x for _, _, x in parts], doc, mark, first, length)
    order = np.lexsort((offset, at))
    at, offset = at[order], offset[order]
    begin, end = _runs(at, at, offset)
    yield _ranges(doc[at[begin]], mark[at[begin]], first[at[begin]] + offset[begin], first[at[end]] + offset[end] + length)


def row_hash() -> Column:
    """What rows are dealt by: rows of one id but of different texts go different ways."""
    return F.xxhash64("doc", "mark")


def repeated_ranges(plain: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, mark, start, end) of byte ranges covered by windows that occur earlier too; ranges may overlap. ``plain`` has doc, mark and text."""
    n = shuffle_partitions(plain.sparkSession)
    plain = plain.withColumn("row", row_hash())
    repeated = shared_checkpoint(_repeated_anchors(plain.select(F.col("row").alias("doc"), "mark", "text"), length))
    hot = _hot_bits(repeated)
    asked = repeated.where(F.col("doc").isNotNull()).groupBy(F.col("doc").alias("row")).agg(F.collect_set("anchor").alias("anchors"))

    def dealt(held):
        """Rows of ``held`` (anchor, its place, text, doc, mark, first and last window): what is known to repeat, then what is to be searched."""
        anchor, place, piece, doc, mark, first, last = zip(*held, strict=True)
        names: dict[tuple[int, int, bytes], int] = {}
        name = np.array([names.setdefault(key, len(names)) for key in zip(anchor, place, piece, strict=True)], np.int64)
        anchor, doc, mark, first, last = (np.array(x, np.int64) for x in (anchor, doc, mark, first, last))
        again = _again((name,), doc, mark, first)
        order = np.flatnonzero(again)
        order = order[np.lexsort((first[order], mark[order], doc[order]))]
        begin, end = _runs(doc[order], mark[order], first[order], last[order])
        yield _known(doc[order][begin], mark[order][begin], first[order][begin], last[order][end])
        often = _is_hot(hot, anchor)
        rest = np.flatnonzero(~again & ~often)
        text = lambda chosen: [piece[i] for i in chosen.tolist()]
        yield _piece_rows(anchor[rest], np.array(place, np.int64)[rest], text(rest), doc[rest], mark[rest], first[rest], np.zeros_like(first[rest]))
        order = np.flatnonzero(~again & often)
        order = order[np.lexsort((first[order], mark[order], doc[order]))]
        windows = np.cumsum(last[order] - first[order] + 1)
        for chunk in np.split(order, np.searchsorted(windows, np.arange(HOT_WINDOWS, windows[-1] if len(windows) else 0, HOT_WINDOWS))):
            if len(chunk):
                yield from _dealt_windows(list(zip(doc[chunk].tolist(), mark[chunk].tolist(), first[chunk].tolist(), text(chunk), strict=True)), length)

    def cut(batches):
        held, size = [], 0
        for batch in bounded(batches):
            for doc, mark, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc", "mark", "text", "anchors")), strict=True):
                data, wanted = text.encode(), np.array(wanted, np.int64)
                for anchor, place, first, last in anchors(data, length):
                    own = np.flatnonzero(np.isin(anchor, wanted))
                    for a, p, lo, hi in zip(*(x[own].tolist() for x in (anchor, place, first, last)), strict=True):
                        held.append((a, p - lo, data[lo : hi + length], doc, mark, lo, hi))
                        size += hi - lo + length
                        if len(held) >= CUT_PIECES or size >= CUT_BYTES:
                            yield from dealt(held)
                            held, size = [], 0
        if held:
            yield from dealt(held)

    def matched(batches):
        for table in _whole_anchors(batches):
            yield from _matched(table, length)

    pieces = asked.join(plain, "row").select("doc", "mark", "text", "anchors").mapInArrow(cut, PIECES_SCHEMA)
    return pieces.repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(matched, RANGES_SCHEMA)


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """Cut repeated strings out of every text: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (binary).

    Null text counts as empty; a text of fewer than ``length`` bytes loses nothing. Of equal texts the one with the smallest
    doc_id stays whole. Every row is a document of its own. A row without an id comes before all rows with one; rows that
    share an id, or have none, come neither before nor after one another, so that none loses what only the others
    hold: repeated rows stay whole, or lose alike what a smaller id holds. An empty table gives an empty table;
    other columns are not looked at.
    """
    import pyarrow as pa

    plain = row_keys(docs)
    # By the same hash of id and text as the search, so that texts are shuffled once, and rows that share an id do not meet.
    ranges = repeated_ranges(plain, length).groupBy(row_hash().alias("row")).agg(F.collect_set(F.struct("doc", "mark", "start", "end")).alias("ranges"))

    def removed(batches):
        import hashlib

        for batch in bounded(batches):
            rows = []
            for doc, mark, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "mark", "text", "ranges")), strict=True):
                data, parts, at, gone, spans = text.encode(), [], 0, 0, 0
                for start, end in sorted((r["start"], r["end"]) for r in found or () if r["mark"] == mark and r["doc"] == doc):
                    if start > at or not spans:
                        parts.append(data[at:start])
                        spans, at = spans + 1, start
                    gone, at = gone + max(0, end - at), max(at, end)
                kept = b"".join([*parts, data[at:]])
                row = (doc if mark >= 0 else None, len(data), gone, spans, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_text else row)
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * len(kinds), kinds, strict=True)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return plain.withColumn("row", row_hash()).join(ranges, "row", "left").select("doc", "mark", "text", "ranges").mapInArrow(removed, schema)
