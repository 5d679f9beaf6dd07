"""Near-dedup by b-bit MinHash.

1. Every text becomes a set of word shingles, its MinHash minima, band keys of a few minima each, and a
   signature of the minima's low bits packed into longs. Texts with equal sets form a class.
2. Classes that share a band key meet in a bucket. A bucket links its members to its smallest, a star and never all
   pairs. Links that the signatures put clearly below the threshold are dropped, the others are
   confirmed on the full sets, and the confirmed ones give first components.
3. Buckets whose members are still in several components may hide links between them. Members of such a bucket are compared
   by set size and signature, in blocks of bounded size and without texts. Those that are likely partners of one
   another make a cluster, whose members are compared on their full sets, again in blocks, and only links that join
   components are returned.
4. Components of all confirmed links are the result.

With 40 bands of 5 minima, two sets with a similarity of 0.8 share no band once in 8 million pairs; a
signature of 192 minima errs by 5 standard deviations (0.15) once in 3 million. ``margin=None`` confirms every
candidate on the full sets, whatever the signatures say.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import bounded, row_key, row_keys, shared_checkpoint, shuffle_partitions
from gridloom.llm.components import connected_components
from gridloom.llm.shingles import Shingler, mixed
from gridloom.operators.skew import spread_join

WORDS, PERCENT = 5, 80
BANDS, ROWS, LOW_BITS, SIGNED = 40, 5, 4, 192
MARGIN = 0.15

#: Links to one text that a task confirms.
HUB_LINKS = 500
#: Members of one block of a bucket that are compared by signature, on average; a task holds two.
SIGNED_MEMBERS = 2000
#: Of one block that is compared on full sets, on average: shingles and members. A task holds two.
BLOCK_SHINGLES, BLOCK_MEMBERS = 250_000, 1500

_rng = np.random.default_rng(20_240_101)
FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
OFFSETS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def minima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash minima (hash functions x sets) of the sets that begin at ``starts`` in ``values``; none empty."""
    out = np.empty((len(FACTORS), len(starts)), np.uint32)
    for i, (factor, offset) in enumerate(zip(FACTORS, OFFSETS, strict=True)):
        out[i] = np.minimum.reduceat(((values * factor + offset) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """One key per set and band (sets x bands), the band mixed in."""
    rows = least.reshape(BANDS, ROWS, -1).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = mixed(key ^ rows[:, r])
    return key.T.astype(np.int64)


def signatures(least: np.ndarray) -> np.ndarray:
    """The low bits of the first SIGNED minima, packed into longs (sets x longs)."""
    each = 64 // LOW_BITS
    low = (least[:SIGNED] & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint64).reshape(SIGNED // each, each, -1)
    return np.bitwise_or.reduce(low << (np.arange(each, dtype=np.uint64) * np.uint64(LOW_BITS))[:, None], axis=1).T.astype(np.int64)


def estimated(a: str, b: str) -> Column:
    """Similarity of two signature columns: equal minima by bit counts, less those that agree by chance."""
    fields = "1" * (64 // LOW_BITS)
    ones = F.lit(int(fields, 16)).cast("long")  # the lowest bit of every field
    unequal = F.lit(0)
    for i in range(SIGNED * LOW_BITS // 64):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        unequal = unequal + F.bit_count(x.bitwiseAND(ones))
    chance = 1 / (1 << LOW_BITS)
    return (1 - unequal / SIGNED - chance) / (1 - chance)


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """doc, mark, n_shingles, set_a, set_b (128 bits that name the set), signature, bands of every text; null without words."""
    import pyarrow as pa

    def sketched(batches):
        shingler = Shingler(words)
        for batch in bounded(batches):
            doc, mark, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            for group in _groups(texts, 1 << 17):
                sets = [np.unique(shingler.shingles(t)) for t in group[1]]
                sizes = np.array([len(s) for s in sets], np.int64)
                full = sizes > 0
                n = int(full.sum())
                names = np.zeros((2, len(sets)), np.int64)
                bands: list = [None] * len(sets)
                signs: list = [None] * len(sets)
                if n:
                    values = np.concatenate([s for s in sets if len(s)])
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    names[0, full] = np.add.reduceat(mixed(values), starts).astype(np.int64)
                    names[1, full] = np.add.reduceat(mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts).astype(np.int64)
                    least = minima(values, starts)
                    for i, k, s in zip(np.flatnonzero(full).tolist(), band_keys(least).tolist(), signatures(least).tolist(), strict=True):
                        bands[i], signs[i] = k, s
                arrays = [doc.slice(group[0], len(sets)), mark.slice(group[0], len(sets)), pa.array(sizes), pa.array(names[0]), pa.array(names[1])]
                arrays += [pa.array(signs, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc", "mark", "n_shingles", "set_a", "set_b", "signature", "bands"])

    schema = "doc long, mark long, n_shingles long, set_a long, set_b long, signature array<long>, bands array<long>"
    return docs.select("doc", "mark", "text").mapInArrow(sketched, schema)


def _groups(texts: list[str], size: int) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of runs of texts of about ``size`` characters: small enough for the processor's caches."""
    start = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= size:
            yield start, texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def confirmed(links: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``links`` (a, b, and as ``links`` how many b has) whose texts have 100 * common shingles >= percent * all shingles.

    A text that many others are held to is copied for every HUB_LINKS of them.
    """

    def check(batches):
        import pyarrow as pa

        shingler = Shingler(words)
        last: tuple = (None, None)
        for batch in bounded(batches):
            a, b, one, other = (c.to_pylist() for c in batch.columns)
            keep = []
            for i in range(len(a)):
                if b[i] != last[0]:
                    last = (b[i], np.unique(shingler.shingles(other[i])))
                mine = np.unique(shingler.shingles(one[i]))
                common = len(np.intersect1d(mine, last[1], assume_unique=True))
                if common and 100 * common >= percent * (len(mine) + len(last[1]) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in keep], pa.int64()) for x in (a, b)], names=["a", "b"])

    parts = F.ceil(F.col("links") / HUB_LINKS).cast("int")
    dealt = links.select("a", "b", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part"))
    one = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    hubs = links.select(F.col("b").alias("node"), parts.alias("parts")).distinct().join(texts, "node")
    other = hubs.select(F.col("node").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("other"))
    pairs = dealt.join(one, "a").join(other, ["b", "part"]).select("a", "b", "one", "other")
    return pairs.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, margin: float | None = MARGIN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked whose sets of ``words``-word shingles have 100 * intersection >= percent * union; letters A-Z in lower
    case, words cut at ASCII white space, a text with fewer words is one shingle. component_id is the smallest
    doc_id reachable by links, itself included; kept is true for that one. A null or empty text, or one without words, is
    linked with nothing. Every row is a document of its own, so repeated rows, rows without an id and several texts under
    one id are linked by their texts alone; a component has the null id only where no row of it has one. An empty
    table gives an empty table; other columns are not looked at. ``margin`` is how far below the threshold
    signatures may put a pair that is still confirmed on its sets; None confirms every candidate.
    """
    return _marked(docs, words, percent, margin).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _marked(docs: DataFrame, words: int, percent: int, margin: float | None) -> DataFrame:
    """doc, mark, doc_id, n_shingles, component_id of every row, and what names its component: the node of its smallest class, null where it has no words."""
    plain = row_keys(docs)
    actual = F.when(F.col("mark") >= 0, F.col("doc"))
    sets = shared_checkpoint(sketch(plain, words))
    filled = sets.where(F.col("n_shingles") > 0)
    classes = filled.groupBy("set_a", "set_b").agg(
        F.min(F.struct("doc", "mark")).alias("rep"), F.min(actual).alias("least_id"), F.count(F.lit(1)).alias("rows"),
        F.first("n_shingles").alias("size"), F.first("signature").alias("signature"), F.first("bands").alias("bands"),
    )
    classes = shared_checkpoint(classes.withColumn("node", F.monotonically_increasing_id()))
    signed = classes.select("node", "size", "signature")
    banded = classes.select("node", F.explode("bands").alias("key"))
    hubs = shared_checkpoint(banded.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    # Buckets of more than one class, kept for step 3: far fewer rows than there are bands.
    shared = shared_checkpoint(banded.join(hubs, "key").select("key", "node", "hub"))
    touched = shared.select("node").distinct().join(classes.select("node", "rep.*"), "node")
    texts = shared_checkpoint(plain.join(touched, ["doc", "mark"]).groupBy("node").agg(F.first("text").alias("text")))
    stars = shared.where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    first = shared_checkpoint(confirmed(shared_checkpoint(_likely(stars, signed, percent, margin)), texts, words, percent))
    components = shared_checkpoint(connected_components(first))
    joining = shared_checkpoint(_hidden(shared, components, signed, texts, words, percent, margin))
    # Stars of components and the links between them: one or two rounds more.
    whole = shared_checkpoint(connected_components(components.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(joining)))

    placed = classes.select("node", "set_a", "set_b", "rows", "least_id").join(whole, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = shared_checkpoint(placed)
    least = shared_checkpoint(placed.groupBy("component").agg(F.min("least_id").alias("component_id")))
    names = placed.join(least, "component").select("set_a", "set_b", "rows", "component", "component_id")
    wordless = sets.where("n_shingles = 0").select("doc", "mark", "n_shingles", F.lit(None).cast("long").alias("component"), actual.alias("component_id"))
    linked = spread_join(filled.select("doc", "mark", "n_shingles", "set_a", "set_b"), names, ["set_a", "set_b"], "rows").drop("set_a", "set_b")
    return linked.unionByName(wordless).withColumn("doc_id", actual)


def _likely(pairs: DataFrame, signed: DataFrame, percent: int, margin: float | None) -> DataFrame:
    """The ``pairs`` (a, b) that their signatures do not put clearly below the threshold, with the number of ``links`` of b."""
    times = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("links"))
    if margin is None:
        return spread_join(pairs, times, ["b"], "n")
    hubs = times.join(signed.select(F.col("node").alias("b"), F.col("signature").alias("sign_b")), "b")
    one = signed.select(F.col("node").alias("a"), F.col("signature").alias("sign_a"))
    found = spread_join(pairs, hubs, ["b"], "n").join(one, "a")
    return found.where(estimated("sign_a", "sign_b") >= percent / 100 - margin).select("a", "b", "links")


def _open_buckets(members: DataFrame) -> DataFrame:
    """(key, n) of the buckets of ``members`` (key, node, component) with several components, one of those with the same members."""
    buckets = members.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    return buckets.where("low != high").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n")


def _dealt(members: DataFrame, groups: DataFrame) -> DataFrame:
    """``members`` (key, node, ...) of ``groups`` (key, n, blocks), one copy for each pair of blocks that holds its own: with low, high (the pair) and block.

    Which block a member is in hangs on its node alone.
    """
    sized = spread_join(members, groups.select("key", "n", F.col("blocks").cast("int").alias("blocks")), ["key"], "n")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = sized.select("*", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), other)
    return dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("blocks", "other")


def _hidden(shared: DataFrame, components: DataFrame, signed: DataFrame, texts: DataFrame, words: int, percent: int, margin: float | None) -> DataFrame:
    """Links (a, b) between components whose members share a bucket; enough of them to join these."""
    placed = shared.join(components, "node", "left").join(signed.select("node", "size"), "node")
    placed = shared_checkpoint(placed.select("key", "node", "size", F.coalesce("component", "node").alias("component")))
    buckets = _open_buckets(placed).withColumn("blocks", F.ceil(F.col("n") / SIGNED_MEMBERS))
    columns = ("key", "low", "high", "block", "node", "component", "size", "signature")
    members = _dealt(placed, buckets).join(signed.select("node", "signature"), "node").select(*columns)
    members = members.repartition(shuffle_partitions(shared.sparkSession), "key", "low", "high").sortWithinPartitions("key", "low", "high")
    likely = shared_checkpoint(members.mapInArrow(_partners(percent, margin), "a long, b long").distinct())
    clusters = connected_components(likely).select("node", F.col("component").alias("key"))
    clustered = shared_checkpoint(clusters.join(placed.select("node", "component", "size").distinct(), "node"))
    sizes = clustered.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("n") / BLOCK_MEMBERS))
    dealt = _dealt(clustered, sizes.withColumn("blocks", blocks)).join(signed.select("node", "signature"), "node").join(texts, "node")
    found = dealt.select("key", "low", "high", "block", "node", "component", "signature", "text").groupBy("key", "low", "high")
    return found.applyInArrow(_joining_links(words, percent, margin), "a long, b long")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of signatures (sets x longs), as ``estimated`` has it."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    chance = 1 / (1 << LOW_BITS)
    return (1 - np.bitwise_count(x & np.uint64(int("1" * (64 // LOW_BITS), 16))).sum(axis=1) / SIGNED - chance) / (1 - chance)


def _partners(percent: int, margin: float | None):
    """A function of members sorted by (key, low, high): links (a, b) between nodes that hold all likely partners within a pair of blocks together."""

    def partnered(batches):
        import pyarrow as pa

        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < 50_000:
                continue
            table = pa.Table.from_batches(held)
            names = np.stack([table.column(c).to_numpy() for c in ("key", "low", "high")])
            cut = int(np.flatnonzero((names != names[:, -1:]).any(axis=0))[-1]) + 1 if (names != names[:, -1:]).any() else 0
            if cut:
                yield compared(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
        if held:
            yield compared(pa.Table.from_batches(held))

    def compared(table):
        import pyarrow as pa

        key, low, high, block, node, component, size = (table.column(c).to_numpy() for c in ("key", "low", "high", "block", "node", "component", "size"))
        signature = table.column("signature").combine_chunks().flatten().to_numpy().reshape(len(key), -1).view(np.uint64)
        group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        root = i = np.arange(len(key))
        for lag in range(1, len(key)):
            i = i[i + lag < len(key)]
            i = i[group[i] == group[i + lag]]
            if not len(i):
                break
            j = i + lag
            fits = (root[i] != root[j]) & (component[i] != component[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
            fits &= 100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])
            a, b = i[fits], j[fits]
            if margin is not None and len(a):
                near = _alike(signature[a], signature[b]) >= percent / 100 - margin
                a, b = a[near], b[near]
            if not len(a):
                continue
            held = root.tolist()
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                while held[x] != x:
                    x = held[x]
                while held[y] != y:
                    y = held[y]
                held[max(x, y)] = min(x, y)
            root = np.array(held)
            while (root[root] != root).any():
                root = root[root]
        moved = root != np.arange(len(key))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[root[moved]])], names=["a", "b"])

    return partnered


def _joining_links(words: int, percent: int, margin: float | None):
    """A function of two blocks' members: links between different components, none that joins what is joined already."""

    def links(key, table):
        import pyarrow as pa

        low, high = key[1].as_py(), key[2].as_py()
        components, block = (table.column(c).to_pylist() for c in ("component", "block"))
        names = {c: i for i, c in enumerate(dict.fromkeys(components))}
        group = np.array([names[c] for c in components])
        root = list(range(len(names)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        shingler = Shingler(words)
        sets = [np.unique(shingler.shingles(t)) for t in table.column("text").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        seen, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        place = np.cumsum(times > 1) - 1  # only shingles of several members can be common
        bits, at = [], 0
        for n in sizes.tolist():
            own = where[at : at + n]
            at += n
            row = np.zeros(int(place[-1]) + 8, np.uint8)
            row[place[own[times[own] > 1]]] = 1
            bits.append(int.from_bytes(np.packbits(row).tobytes()))
        signature = np.array(table.column("signature").to_pylist(), np.int64).view(np.uint64)
        mine = np.array(block)
        found: list[tuple[int, int]] = []
        for i in range(len(group)):
            rest = np.arange(i + 1, len(group))
            rest = rest[(group[rest] != group[i]) & ((low == high) | (mine[rest] != mine[i]))]
            rest = rest[100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])]
            if margin is not None and len(rest):
                rest = rest[_alike(signature[rest], signature[i]) >= percent / 100 - margin]
            for j in rest.tolist():
                if (a := find(group[i])) != (b := find(group[j])):
                    common = (bits[i] & bits[j]).bit_count()
                    if common and 100 * common >= percent * (int(sizes[i] + sizes[j]) - common):
                        root[a] = b
                        found.append((components[i], components[j]))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return links


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, margin: float | None = MARGIN) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one with the smallest doc_id; all columns kept.

    Of several texts under that id the one whose text hashes lowest stays. Rows that repeat both id and text stay or go together,
    and rows without words stay.
    """
    columns = docs.columns
    marks = _marked(docs, words, percent, margin)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc", "mark")).alias("best")
    stays = marks.where(F.col("component").isNotNull()).groupBy("component").agg(best).select("best.doc", "best.mark")
    stays = stays.unionByName(marks.where(F.col("component").isNull()).select("doc", "mark").distinct())
    stays = stays.select(F.col("doc").alias("_doc"), F.col("mark").alias("_mark"))
    return docs.withColumns(row_key()).join(stays, ["_doc", "_mark"], "left_semi").select(*columns)
