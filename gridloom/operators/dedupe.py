"""Keyed deduplication that keeps where a record was seen.

A later URL of a key is appended unless the joined string holds it already as a substring. First of all each (key, URL) is
reduced to one row, which merges repeats before the shuffle and spreads a hot key over its URLs. A key with few URLs is
then folded in its row. A key with many is not, since each step of a fold reads all that came before: whether an earlier
URL holds a later one is asked of all URLs at once, by an aggregation over (key, string), whose tasks see a share of the
strings and never a key. Being held is transitive, so a URL that is held by one that was itself left out is held
by whatever held that one, and the order of the fold plays no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import fixed as X
from gridloom.functions.endpoints import record_key

SEPARATOR = "; "
#: Later URLs that are folded in a row; the result is the same on either side of it.
FOLD_URLS = 64
#: Code points by which the places are told at which a URL may begin inside another.
HEAD = 2


def _appended(start: Column, later: Column, grows: Column) -> Column:
    """STRUCT<url, seen>: ``start`` joined with the URLs of ``later`` (ordered structs) that it does not hold yet, and the largest ``seen`` of what went in."""
    step = lambda held, x: F.when(F.contains(held["url"], x["url"]), held).otherwise(
        F.struct(F.concat(held["url"], F.lit(SEPARATOR), x["url"]).alias("url"), F.greatest(held["seen"], x["seen"]).alias("seen"))
    )
    return F.aggregate(later, F.struct(start.alias("url"), grows.alias("seen")), step)


def _held_strings(url: Column, heads: Column, lengths: Column) -> Column:
    """The strings inside ``url``, itself left out, that begin like some URL of the key and are as long as some URL of the key."""
    size = F.char_length(url)
    begins = lambda at: F.array_contains(heads, F.substr(url, at, F.lit(HEAD))) | F.array_contains(heads, F.substr(url, at, F.lit(1)))
    fits = lambda at: F.filter(lengths, lambda n: (n <= size - at + 1) & ~((at == 1) & (n == size)))
    places = F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), begins)
    return F.array_distinct(F.flatten(F.transform(places, lambda at: F.transform(fits(at), lambda n: F.substr(url, at, n)))))


def urls_not_held(urls: DataFrame) -> DataFrame:
    """The rows of ``urls`` (_key, _url, _ord, _seen), one per URL of a key, that no URL of a smaller _ord holds.

    Every URL meets the strings that other URLs hold in an aggregation over (key, string). What is compared are strings that begin
    like a URL of the key and are as long as one, so a URL makes about as many rows as the key has lengths, and no pairs are made.
    """
    rules = urls.groupBy("_key").agg(F.collect_set(F.char_length("_url")).alias("_lengths"), F.collect_set(F.left("_url", F.lit(HEAD))).alias("_heads"))
    inside = urls.join(rules, "_key").select("_key", "_ord", F.explode(_held_strings(F.col("_url"), F.col("_heads"), F.col("_lengths"))).alias("_url"))
    kind = dict(urls.dtypes)
    none = lambda c: F.lit(None).cast(kind[c]).alias(c)
    own = urls.select("_key", "_url", "_ord", none("_ord").alias("_within"), "_seen")
    both = own.unionByName(inside.select("_key", "_url", none("_ord"), F.col("_ord").alias("_within"), none("_seen")))
    met = both.groupBy("_key", "_url").agg(F.min("_ord").alias("_ord"), F.min("_within").alias("_within"), F.min_by("_seen", "_ord").alias("_seen"))
    return met.where(F.col("_ord").isNotNull() & (F.col("_within").isNull() | (F.col("_within") > F.col("_ord")))).drop("_within")


def _joined(kept: Column) -> Column:
    """STRUCT<url, seen> of all that is ``kept`` of a key, in order.

    A string with a part of the separator may also be held across the seam of two others; only these are looked for one by one.
    """
    several = F.filter(F.sequence(F.lit(1), F.size(kept)), lambda i: (i > 1) & F.get(kept, i - 1)["url"].rlike("[; ]"))
    empty = F.filter(F.sequence(F.lit(1), F.size(kept)), lambda i: (i > 1) & (F.get(kept, i - 1)["url"] == ""))
    seams = F.array_sort(F.concat(several, empty, F.array(F.size(kept) + 1)))
    urls = lambda a, b: F.array_join(F.transform(F.slice(kept, a, b - a), lambda x: x["url"]), SEPARATOR)
    seen = lambda a, b: F.array_max(F.transform(F.slice(kept, a, b - a), lambda x: x["seen"]))

    def step(held, at):
        run = F.when(at == held["next"], held["url"]).when(held["next"] == 1, urls(F.lit(1), at)).otherwise(F.concat(held["url"], F.lit(SEPARATOR), urls(held["next"], at)))
        grown = F.when(at == held["next"], held["seen"]).otherwise(F.greatest(held["seen"], seen(held["next"], at)))
        own = F.get(kept, at - 1)
        goes_in = (at <= F.size(kept)) & ~F.contains(run, own["url"])
        return F.struct(
            F.when(goes_in, F.concat(run, F.lit(SEPARATOR), own["url"])).otherwise(run).alias("url"),
            F.when(goes_in, F.greatest(grown, own["seen"])).otherwise(grown).alias("seen"),
            (at + 1).alias("next"),
        )

    start = F.struct(F.lit("").alias("url"), F.get(kept, F.lit(0))["seen"].alias("seen"), F.lit(1).alias("next"))
    return F.aggregate(seams, start, step, lambda held: F.struct(held["url"].alias("url"), held["seen"].alias("seen")))


def _of_wide_keys(later: DataFrame, winners: DataFrame | None, own_url: Column, own_seen: Column, entry: Column) -> DataFrame:
    """(_first, _whole) of keys with many URLs; ``winners`` are their winners where these are not the first records of ``later``."""
    urls = later.select("_key", "_url", "_ord", "_seen")
    if winners is not None:
        urls = urls.unionByName(winners.select("_key", own_url.alias("_url"), F.col("_first.ord").alias("_ord"), own_seen.alias("_seen")))
        urls = urls.groupBy("_key", "_url").agg(F.min("_ord").alias("_ord"), F.min_by("_seen", "_ord").alias("_seen"))
    else:
        winners = later.groupBy("_key").agg(F.min_by("_first", "_ord").alias("_first"))
    kept = urls_not_held(urls).groupBy("_key").agg(F.sort_array(F.collect_list(entry)).alias("_kept"))
    return winners.join(kept, "_key").select("_first", _joined(F.col("_kept")).alias("_whole"))


def _unique(records: DataFrame, keys: list[Column], fields: tuple[str, ...], url: str, rank: Column | None, substring: bool, grows: str | None = None) -> DataFrame:
    """One row per key: the first record, or the first of the highest ``rank``, with the URLs of later records appended.

    ``grows`` names a field that becomes the largest of the records whose URL went in.
    """
    seen = F.lit(None).cast("string") if grows is None else F.col(grows)
    text = F.coalesce(F.col(url), F.lit(""))
    keyed = records.select("ord", (F.lit(0) if rank is None else -rank).alias("_low"), *fields, F.struct(*keys).alias("_key"), text.alias("_url"), seen.alias("_seen"))
    row, place = F.struct("ord", *fields), F.struct("_low", "ord")
    entry = F.struct(F.col("_ord").alias("ord"), F.col("_url").alias("url"), F.col("_seen").alias("seen"))
    first, own_url = F.col("_first"), F.coalesce(F.col(f"_first.{url}"), F.lit(""))
    own_seen = seen if grows is None else first[grows]
    if rank is None:
        later = keyed.groupBy("_key", "_url").agg(F.min_by(row, "ord").alias("_first"), F.min("ord").alias("_ord"), F.min_by("_seen", "ord").alias("_seen"))
        winners = None
    else:
        # A URL counts from its first record after the winner; records of a hot key that meet its winner are split by the skew join.
        winners = keyed.groupBy("_key").agg(F.min_by(row, place).alias("_first"))
        starts = winners.select("_key", F.col("_first.ord").alias("_from"))
        after = keyed.select("_key", "ord", "_url", "_seen").join(starts, "_key").where(F.col("ord") > F.col("_from"))
        later = after.groupBy("_key", "_url").agg(F.min("ord").alias("_ord"), F.min_by("_seen", "ord").alias("_seen"))

    def gathered(rows: DataFrame, only: DataFrame | None = None) -> DataFrame:
        """(_first, _entries): each key's winner and its later URLs in order; ``only`` are the keys that count."""
        entries = F.sort_array(F.collect_list(entry)).alias("_entries")
        if winners is None:
            found = rows.groupBy("_key").agg(F.min_by("_first", "_ord").alias("_first"), entries)
            return found.select("_first", F.slice("_entries", 2, F.size("_entries")).alias("_entries"))
        heads = winners if only is None else winners.join(only, "_key", "left_anti")
        found = heads.join(rows.groupBy("_key").agg(entries), "_key", "left")
        return found.select("_first", F.coalesce("_entries", F.array().cast(dict(found.dtypes)["_entries"])).alias("_entries"))

    if not substring:
        others = F.filter("_entries", lambda x: x["url"] != own_url)
        joined = F.array_join(F.concat(F.array(own_url), F.transform(others, lambda x: x["url"])), SEPARATOR)
        most_seen = F.greatest(own_seen, F.array_max(F.transform(others, lambda x: x["seen"])))
        done = gathered(later).select("_first", F.struct(joined.alias("url"), most_seen.alias("seen")).alias("_whole"))
    else:
        # Which keys are taken for wide ones is an estimate; either way gives the same result.
        wide = keyed.groupBy("_key").agg(F.approx_count_distinct("_url").alias("_urls")).where(F.col("_urls") > FOLD_URLS).select("_key")
        any_wide = not wide.isEmpty()
        few = gathered(later.join(wide, "_key", "left_anti"), wide) if any_wide else gathered(later)
        done = few.select("_first", _appended(own_url, F.col("_entries"), own_seen).alias("_whole"))
        if any_wide:
            done = done.unionByName(_of_wide_keys(later.join(wide, "_key", "left_semi"), winners and winners.join(wide, "_key", "left_semi"), own_url, own_seen, entry))
    changed = {url: F.col("_whole.url")} | ({} if grows is None else {grows: F.col("_whole.seen")})
    return done.select(first["ord"].alias("ord"), *[changed.get(f, first[f]).alias(f) for f in fields])


def unique_ranked(records: DataFrame, url_match: str = "substring") -> DataFrame:
    """One record per endpoint: the first of the highest confidence; URLs of records before it are lost, of later ones appended.

    ``url_match`` says when a URL is held already: ``substring`` of the joined string, or ``exact``.
    """
    ranks = F.create_map(*[F.lit(x) for pair in X.CONFIDENCE_RANK.items() for x in pair])
    rank = F.coalesce(F.try_element_at(ranks, F.col("confidence")), F.lit(-1))
    return _unique(records, record_key(), X.ENDPOINT_FIELDS, "source_url", rank, url_match == "substring")


def unique_first(records: DataFrame, url_match: str = "substring") -> DataFrame:
    """One record per endpoint: the first, with the URLs of later ones appended."""
    return _unique(records, record_key(), X.ENDPOINT_FIELDS, "source_url", None, url_match == "substring")


def unique_sites(sites: DataFrame, url_match: str = "substring") -> DataFrame:
    """One row per website domain, the first, with later profile URLs appended; blank and non-site domains go."""
    from gridloom.functions.endpoints import is_non_site_domain

    kept = sites.where((F.col("website_domain") != "") & ~is_non_site_domain(F.col("website_domain")))
    return _unique(kept, [F.col("website_domain")], X.SITE_FIELDS, "profile_url", None, url_match == "substring")


def merge_existing(existing: DataFrame, new: DataFrame, url_match: str = "substring") -> DataFrame:
    """Sites of an earlier run and new ones as one list; existing rows go first."""
    first = existing.withColumn("ord", F.struct(F.lit(0).alias("run"), F.col("ord")))
    return unique_sites(first.unionByName(new.withColumn("ord", F.struct(F.lit(1).alias("run"), F.col("ord")))), url_match)


def unique_nodes(nodes: DataFrame, url_match: str = "substring") -> DataFrame:
    """One row per (host, port, type), the first; later URLs are appended, and only with them may last_seen grow."""
    keys = [F.col(c) for c in ("node_host", "port", "node_type")]
    return _unique(nodes, keys, X.NODE_FIELDS, "source_url", None, url_match == "substring", "last_seen").drop("ord")
