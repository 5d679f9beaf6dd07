"""Promotion: seeds and discovered records, prepared and merged under precedence rules, with what changed."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X
from gridloom.operators import validate

NOTES_LENGTH = 900
EXAMPLES = 25
#: Finished records that a task hands on together.
FOLD_ROWS = 2000


def tagged(sources: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Labelled inputs (label, kind ``trusted`` or ``candidate``, records with ``ord``) as one table, in the given order."""
    parts = [
        df.select(F.lit(i + 1).alias("src_ord"), F.lit(label).alias("src_label"), F.lit(kind).alias("src_kind"), "ord", *X.ENDPOINT_FIELDS)
        for i, (label, kind, df) in enumerate(sources)
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _stays_candidate() -> Column:
    return (F.upper("coin") == "UNKNOWN") | (F.upper("algorithm") == "UNKNOWN") | E.is_ip_literal(F.col("domain"))


def prepare(records: DataFrame) -> DataFrame:
    """Discovered records (src_ord, src_label, src_kind, ord, the fields) normalised, demoted where they must be, with ``errors``.

    A candidate source, a probable record with one distinct URL, a confirmed one that is not official, an unknown coin or
    algorithm and a bare IP all make candidates of unknown status.
    """
    c = F.col
    one_url = (c("confidence") == "probable") & (F.size(E.split_source_urls(c("source_url"))) < 2)
    foreign = (c("confidence") == "confirmed") & ~F.coalesce(c("source_type") == "official", F.lit(False))
    low = F.coalesce((c("src_kind") == "candidate") | one_url | foreign, F.lit(False))
    first = records.withColumn("_low", low).withColumns({
        "notes": E.trimmed(F.coalesce("notes", F.lit(""))),
        "confidence": F.when(c("_low"), "candidate").otherwise(c("confidence")),
        "status": F.when(c("_low"), "unknown").otherwise(c("status")),
    })
    given = first.withColumns({"given_domain": F.coalesce("domain", F.lit("")), "given_port": F.coalesce(c("port").cast("string"), F.lit(""))})
    checked = E.once(validate.normalize(given), "_stays", (F.size("errors") == 0) & _stays_candidate())
    return checked.withColumns({
        "confidence": F.when(c("_stays"), "candidate").otherwise(c("confidence")),
        "status": F.when(c("_stays"), "unknown").otherwise(c("status")),
        "notes": F.trim(F.concat(c("notes"), F.lit(" auto_source="), c("src_label"))),
    }).drop("_low", "_stays")


def _rank(value: Column, ranks: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return F.coalesce(F.try_element_at(table, value), F.lit(-1))


def _merge(a: dict, x: dict) -> None:
    """Put the incoming record ``x`` into ``a``; ``a["urls"]`` holds the addresses in order, and stands for ``source_url`` from the first merge on."""
    raised = X.CONFIDENCE_RANK.get(x["confidence"], -1) > X.CONFIDENCE_RANK.get(a["confidence"], -1)
    if X.SOURCE_TYPE_RANK.get(x["source_type"], -1) > X.SOURCE_TYPE_RANK.get(a["source_type"], -1):
        a["source_type"] = x["source_type"]
    if raised:
        a["confidence"] = x["confidence"]
    for f in ("pool_name", "algorithm", "region"):
        if a[f] == "" or (raised and x[f] != ""):
            a[f] = x[f]
    a["urls"].update(dict.fromkeys(x["urls"]))
    a["first_seen"], a["last_seen"] = min(a["first_seen"], x["first_seen"]), max(a["last_seen"], x["last_seen"])
    notes = dict.fromkeys(n for n in (a["notes"].strip(" "), x["notes"].strip(" ")) if n)
    a["notes"], a["merged"] = " | ".join(notes)[:NOTES_LENGTH], True
    if a["coin"].upper() == "UNKNOWN" or a["algorithm"].upper() == "UNKNOWN" or a["is_ip"]:
        a["confidence"], a["status"] = "candidate", "unknown"
    elif a["confidence"] == "candidate" and len(a["urls"]) >= 2:
        a["confidence"], a["status"] = "probable", "active"
    else:
        a["status"] = "active" if a["confidence"] in ("confirmed", "probable") else "unknown"


def _folded(batches: Iterator) -> Iterator:
    """One row per key of rows that come key by key, in source and record order: the fields and ``change``. One record is held at a time."""
    import pyarrow as pa

    names = [*X.ENDPOINT_FIELDS, "change"]
    kinds = [pa.int32() if f == "port" else pa.string() for f in names]
    out: list[tuple] = []

    def emit() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def finished(a: dict) -> tuple:
        if a["merged"]:
            a["source_url"] = "; ".join(a["urls"])
        fields = tuple(a[f] for f in X.ENDPOINT_FIELDS)
        return (*fields, "inserted" if a["seed"] is None else "unchanged" if fields == a["seed"] else "updated")

    now, key = None, None
    for batch in batches:
        for x in batch.to_pylist():
            own = tuple(x[k] for k in validate.KEY)
            if own == key:
                _merge(now, x)
                continue
            if now is not None:
                out.append(finished(now))
                if len(out) >= FOLD_ROWS:
                    yield emit()
            seed = tuple(x[f] for f in X.ENDPOINT_FIELDS) if x["src_ord"] == 0 else None
            now, key = x | {"urls": dict.fromkeys(x["urls"]), "seed": seed, "merged": False}, own
    if now is not None:
        out.append(finished(now))
    if out:
        yield emit()


def promote(seeds: DataFrame, discovered: DataFrame) -> DataFrame:
    """Good seeds (normalised, ``ord``) and good prepared records merged by key, in source and record order.

    Returns the fields, ``change`` (inserted, updated or unchanged) and ``errors`` of the merged record. Of seeds with one key the
    last counts. The order of a key's records is part of the result, so they are folded one after another; they are not
    gathered: rows are dealt by key, sorted by key and order, and streamed past one record, whatever a key's share of the rows.
    """
    fields = (*E.record_key(), *[F.col(f) for f in X.ENDPOINT_FIELDS if f not in validate.KEY])
    last = seeds.groupBy(*E.record_key()).agg(F.max_by(F.struct(*X.ENDPOINT_FIELDS), "ord").alias("row")).select("row.*")
    first = last.select(*fields, F.lit(0).alias("src_ord"), F.lit(None).cast(discovered.schema["ord"].dataType).alias("ord"))
    rows = first.unionByName(discovered.select(*fields, "src_ord", "ord"))
    rows = rows.withColumns({"urls": E.split_source_urls(F.col("source_url")), "is_ip": E.is_ip_literal(F.col("domain"))})
    ordered = rows.repartition(*validate.KEY).sortWithinPartitions(*validate.KEY, "src_ord", "ord").drop("ord")
    schema = ", ".join(f"{f} {'int' if f == 'port' else 'string'}" for f in (*X.ENDPOINT_FIELDS, "change"))
    # A merge may break a rule that its parts kept (two retired records, a confirmed one without a web address).
    return validate.normalize(ordered.mapInArrow(_folded, schema))


def promotion_report(promoted: DataFrame) -> DataFrame:
    """Counts of a promotion as (metric, value, n): changes, confidence and status of the good records, records held back."""
    good = promoted.where(F.size("errors") == 0)
    each = good.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("metric"), F.col(c).alias("value"))
                for m, c in (("change", "change"), ("confidence", "confidence"), ("status", "status"))
            ])
        ).alias("x")
    )
    counts = each.groupBy("x.metric", "x.value").agg(F.count(F.lit(1)).alias("n"))
    totals = promoted.agg(F.count_if(F.size("errors") == 0).alias("library"), F.count_if(F.size("errors") > 0).alias("held_back"))
    totals = totals.select(F.inline(F.array(*[F.struct(F.lit("total").alias("metric"), F.lit(c).alias("value"), F.col(c).alias("n")) for c in totals.columns])))
    return counts.unionByName(totals)


def promotion_inputs(seeds: DataFrame, prepared: DataFrame) -> DataFrame:
    """What a promotion starts from as (metric, value, n): seeds, and the records of each source (``input``) with those left out (``skipped``)."""
    each = prepared.groupBy("src_label").agg(F.count(F.lit(1)).alias("input"), F.count_if(F.size("errors") > 0).alias("skipped"))
    counts = each.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col("src_label").alias("value"), F.col(c).alias("n")) for c in ("input", "skipped")])))
    total = seeds.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total").alias("metric"), F.lit("seeds").alias("value"), "n")
    return counts.unionByName(total)


def skip_examples(prepared: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """The first skipped records with their reasons, in source and record order."""
    reason = validate.error_message(F.lit(0), F.col("given_domain"), F.col("given_port"), F.col("errors"))
    bad = prepared.where(F.size("errors") > 0)
    return bad.orderBy("src_ord", "ord").limit(limit).select("src_label", F.col("given_domain").alias("domain"), reason.alias("reason"))


def retire_stale(library: DataFrame, as_of: str, cycle_days: int = 7, cycles: int = 2) -> DataFrame:
    """Records not seen for two maintenance cycles become retired in confidence and status."""
    stale = F.to_date("last_seen") < F.date_sub(F.to_date(F.lit(as_of)), cycle_days * cycles)
    return library.withColumns({f: F.when(stale, "retired").otherwise(F.col(f)) for f in ("confidence", "status")})


def confirmation_runs(sightings: DataFrame) -> DataFrame:
    """Runs of consecutive maintenance cycles in which an endpoint was confirmed: the key, first_cycle, last_cycle, cycles; one row per run.

    ``sightings`` have domain, port, scheme, coin and ``cycle``, a number that grows by one a cycle. Sightings of a cycle count once, so what
    meets in a key is bounded by the number of cycles, not by the number of rows.
    """
    seen = sightings.where("cycle IS NOT NULL").select(*E.record_key(), F.col("cycle").cast("long").alias("cycle")).distinct()
    # Cycles of one run differ from their own place in the key by the same number.
    place = F.row_number().over(Window.partitionBy(*validate.KEY).orderBy("cycle"))
    runs = seen.withColumn("_island", F.col("cycle") - place).groupBy(*validate.KEY, "_island")
    return runs.agg(F.min("cycle").alias("first_cycle"), F.max("cycle").alias("last_cycle"), F.count(F.lit(1)).alias("cycles")).drop("_island")


def retire_unconfirmed(library: DataFrame, sightings: DataFrame, latest: int, cycles: int = 2) -> DataFrame:
    """``library`` with ``missed``, the cycles up to ``latest`` since a record was last confirmed (null: never), and with those retired that missed ``cycles`` of them.

    A record that was confirmed in between stays, however long it was missing before. One that was never confirmed has missed all cycles.
    """
    last = confirmation_runs(sightings.where(F.col("cycle") <= latest)).groupBy(*validate.KEY).agg(F.max("last_cycle").alias("_last"))
    keyed = library.withColumn("coin_key", F.upper("coin"))
    missed = (F.lit(latest) - F.col("_last")).alias("missed")
    joined = keyed.join(last, list(validate.KEY), "left").select(*[F.col(c) for c in library.columns], missed)
    stale = F.col("missed").isNull() | (F.col("missed") >= cycles)
    return joined.withColumns({f: F.when(stale, "retired").otherwise(F.col(f)) for f in ("confidence", "status")})


def change_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """How many endpoints were added, deleted, upgraded or downgraded between two libraries: (change, n)."""
    side = lambda df, name: df.select(*E.record_key(), _rank(F.col("confidence"), X.CONFIDENCE_RANK).alias(name))
    both = side(before, "old").join(side(after, "new"), list(validate.KEY), "full_outer")
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "deleted").when(F.col("new") > F.col("old"), "upgraded")
        .when(F.col("new") < F.col("old"), "downgraded").otherwise("kept")
    )
    return both.groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("n"))
