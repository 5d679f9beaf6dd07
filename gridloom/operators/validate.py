"""Validation of endpoint records, the duplicate check, the library and its watchlist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions import endpoints as E
from gridloom.functions import fixed as X

KEY = ("domain", "port", "scheme", "coin_key")


def normalize(records: DataFrame) -> DataFrame:
    """``records`` (the fourteen fields, port as string or integer, any others kept) normalised, with ``errors``.

    ``errors`` lists what is wrong with a record, in a fixed order; good records have an empty list. A blank domain or a
    port that is no integer is the only error of its record. Missing and null fields count as ``""``.
    """
    given = {f: F.coalesce(F.col(f).cast("string"), F.lit("")) for f in X.ENDPOINT_FIELDS}
    parsed = E.parse_endpoints(records, "_parsed", F.col("domain"), F.col("port"), F.col("scheme"))
    parsed = parsed.withColumn("_given_port", given["port"]).withColumn("_given_domain", given["domain"])
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    fields: dict[str, Column] = {f: E.trimmed(given[f]) for f in X.ENDPOINT_FIELDS}
    fields |= {f: E.trimmed(low(F.col(f))) for f in ("source_type", "confidence", "status")}
    fields |= {"domain": E.trimmed(F.coalesce("_parsed.domain", F.lit(""))), "port": F.col("_parsed.port"), "scheme": E.trimmed(low(F.col("_parsed.scheme")))}
    clean = E.once(parsed.withColumns(fields), "_ip", E.is_ip_literal(F.col("domain")))
    return E.once(clean, "errors", _errors()).drop("_parsed", "_given_port", "_given_domain", "_ip")


def _errors() -> Column:
    c = F.col

    def enum(name: str, allowed: tuple[str, ...]) -> Column:
        return F.when(~c(name).isin(*allowed), f"{name} must be one of: {', '.join(sorted(allowed))}")

    required = [F.when((c(f) == "") if f != "port" else c(f).isNull(), f"{f} is required") for f in X.ENDPOINT_FIELDS if f != "notes"]
    checks = [
        F.when(
            ~(c("domain").rlike(X.DOMAIN) | F.coalesce(c("_ip"), F.lit(False))),
            F.concat(F.lit("domain is not a valid normalized FQDN or IP literal: "), c("domain")),
        ),
        F.when(
            ~F.coalesce(c("port").between(1, 65535), F.lit(False)),
            F.concat(F.lit("port must be an integer from 1 to 65535: "), c("_given_port")),
        ),
        enum("scheme", X.SCHEMES),
        enum("source_type", X.SOURCE_TYPES),
        enum("confidence", X.CONFIDENCE),
        enum("status", X.STATUS),
        *required,
        *[F.when(~c(f).rlike(X.DATE), f"{f} must use YYYY-MM-DD") for f in ("first_seen", "last_seen")],
        F.when(c("domain").rlike(r"(?U)[/@\s]"), "domain must not contain scheme, path, userinfo, or whitespace"),
        F.when((c("confidence") == "confirmed") & (c("source_type") != "official"), "confirmed records must use source_type=official"),
        F.when(
            (c("confidence") == "confirmed") & ~c("source_url").startswith("http"),
            "confirmed records must include an official source_url",
        ),
        F.when(
            (c("confidence") == "probable") & (E.count_source_urls(c("source_url")) < 2),
            "probable records must include at least two source URLs separated by semicolons",
        ),
        F.when((c("confidence") == "retired") & (c("status") != "retired"), "retired confidence records must use status=retired"),
    ]
    found = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return F.when(c("_parsed.error").isNotNull(), F.array(c("_parsed.error"))).otherwise(found)


def error_message(index: Column, domain: Column, port: Column, errors: Column) -> Column:
    """The text of a failed validation: record number, its raw key, and one line per error."""
    head = F.concat(F.lit("Record "), (index + 1).cast("string"), F.lit(" ("), domain, F.lit(":"), port, F.lit(") failed validation:\n- "))
    return F.concat(head, F.array_join(errors, "\n- "))


def good(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.size("errors") == 0).drop("errors")


def quarantine(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.size("errors") > 0)


def duplicate_keys(records: DataFrame) -> DataFrame:
    """Keys (domain, port, scheme, coin in upper case) that more than one record has, with their number."""
    return records.groupBy(*E.record_key()).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def require_unique(records: DataFrame) -> DataFrame:
    """``records``, or an error that names a key which two of them share."""
    if clash := duplicate_keys(records).limit(1).collect():
        raise ValueError("Duplicate record: " + "|".join(str(clash[0][k]) for k in KEY))
    return records


def library(records: DataFrame) -> DataFrame:
    """Records in published order; for the sink only, as it sorts the whole table."""
    return records.select(*X.ENDPOINT_FIELDS).orderBy("pool_name", "coin", "domain", "port", "scheme")


def watchlist(records: DataFrame) -> DataFrame:
    """What alerts may rest on: active records that are confirmed or probable."""
    return records.where((F.col("status") == "active") & F.col("confidence").isin("confirmed", "probable"))
