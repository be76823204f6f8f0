"""Hosts: normalisation, and who covers whom."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip


def normalize_host(value: Column) -> Column:
    """The lower-case host of a URL or bare host without ``www.``; null where there is no host with a dot.

    Bracketed IPv6 addresses aren't hosts of companies and give null.
    """
    # Each step reads the one before once, so the expression stays small wherever it is used.
    text = F.regexp_replace(strip(value), r"(?s)^(?!.*//)", "//")
    net = F.regexp_extract(text, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(net, "^.*@", ""), ":.*$", "")
    host = F.lower(F.regexp_replace(host, r"^\.+|\.+$", ""))
    return F.nullif(F.regexp_extract(host, r"^(?:www\.)?(.*\..*)$", 1), F.lit(""))


def host_url(host: Column) -> Column:
    return F.concat(F.lit("https://"), host)


def covers(owner: Column, candidate: Column) -> Column:
    """Whether the candidate is the owner's host or below it; both are normalised here."""
    o, c = normalize_host(owner), normalize_host(candidate)
    return F.coalesce((c == o) | F.endswith(c, F.concat(F.lit("."), o)), F.lit(False))


def ends_with_any(host: Column, suffixes: list[str]) -> Column:
    """Suffixes are trimmed, lower-cased and begin with a dot; none match an empty list."""
    cleaned = [s.strip().lower() for s in suffixes if s.strip()]
    found = F.lit(False)
    for s in cleaned:
        found = found | F.endswith(host, F.lit(s if s.startswith(".") else f".{s}"))
    return F.coalesce(found, F.lit(False))


def dot_suffixes(host: Column) -> Column:
    """The host and every domain above it, so that coverage is an equality."""
    parts = F.split(host, "[.]")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def covered_by(candidates: DataFrame, host: str, owners: DataFrame, owner: str) -> DataFrame:
    """(host, owner) for each candidate host and owner that covers it, as an equi-join."""
    names = owners.select(F.col(owner).alias("owner")).where("owner is not null").distinct()
    up = candidates.select(F.col(host).alias("host")).where("host is not null").distinct()
    up = up.withColumn("suffix", F.explode(dot_suffixes(F.col("host"))))
    return up.join(names, F.col("suffix") == F.col("owner")).select("host", "owner")
