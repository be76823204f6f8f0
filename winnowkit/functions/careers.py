"""Careers pages behind posting URLs, by tables of what each source's URLs look like."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .hosts import host_url, normalize_host
from .text import once, strip, url_quote

_URL = r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def url_part(url: Column, which: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query; '' where absent."""
    return F.regexp_extract(url, _URL, which)


def _segments(path: Column) -> Column:
    return F.array_remove(F.split(path, "/"), "")


def _rebuilt(scheme: Column, net: Column, path: Column, query: Column | None = None) -> Column:
    whole = F.concat(scheme, F.lit("://"), net, F.when(F.startswith(path, F.lit("/")) | (path == ""), path).otherwise(F.concat(F.lit("/"), path)))
    return whole if query is None else F.when(query == "", whole).otherwise(F.concat(whole, F.lit("?"), query))


def _kept_query(query: Column, keep: list[str]) -> Column:
    """The listed parameters in their order, re-encoded; those without a value fall away."""
    if not keep:
        return F.lit("")
    clean = lambda x: F.coalesce(F.try_url_decode(x), x)
    name = lambda p: clean(F.substring_index(p, "=", 1))
    value = lambda p: F.when(F.instr(p, "=") > 0, clean(F.substring(p, F.instr(p, "=") + 1, F.length(p)))).otherwise("")
    pairs = F.filter(F.split(query, "&"), lambda p: name(p).isin(*keep) & (value(p) != ""))
    return F.array_join(F.transform(pairs, lambda p: F.concat(url_quote(name(p)), F.lit("="), url_quote(value(p)))), "&")


def careers_link(apply_url: Column, source: Column) -> Column:
    """struct<url, tier>: the page that lists the employer's postings, and how it was found."""
    return once(link_parts(apply_url, source), link_of)


def link_parts(apply_url: Column, source: Column) -> Column:
    """What ``link_of`` reads of a URL and its source; of many rows, make it a column first, so that both are compiled."""
    trimmed = strip(apply_url)
    return F.struct(
        apply_url.alias("raw"), F.lower(url_part(trimmed, 1)).alias("scheme"), url_part(trimmed, 2).alias("net"), url_part(trimmed, 3).alias("path"),
        url_part(trimmed, 4).alias("query"), F.lower(strip(F.coalesce(source, F.lit("")))).alias("key"), _segments(url_part(trimmed, 3)).alias("segments"),
    )


def link_of(p: Column) -> Column:
    """``careers_link`` of its parts."""
    scheme, net, path, key, segments = p["scheme"], p["net"], p["path"], p["key"], p["segments"]
    made = lambda url, tier: F.struct(url.cast("string").alias("url"), F.lit(tier).alias("tier"))
    as_posted = made(p["raw"], "posting")
    out = made(F.concat(scheme, F.lit("://"), net, F.lit("/")), "host")
    by_count: dict[int, list[str]] = {}
    for name, n in fixed.PATH_SEGMENTS.items():
        by_count.setdefault(n, []).append(name)
    for n, names in by_count.items():
        if n:
            kept = F.concat(F.lit("/"), F.array_join(F.slice(segments, 1, n), "/"), F.lit("/"))
            out = F.when(key.isin(*names) & (F.size(segments) >= n), made(_rebuilt(scheme, net, kept), "host_and_segments")).otherwise(out)
    out = F.when(key.isin(*fixed.POSTING_ONLY), as_posted).otherwise(out)
    for name, (keep, new_path, ends) in fixed.BOARDS.items():
        to = path
        if new_path is not None:
            to = F.lit(new_path)
        elif ends is not None:
            to = F.when(F.endswith(path, F.lit(ends[0])), F.concat(F.substring(path, F.lit(1), F.length(path) - len(ends[0])), F.lit(ends[1]))).otherwise(path)
        out = F.when(key == name, made(_rebuilt(scheme, net, to, _kept_query(p["query"], keep)), "board")).otherwise(out)
    for name, (marker, suffix) in fixed.SITE_PATHS.items():
        at = F.array_position(segments, marker)
        site = F.concat(F.lit("/"), F.array_join(F.concat(F.slice(segments, F.lit(1), (at + 1).cast("int")), F.array(F.lit(suffix))), "/"))
        found = F.when((at > 0) & (at < F.size(segments)), made(_rebuilt(scheme, net, site), "host_and_segments")).otherwise(as_posted)
        out = F.when(key == name, found).otherwise(out)
    usable = F.coalesce((net != "") & scheme.isin("http", "https"), F.lit(False))
    return F.when(usable, out).otherwise(made(F.lit(None), "none"))


def entry_url(careers_url: Column, company_host: Column) -> Column:
    """The page to open for an employer: a careers page on its own domain, else its home page; null without a host."""
    both = F.struct(normalize_host(company_host).alias("host"), normalize_host(url_part(careers_url, 2)).alias("at"), careers_url.alias("url"))

    def choose(b: Column) -> Column:
        own = (b["at"] == b["host"]) | F.endswith(b["at"], F.concat(F.lit("."), b["host"]))
        return F.when(b["host"].isNotNull(), F.when(own, b["url"]).otherwise(host_url(b["host"])))

    return once(both, choose)


def search_link(name: Column) -> Column:
    return F.concat(F.lit(fixed.SEARCH_ENGINE), url_quote(F.concat(name, F.lit(" careers"))))
