"""Landed search-result pages: embedded JSON, where the records are, and what totals are reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed


class PageError(ValueError):
    """A page that can't be read."""


class Blocked(PageError):
    """The site answered with a challenge: it turns automated clients away."""


class StaleBuild(PageError):
    """The data route refused the build id, or sent a page elsewhere: the site was deployed anew."""


class BadPage(PageError):
    """A page came, but not in the expected shape."""


def problems(pages: DataFrame) -> DataFrame:
    """(search, page, wrong) of the pages that can't be read. ``pages`` has payload, and may have status, mitigated and problem as they were received."""
    has = lambda c, kind: F.col(c) if c in pages.columns else F.lit(None).cast(kind)
    status, v = F.coalesce(has("status", "int"), F.lit(200)), F.try_parse_json("payload")
    props = F.try_variant_get(v, "$.pageProps", "variant")
    shape = lambda x: F.coalesce(F.schema_of_variant(x), F.lit(""))
    wrong = (
        F.when((status == 403) & (has("mitigated", "string") == "challenge"), "blocked: a challenge (403)")
        .when(has("problem", "string").isNotNull(), F.concat(F.lit("bad: "), has("problem", "string")))
        .when(status == 404, "stale: the build id was refused")
        .when(status != 200, F.concat(F.lit("bad: HTTP "), status.cast("string")))
        .when(v.isNull(), "stale: the response isn't JSON")
        .when(~F.startswith(shape(v), F.lit("OBJECT")), "bad: the payload isn't an object")
        .when(props.isNotNull() & ~F.startswith(shape(props), F.lit("OBJECT")), "bad: the payload has no usable pageProps")
        .when(F.try_variant_get(props, f"$.{fixed.REDIRECT_FIELD}", "variant").isNotNull(), "stale: the page was redirected")
    )
    return pages.select("search", "page", wrong.alias("wrong")).where("wrong is not null")


def error_of(search: object, page: int, wrong: str) -> PageError:
    kind, _, what = wrong.partition(": ")
    return {"blocked": Blocked, "stale": StaleBuild, "bad": BadPage}[kind](f"search {search}, page {page}: {what}")


def check(pages: DataFrame) -> None:
    """Raise the error of the first page that can't be read."""
    bad = problems(pages).orderBy("search", "page").first()
    if bad is not None:
        raise error_of(*bad)


def embedded(html: Column, begin: str | Column, end: str | Column) -> Column:
    """The text between the first ``begin`` and the next ``end``; null without both."""
    begin, end = F.lit(begin), F.lit(end)
    at = F.instr(html, begin)
    rest = F.substring(html, at + F.length(begin), F.length(html))
    return F.when((at > 0) & (F.instr(rest, end) > 0), F.substring(rest, F.lit(1), F.instr(rest, end) - 1))


def route(page: Column) -> Column:
    """The data route of a rendered page's name."""
    return F.coalesce(F.nullif(F.btrim(page, F.lit("/")), F.lit("")), F.lit("index"))


def next_data(html: Column) -> Column:
    """The JSON object that a rendered page carries, as text; the query fails where there is none."""
    text = embedded(html, fixed.PAGE_DATA_OPEN, fixed.PAGE_DATA_CLOSE)
    is_object = F.startswith(F.schema_of_variant(F.try_parse_json(text)), F.lit("OBJECT"))
    wrong = (
        F.when(F.instr(html, fixed.PAGE_DATA_OPEN) == 0, "a page carries no data")
        .when(text.isNull(), "a page's data has no end")
        .when(F.try_parse_json(text).isNull(), "a page's data isn't JSON")
        .when(~is_object, "a page's data isn't a JSON object")
    )
    return F.when(wrong.isNull(), text).otherwise(F.raise_error(wrong).cast("string"))


def _props(text: Column) -> Column:
    """Where records and totals stand: ``pageProps``, or the payload itself if it has none."""
    v = F.try_parse_json(text)
    own = F.try_variant_get(v, "$.pageProps", "variant")
    return F.when(own.isNotNull(), own).otherwise(v)


def _first_in_text(text: Column, names: Column) -> Column:
    """Of ``names``, the one that the JSON text has first as a key of the object that holds the records.

    VARIANT objects are sorted by name; the text still has the order in which they were sent.
    """
    keys = F.json_object_keys(F.coalesce(F.get_json_object(text, "$.pageProps"), text))
    return F.get(F.filter(keys, lambda k: F.array_contains(names, k)), F.lit(0))


def record_list(text: Column) -> Column:
    """The records of a payload as an array of VARIANT, by the rules of ``records``; items that are no objects are left in."""
    props = _props(text)
    is_object = F.coalesce(F.startswith(F.schema_of_variant(props), F.lit("OBJECT")), F.lit(False))
    usable = F.when(is_object, F.lit(True)).otherwise(F.raise_error(F.lit("a payload has no usable pageProps")).cast("boolean"))
    hits = F.try_variant_get(props, "$.ssrHits", "array<variant>")
    entries = F.map_entries(F.try_variant_get(props, "$", "map<string,variant>"))
    first = lambda e: F.get(F.try_variant_get(e["value"], "$", "array<variant>"), F.lit(0))
    # A key that is there with a null value counts: the item is told by its keys.
    has_id = lambda x: F.arrays_overlap(F.map_keys(F.try_variant_get(x, "$", "map<string,variant>")), F.array(F.lit("objectID"), F.lit("id")))
    names = F.transform(F.filter(entries, lambda e: F.coalesce(has_id(first(e)), F.lit(False))), lambda e: e["key"])
    chosen = _first_in_text(text, names)
    fallback = F.get(F.transform(F.filter(entries, lambda e: e["key"] == chosen), lambda e: F.try_variant_get(e["value"], "$", "array<variant>")), F.lit(0))
    return F.when(usable, F.coalesce(hits, fallback))


def records(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """One row a record: the columns of ``pages``, pos and record (VARIANT). ``payload`` is JSON text.

    ``ssrHits`` if that is a list, even an empty one; else the first list, in the order of the
    text, whose first item is an object with an id. They stand in ``pageProps``, or in the payload
    itself where it has none. Only objects are records. A payload whose ``pageProps`` is no object
    has no shape to read and fails the query.
    """
    others = [c for c in pages.columns if c != payload]
    found = pages.select(*others, F.posexplode(record_list(F.col(payload))).alias("pos", "record"))
    return found.where(F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")))


def reported_totals(payload: Column) -> Column:
    """map<string,double> of the numbers beside the records whose names look like totals. ``payload`` is JSON text."""
    props = F.map_entries(F.try_variant_get(_props(payload), "$", "map<string,variant>"))
    name = lambda e: F.lower(e["key"])
    total = lambda e: F.startswith(name(e), F.lit("nb")) | F.rlike(name(e), F.lit("total|count|numhits|numpages"))
    number = lambda e: F.rlike(F.schema_of_variant(e["value"]), F.lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"))
    kept = F.filter(props, lambda e: total(e) & F.coalesce(number(e), F.lit(False)))
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], F.try_variant_get(e["value"], "$", "double"))))
