"""Capture files: pages that a browser saw, with the state of the search they belong to."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed


class BadCapture(ValueError):
    """A capture file breaks its format."""


def state_key(state: dict, without: str | None = None) -> str:
    """Canonical JSON of a search state, sorted keys; ``without`` leaves one field out."""
    return json.dumps({k: v for k, v in state.items() if k != without}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit(""))


def _field(name: str) -> Column:
    return F.try_variant_get("p", f"$.{name}", "variant")


def _text(name: str) -> Column:
    return F.when(_kind(_field(name)) == "STRING", F.try_variant_get("p", f"$.{name}", "string"))


def _entries(files: DataFrame, name: str) -> DataFrame:
    """(path, pos, text, p): the items of a list of each file, as JSON text and as VARIANT."""
    listed = F.from_json(F.col("value"), f"{name} array<string>")[name]
    return files.select("path", F.posexplode(listed).alias("pos", "text")).withColumn("p", F.try_parse_json("text"))


def _refuse(rows: DataFrame, problem: Column) -> None:
    bad = rows.withColumn("problem", problem).where("problem is not null").orderBy("path", "pos").first()
    if bad is not None:
        raise BadCapture(f"{bad['path']}: {bad['problem']} ({bad['pos']})")


def _is_object(v: Column) -> Column:
    return F.startswith(_kind(v), F.lit("OBJECT"))


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pages, ends): pages (pos, state, page, captured_at, source, build_id, payload), ends (pos, state, page, reason).

    ``state`` is JSON with sorted keys, ``payload`` JSON text as it came. A missing stamp or build
    id is an empty string. A file that breaks the format is refused as a whole.
    """
    whole = spark.read.option("wholetext", "true").text(path).select(F.col("_metadata.file_path").alias("path"), "value", F.lit(0).alias("pos"))
    v = F.try_parse_json("value")
    at = lambda f: F.try_variant_get(v, f"$.{f}", "variant")
    listed = lambda f: F.startswith(_kind(at(f)), F.lit("ARRAY"))
    _refuse(
        whole,
        F.when(v.isNull(), "not JSON")
        .when(~F.endswith(F.coalesce(F.try_variant_get(v, "$.format", "string"), F.lit("")), F.lit(fixed.CAPTURE_FORMAT)), "not a capture file")
        .when(~listed("pages"), "pages isn't a list")
        .when(~listed("ends") & ~_kind(at("ends")).isin("", "VOID"), "ends isn't a list"),
    )
    state = _field("searchState")
    no_state = ~_is_object(state) | (F.to_json(state) == "{}")
    no_number = (_kind(_field("page")) != "BIGINT") | (F.try_variant_get("p", "$.page", "bigint") < 0)
    pages = _entries(whole, "pages")
    _refuse(
        pages,
        F.when(~_is_object(F.col("p")), "a page isn't an object")
        .when(no_state, "a page has no search state")
        .when(no_number, "a page has no valid number")
        .when(~_is_object(F.try_variant_get("p", "$.payload.pageProps", "variant")), "a page has no pageProps payload")
        .when(F.try_variant_get("p", f"$.payload.pageProps.{fixed.REDIRECT_FIELD}", "variant").isNotNull(), "a page is a redirect"),
    )
    ends = _entries(whole, "ends")
    _refuse(ends, F.when(~_is_object(F.col("p")) | ~_is_object(state) | (_kind(_field("page")) != "BIGINT"), "an end needs a search state and a page number"))
    empty = F.lit("")
    payload = F.from_json("text", "payload string")["payload"]
    return (
        pages.select(
            "pos", F.to_json(state).alias("state"), F.try_variant_get("p", "$.page", "bigint").alias("page"), F.coalesce(_text("captured_at"), empty).alias("captured_at"),
            F.coalesce(_text("source"), empty).alias("source"), F.coalesce(_text("build_id"), empty).alias("build_id"), payload.alias("payload"),
        ),
        ends.select("pos", F.to_json(state).alias("state"), F.try_variant_get("p", "$.page", "bigint").alias("page"), F.coalesce(F.try_variant_get("p", "$.reason", "string"), empty).alias("reason")),
    )


def states(pages: DataFrame) -> DataFrame:
    """(state, base, window, pos): each captured search once, without its window and with it. There are few: searches are set up by hand."""
    rows = []
    for r in pages.groupBy("state").agg(F.min("pos").alias("pos")).orderBy("pos").collect():
        state = json.loads(r["state"])
        window = state.get(fixed.WINDOW_FIELD)
        rows.append((r["state"], state_key(state, fixed.WINDOW_FIELD), window if isinstance(window, int) and not isinstance(window, bool) else None, r["pos"]))
    return pages.sparkSession.createDataFrame(rows, "state string, base string, window bigint, pos int")
