"""Captured result pages: the latest capture of each page, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_pages(pages: DataFrame) -> DataFrame:
    """One row for each (state, page): the latest by captured_at; of equal stamps, the later entry (pos)."""
    rest = [c for c in pages.columns if c not in ("state", "page")]
    best = F.max_by(F.struct(*rest), F.struct("captured_at", "pos"))
    return pages.groupBy("state", "page").agg(best.alias("r")).select("state", "page", "r.*")


def end_markers(ends: DataFrame) -> DataFrame:
    """The last end marker of each state: (state, page, reason)."""
    return ends.groupBy("state").agg(F.max_by(F.struct("page", "reason"), "pos").alias("e")).select("state", "e.*")


def summary(pages: DataFrame) -> DataFrame:
    """(state, pages, last_page, missing, first_at, last_at, span_hours) of the latest pages; stamps that can't be read have no time."""
    at = F.try_to_timestamp("captured_at") if dict(pages.dtypes)["captured_at"] == "string" else F.col("captured_at").cast("timestamp")
    seen = pages.groupBy("state").agg(
        F.count(F.lit(1)).alias("pages"), F.max("page").alias("last_page"), F.array_sort(F.collect_set("page")).alias("numbers"),
        F.min("captured_at").alias("first_at"), F.max("captured_at").alias("last_at"),
        F.when(F.count(at) > 1, (F.unix_micros(F.max(at)) - F.unix_micros(F.min(at))) / F.lit(3.6e9)).otherwise(0.0).alias("span_hours"),
    )
    gaps = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.col("last_page").cast("bigint")), F.col("numbers").cast("array<bigint>"))
    return seen.withColumn("missing", gaps).drop("numbers")


def match(searches: DataFrame, captures: DataFrame) -> DataFrame:
    """Configured searches (name, base) with the capture (base, window, state, pos) that serves them.

    States are compared without their window; of several captures the widest window wins, a missing
    one counting as zero, then the first. A search that nothing serves has a null state.
    """
    order = F.struct(F.coalesce("window", F.lit(0)).cast("bigint"), (-F.col("pos")).alias("first"))
    best = captures.groupBy("base").agg(F.max_by(F.struct("state", "window"), order).alias("c"))
    return searches.join(best, "base", "left").select("name", "base", "c.state", "c.window")


def unmatched(searches: DataFrame, captures: DataFrame) -> DataFrame:
    used = match(searches, captures).select("state")
    return captures.join(used, "state", "left_anti")


def replay(pages: DataFrame, max_pages: int) -> DataFrame:
    return pages.where(F.col("page") <= max_pages)


def complete(pages: DataFrame, records: DataFrame, ends: DataFrame) -> DataFrame:
    """(state, last_page_records, complete): whether the last page of results was captured.

    It was if the highest page has no records, or the end was seen on that very page. ``pages`` are
    the latest (state, page), ``records`` theirs, ``ends`` the last end markers.
    """
    last = pages.groupBy("state").agg(F.max("page").alias("page"))
    n = records.groupBy("state", "page").agg(F.count(F.lit(1)).alias("n"))
    found = last.join(n, ["state", "page"], "left").join(ends.select("state", F.col("page").alias("end")), "state", "left")
    n = F.coalesce("n", F.lit(0))
    return found.select("state", n.alias("last_page_records"), ((n == 0) | F.coalesce(F.col("end") == F.col("page"), F.lit(False))).alias("complete"))


def gap_days(previous: Column, started: Column) -> Column:
    """Days from the end of the run before to a capture's first page."""
    return (F.unix_micros(started) - F.unix_micros(previous)) / F.lit(86_400e6)
