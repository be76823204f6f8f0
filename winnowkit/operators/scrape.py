"""Landed result pages: which were read before the stop, and which records are first of their kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed


def land(rows: DataFrame, pages: DataFrame | None = None, max_pages: int | None = None) -> DataFrame:
    """Records (search, page, pos, key) with is_new (to its search), stop_page and written (first of the run).

    A search stops at its first page without records, or at the second page in a row that brought
    nothing new to it. Records without a key always count as new. ``pages`` (search, page) names
    pages that came back, empty ones too; without it, the pages are those of the records. No page
    after number ``max_pages`` is read. The place (search, page, pos) tells a record: what is first of
    its kind is found by minima, which combine map-side, and brought back by its place, so that
    a key with very many records is no one task's burden.
    """
    if max_pages is not None:
        rows, pages = rows.where(F.col("page") <= max_pages), None if pages is None else pages.where(F.col("page") <= max_pages)
    keyless = F.col("key").isNull()
    marked = _mark_first(rows, ["search", "key"], "_own").withColumn("is_new", keyless | F.col("_own")).drop("_own")
    stops = _stops(marked, pages).select("search", "stop_page")
    kept = marked.join(stops, "search").where(F.col("page") <= F.col("stop_page"))
    return _mark_first(kept, ["key"], "_run").withColumn("written", F.col("is_new") & (keyless | F.col("_run"))).drop("_run")


def _mark_first(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with a flag: whether the record is the first, by place, with its ``by`` and a key."""
    place = ["search", "page", "pos"]
    first = rows.where(F.col("key").isNotNull()).groupBy(*by).agg(F.min(F.struct(*place)).alias("f"))
    first = first.select(*[F.col(f"f.{c}").alias(f"_f_{c}") for c in place])
    same = F.lit(True)
    for c in place:
        same = same & (rows[c] == first[f"_f_{c}"])
    return rows.join(first, same, "left").withColumn(name, F.col("_f_pos").isNotNull()).drop(*[f"_f_{c}" for c in place])


def _counts(marked: DataFrame, pages: DataFrame | None) -> DataFrame:
    """(search, page, n, new) of all pages."""
    counts = marked.groupBy("search", "page").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_new").alias("new"))
    if pages is None:
        return counts
    return pages.select("search", "page").distinct().join(counts, ["search", "page"], "left").fillna(0, ["n", "new"])


def _stops(marked: DataFrame, pages: DataFrame | None) -> DataFrame:
    """(search, stop_page, cause): the page that ended each search, and whether it was empty, stale, or just the last."""
    before = F.lag("new").over(Window.partitionBy("search").orderBy("page"))
    cause = F.when(F.col("n") == 0, "empty").when((F.col("new") == 0) & (F.col("before") == 0), "stale")
    ended = _counts(marked, pages).withColumn("before", before).withColumn("cause", cause)
    first = F.min(F.when(F.col("cause").isNotNull(), F.struct("page", "cause")))
    return ended.groupBy("search").agg(first.alias("f"), F.max("page").alias("last")).select(
        "search", F.coalesce("f.page", "last").alias("stop_page"), F.coalesce("f.cause", F.lit("last")).alias("cause")
    )


def search_results(landed: DataFrame, pages: DataFrame, max_pages: int) -> DataFrame:
    """(search, pages_fetched, stop_reason) of landed searches; ``pages`` are those that came back."""
    read = pages.select("search", "page").distinct().where(F.col("page") <= max_pages)
    stops = _stops(landed, read)
    # What a search read after its stop is not in ``landed``, so a later page looks empty; the stop comes first.
    fetched = read.join(stops, "search").where(F.col("page") <= F.col("stop_page")).groupBy("search", "cause").agg(F.count(F.lit(1)).alias("pages_fetched"))
    reason = (
        F.when(F.col("cause") == "empty", "empty page")
        .when(F.col("cause") == "stale", f"{fixed.EMPTY_PAGES_TO_STOP} consecutive pages with no new records")
        .when(F.col("pages_fetched") > max_pages, f"reached max_pages={max_pages}")
        .otherwise("no more pages")
    )
    return fetched.select("search", "pages_fetched", reason.alias("stop_reason"))


def stop_reason(searches: list[tuple[str, str]]) -> str:
    """One search's reason as it is; several, each with its name."""
    if len(searches) == 1:
        return searches[0][1]
    return "; ".join(f"{name}: {reason}" for name, reason in searches) or "unknown"


def totals(reported: DataFrame) -> DataFrame:
    """(search, name, value) of (search, page, totals: map<string,double>): the last page that reports a total has it."""
    each = reported.select("search", "page", F.explode("totals").alias("name", "value"))
    return each.groupBy("search", "name").agg(F.max_by("value", "page").alias("value"))


def total_of(found: DataFrame, name: str) -> DataFrame:
    """One row (total): one total summed over searches, null where none reported it."""
    return found.where(F.col("name") == name).agg(F.sum("value").alias("total"))


def page_counts(landed: DataFrame) -> DataFrame:
    """(search, page, received, new, written)."""
    return landed.groupBy("search", "page").agg(
        F.count(F.lit(1)).alias("received"), F.count_if("is_new").alias("new"), F.count_if("written").alias("written")
    )


def search_counts(landed: DataFrame) -> DataFrame:
    """(search, stop_page, received, unique, overlap, keyless): overlap counts what an earlier search had."""
    return landed.groupBy("search").agg(
        F.max("stop_page").alias("stop_page"), F.count(F.lit(1)).alias("received"), F.count_if("is_new").alias("unique_records"),
        F.count_if(F.col("is_new") & ~F.col("written")).alias("overlap"), F.count_if(F.col("key").isNull()).alias("keyless"),
    )


def union_searches(parts: list[DataFrame], key: str) -> DataFrame:
    """Rows of several searches, one for each key; the first search that has it wins."""
    out = None
    for i, part in enumerate(parts):
        part = part.withColumn("search", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(key).agg(F.min_by(F.struct(*[c for c in out.columns if c != key]), "search").alias("r")).select(key, "r.*")


def previous_runs(metas: DataFrame) -> DataFrame:
    """The latest run that has records and no error."""
    return metas.where((F.col("records") > 0) & F.col("error").isNull()).agg(F.max_by(F.struct(*metas.columns), "finished_at").alias("m")).select("m.*")


def uncovered(runs: DataFrame) -> DataFrame:
    """(search, day, closing_window): days that no run of a search covers, and the window in days with which its latest run would have closed the whole gap.

    ``runs`` is (search, finished: date, window: days); a run covers the days from finished - window on. Days before the first
    covered one are no gap. Of runs that begin on the same day the one that reaches farthest counts, so that a search has
    at most a row a day before it is put in order.
    """
    spans = runs.where(F.col("finished").isNotNull() & (F.col("window") >= 0)).select("search", F.date_sub("finished", F.col("window").cast("int")).alias("begin"), "finished")
    spans = spans.groupBy("search", "begin").agg(F.max("finished").alias("end"))
    order = Window.partitionBy("search").orderBy("begin")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    latest = F.max("end").over(Window.partitionBy("search"))
    gaps = spans.select("search", F.date_add(before, 1).alias("first"), F.date_sub("begin", 1).alias("last"), latest.alias("latest")).where("first <= last")
    return gaps.select("search", F.explode(F.sequence("first", "last")).alias("day"), F.datediff("latest", F.col("first")).alias("closing_window"))
