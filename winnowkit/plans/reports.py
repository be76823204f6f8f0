"""Reports: page rows as column expressions, page assembly, and small diagnostics."""

from __future__ import annotations

import json
from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.careers import careers_link, entry_url, search_link
from ..functions.keys import posting_key
from ..functions.text import dollars, html_escape, strip
from ..operators.rules import shortlist_order
from ..operators.timeline import number
from ..operators.visited import applied_companies
from ..tables import settle


def _text(c: str) -> Column:
    return F.coalesce(strip(F.col(c)), F.lit(""))


def _or(value: Column, other: str) -> Column:
    return F.when(value == "", F.lit(other)).otherwise(value)


def _td(value: Column, kind: str = "") -> Column:
    return F.concat(F.lit(f'<td class="{kind}">' if kind else "<td>"), value, F.lit("</td>"))


def _flag(value: Column) -> Column:
    return F.concat(F.lit('<span class="flag">'), value, F.lit("</span>"))


def _queued(url: Column, key: Column, label: Column) -> Column:
    return F.concat(F.lit('<a href="'), html_escape(url), F.lit('" data-visit-open data-visit-key="'), html_escape(key), F.lit('" data-visit-mark="auto">'), label, F.lit("</a>"))


def _capped(items: Column, shown: Column, n: int) -> Column:
    more = F.when(F.size(items) > n, F.concat(F.lit(" +"), (F.size(items) - n).cast("string"))).otherwise("")
    return F.concat(F.array_join(F.slice(shown, 1, n), ", "), more)


def pay_cell() -> Column:
    low, high = F.col("comp_min"), F.col("comp_max")
    amount = F.when(low.isNotNull() & (low != high), F.concat(dollars(low), F.lit(" - "), dollars(high))).otherwise(dollars(high))
    flags = F.array_compact(
        F.array(
            F.when(F.col("comp_frequency") == "Hourly", "hourly"),
            F.when(F.col("city_count") >= fixed.REPORT_WIDE_CITIES, F.concat(F.col("city_count").cast("string"), F.lit(" metros"))),
        )
    )
    flagged = F.when(F.size(flags) > 0, F.concat(F.lit(" "), _flag(F.concat(F.lit("("), F.array_join(flags, ", "), F.lit(")"))))).otherwise("")
    return F.when(high.isNull(), '<span class="unknown">not stated</span>').otherwise(F.concat(amount, flagged))


def place_cell() -> Column:
    shown = _capped(F.col("cities"), F.transform("cities", lambda c: F.substring_index(c, ",", 1)), fixed.CITIES_SHOWN)
    return F.concat(_or(html_escape(shown), "-"), F.lit("<br>"), _flag(html_escape(_text("workplace_type"))))


def seniority_cell() -> Column:
    years = F.when(F.col("min_years_experience").isNotNull(), F.concat(F.lit(" "), _flag(F.concat(F.col("min_years_experience").cast("string"), F.lit("y+"))))).otherwise("")
    return F.concat(html_escape(_or(_text("seniority_level"), "-")), years)


def tools_cell() -> Column:
    return F.when(F.size("tools") == 0, '<span class="unknown">none listed</span>').otherwise(html_escape(_capped(F.col("tools"), F.col("tools"), fixed.TOOLS_SHOWN)))


def band_cell() -> Column:
    band = html_escape(F.col("band"))
    why = F.when(F.size("demote_reasons") > 0, F.concat(F.lit("<br>"), _flag(html_escape(F.array_join("demote_reasons", ", "))))).otherwise("")
    return F.concat(F.lit('<span class="band '), band, F.lit('">'), band, F.lit("</span>"), why)


def apply_cell() -> Column:
    url = F.coalesce(F.nullif(_text("apply_url"), F.lit("")), F.get("alternate_apply_urls", F.lit(0)))
    label = F.concat(F.lit("apply"), F.when(F.size("alternate_apply_urls") > 0, F.concat(F.lit(" "), _flag(F.concat(F.lit("+"), F.size("alternate_apply_urls").cast("string"))))).otherwise(""))
    keyless = F.concat(F.lit('<a href="'), html_escape(url), F.lit('" data-visit-open>'), label, F.lit("</a>"))
    keyed = _queued(url, posting_key(_text("object_id")), label)
    return F.when(url.isNull(), '<span class="unknown">-</span>').when(_text("object_id") == "", keyless).otherwise(keyed)


def employer_cell() -> Column:
    name = _or(html_escape(F.col("company")), "(unnamed)")
    link = careers_link(F.nullif(_text("apply_url"), F.lit("")), F.col("source"))["url"]
    url = entry_url(link, F.col("company_host"))
    sent = F.when(F.col("company_applied"), '<br><span class="applied">resume sent</span>').otherwise("")
    return F.when(url.isNull(), name).otherwise(F.concat(_queued(url, F.col("company_host"), name), sent))


def shortlist_rows(screened: DataFrame, applied_hosts: DataFrame, bands: tuple[str, ...] = ("strong", "possible")) -> DataFrame:
    """(n, row): table rows in order. Columns that the cells read and the input lacks are null."""
    rows = screened.where(F.col("band").isin(*bands))
    for c, kind in (("workplace_type", "string"), ("min_years_experience", "int")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    rows = applied_companies(rows, applied_hosts)
    numbered = number(rows, shortlist_order(lower_company=True))
    title = F.coalesce(F.nullif(html_escape(F.col("raw_title")), F.lit("")), _or(html_escape(F.col("title")), "(untitled)"))
    day = F.substring(_text("published_at"), 1, 10)
    cells = F.concat(
        _td(F.col("n").cast("string"), "num"), _td(band_cell()), _td(title), _td(employer_cell()), _td(pay_cell(), "num"), _td(seniority_cell()),
        _td(place_cell()), _td(tools_cell(), "tools"), _td(_or(html_escape(day), "-"), "num"), _td(apply_cell(), "num"),
    )
    return numbered.select("n", F.concat(F.lit('<tr class="'), html_escape(F.col("band")), F.lit('">'), cells, F.lit("</tr>")).alias("row"))


def company_rows(companies: DataFrame) -> DataFrame:
    """(n, row): nearest first, unknown distances last, ties in input order."""
    numbered = number(companies, [F.col("distance_miles").asc_nulls_last(), F.col("ord").asc()])
    name = F.coalesce(F.nullif(html_escape(F.col("name")), F.lit("")), F.nullif(html_escape(F.col("website_host")), F.lit("")), F.lit("(unnamed)"))
    url = entry_url(F.col("careers_url"), F.col("website_host"))
    listed = F.transform("locations", lambda x: strip(F.substring_index(x, ",", 1)))
    shown = F.array_join(F.transform(F.slice("sample_titles", 1, fixed.SAMPLE_TITLES), html_escape), "<br>")
    posts = F.concat(F.col("posting_count").cast("string"), F.when(F.col("software_posting_count") > 0, F.concat(F.lit(" ("), F.col("software_posting_count").cast("string"), F.lit(" sw)"))).otherwise(""))
    career = F.when(_text("careers_url") == "", "-").otherwise(F.concat(F.lit('<a href="'), html_escape(F.col("careers_url")), F.lit('">careers</a>')))
    cells = F.concat(
        _td(F.col("n").cast("string")), _td(F.when(F.col("distance_miles").isNotNull(), F.format_string("%.1f", F.col("distance_miles"))).otherwise("-"), "num"), _td(career),
        _td(F.when(url.isNull(), name).otherwise(_queued(url, F.col("website_host"), name))),
        _td(F.concat(F.lit('<a href="'), html_escape(search_link(F.coalesce(F.nullif(_text("name"), F.lit("")), _text("website_host")))), F.lit('">search</a>'))),
        _td(_or(html_escape(F.array_join(listed, ", ")), "-")), _td(posts, "num"), _td(_or(shown, "-"), "titles"),
        _td(_or(html_escape(F.substring(_text("latest_published_at"), 1, 10)), "-"), "num"),
    )
    return numbered.select("n", F.concat(F.lit("<tr>"), cells, F.lit("</tr>")).alias("row"))


STYLE = "body { font-family: sans-serif } table { border-collapse: collapse } th, td { border: 1px solid #ccc; padding: 4px } td.num { text-align: right }"
COMPANY_HEADERS = ["#", "Miles", "Careers", "Company", "Find", "Locations", "Posts", "Sample titles", "Latest"]
SHORTLIST_HEADERS = ["#", "Band", "Title", "Company", "Compensation", "Seniority", "Location", "Tools", "Posted", "Apply"]


def write_page(rows: DataFrame, headers: list[str], title: str, path: str, said: str, note: str = "") -> int:
    """Write a page to a local file, row by row as they come from the tasks; the number of rows. ``said`` may name it as {n}."""
    import html
    from datetime import datetime

    n = rows.count()
    head = "".join(f"<th>{html.escape(h)}</th>" for h in headers)
    said = f"{said.replace('{n}', str(n))} Generated {datetime.now():%Y-%m-%d %H:%M}."
    with open(path, "w", encoding="utf-8") as out:
        out.write(f'<!DOCTYPE html>\n<html lang="en"><head><meta charset="utf-8"><title>{html.escape(title)}</title><style>{STYLE}</style></head>\n<body><h1>{html.escape(title)}</h1>\n')
        out.write("".join(f'<p class="meta">{html.escape(x)}</p>\n' for x in (said, note) if x))
        out.write(f"<table><thead><tr>{head}</tr></thead><tbody>\n")
        for r in rows.orderBy("n").toLocalIterator():
            out.write(r["row"] + "\n")
        out.write("</tbody></table></body></html>\n")
    return n


def search_url(site: str, state: dict) -> str:
    """The link that opens a search by hand."""
    return f"{site.rstrip('/')}{fixed.SEARCH_PATH}?{urlencode({'searchState': json.dumps(state, separators=(',', ':'), ensure_ascii=False)})}"


def daily_histogram(rows: DataFrame, date: str, width: int = fixed.BAR_WIDTH) -> DataFrame:
    """(day, n, bar): counts by day with a bar scaled to the busiest, at least one sign long."""
    days = rows.where(F.coalesce(F.col(date), F.lit("")) != "").groupBy(F.substring(date, 1, 10).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    days = settle(days, "days")  # a row a day
    top = days.agg(F.max("n")).first()[0] or 1
    signs = F.greatest(F.lit(1), F.bround(F.col("n") / F.lit(top) * width).cast("int"))
    return days.select("day", "n", F.repeat(F.lit("#"), signs).alias("bar"))


def top(rows: DataFrame, column: str, n: int) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column)).limit(n)


def share(part: Column, whole: Column) -> Column:
    """A percentage with one decimal; a dash for a share of nothing."""
    return F.when(whole == 0, "-").otherwise(F.concat(F.format_number(part / whole * 100, 1), F.lit("%")))


def coverage_verdict(companies: int, reported: float | None) -> str:
    """How much of the reported companies a run has."""
    if not reported or not companies:
        return "unknown"
    part = companies / reported
    return "complete" if part >= fixed.COVERAGE_COMPLETE else "partial" if part >= fixed.COVERAGE_PARTIAL else "thin"
