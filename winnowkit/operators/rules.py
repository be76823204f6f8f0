"""Screening: every reason that applies, in a fixed order, then a band. All of it is one projection."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.hosts import ends_with_any
from ..functions.text import folded, level_signature, says
from ..tables import computed


@dataclass(frozen=True)
class Screen:
    comp_floor: int = fixed.COMP_FLOOR
    comp_min_floor: int = fixed.COMP_MIN_FLOOR
    wide_geography_cities: int = fixed.WIDE_GEOGRAPHY_CITIES
    blocked_companies: tuple[str, ...] = ()


Rule = tuple[str, Callable[[Screen], Column]]


def clearance_text() -> Column:
    return F.concat_ws(" ", F.array_join("certifications", " | "), "requirements", "title", "raw_title")


#: What several rules look at, each computed once a row: name -> column of the posting or of names above it.
SIGNALS: list[dict[str, Callable[[], Column]]] = [
    # Each text is folded once; the patterns are in lower case.
    {
        "_tools": lambda: folded(F.array_join("tools", " | ")),
        "_haystack": lambda: folded(clearance_text()),
        "_title": lambda: folded(F.col("title")),
        "_flag": lambda: F.coalesce(F.col("role_type") == "People Manager", F.lit(False)),
    },
    {
        "_backend": lambda: says(F.col("_tools"), fixed.BACKEND_TOOLS),
        "_builds": lambda: says(F.col("_tools"), fixed.BUILD_TOOLS),
        "_manager_title": lambda: says(F.col("_title"), fixed.MANAGEMENT_TITLE) | says(folded(F.col("raw_title")), fixed.MANAGEMENT_TITLE),
        "_level": lambda: level_signature(F.col("raw_title")),
    },
    # The vendor's flag counts where a title or the requirements bear it out.
    {"_manages": lambda: F.col("_flag") & (F.col("_manager_title") | says(folded(F.col("requirements")), fixed.MANAGEMENT_LANGUAGE))},
]


def with_signals(postings: DataFrame) -> DataFrame:
    for step in SIGNALS:
        postings = postings.withColumns({name: make() for name, make in step.items()})
    return postings


def _titles(pattern: str) -> Column:
    return says(F.col("_title"), pattern)


REJECT: list[Rule] = [
    ("expired", lambda s: F.col("is_expired")),
    ("public-sector source", lambda s: F.lower("source").isin(*fixed.PUBLIC_SECTOR_SOURCES)),
    ("gov/mil/edu domain", lambda s: ends_with_any(F.col("company_host"), fixed.PUBLIC_DOMAINS)),
    ("not full-time", lambda s: ~F.array_contains("commitment", "Full Time")),
    ("clearance field", lambda s: F.col("security_clearance").isNotNull() & ~F.col("security_clearance").isin(*fixed.HARMLESS_CLEARANCES)),
    ("clearance in text", lambda s: says(F.col("_haystack"), fixed.CLEARANCE)),
    ("staffing placement", lambda s: F.col("employer_type") == "External Position"),
    ("people manager", lambda s: F.col("_manages")),
    ("non-software discipline", lambda s: ~F.col("_backend") & says(F.col("_tools"), fixed.NON_SOFTWARE_TOOLS)),
    ("full-stack/frontend title", lambda s: _titles(fixed.FRONTEND_TITLE)),
    ("blocked company", lambda s: F.lower("company").isin(*[c.strip().lower() for c in s.blocked_companies]) if s.blocked_companies else F.lit(False)),
    ("comp below floor", lambda s: F.col("comp_max") < s.comp_floor),
]

DEMOTE: list[Rule] = [
    ("uncorroborated people-manager flag", lambda s: F.col("_flag") & ~F.col("_manages")),
    ("customer-facing title", lambda s: _titles(fixed.CUSTOMER_FACING_TITLE)),
    ("analyst/research title", lambda s: _titles(fixed.ANALYST_TITLE) & ~_titles(fixed.ENGINEERING_TITLE)),
    ("hardware/physical title", lambda s: _titles(fixed.HARDWARE_TITLE)),
    ("network/IT ops title", lambda s: _titles(fixed.OPS_TITLE)),
    ("frequent air travel", lambda s: F.col("air_travel").isin(*fixed.FREQUENT_AIR_TRAVEL)),
    ("compliance/GRC tooling", lambda s: ~F.col("_builds") & says(F.col("_tools"), fixed.GRC_TOOLS)),
    ("IT-admin tooling", lambda s: ~F.col("_builds") & says(F.col("_tools"), fixed.IT_ADMIN_TOOLS)),
    ("band bottom below floor", lambda s: F.col("comp_min") < s.comp_min_floor),
    ("geo-tiered pay band", lambda s: F.col("city_count") >= s.wide_geography_cities),
]


def reasons(rules: list[Rule], settings: Screen) -> Column:
    """array<string> of the labels whose rule holds, in the order of the table."""
    return F.array_compact(F.array(*[F.when(F.coalesce(rule(settings), F.lit(False)), F.lit(label)) for label, rule in rules]))


def senior_level(signature: Column) -> Column:
    return F.arrays_overlap(F.split(signature, r"\+"), F.array(*[F.lit(x) for x in fixed.SENIOR_LEVELS]))


def senior_title(raw_title: Column) -> Column:
    return senior_level(level_signature(raw_title))


def strong_case(settings: Screen, demoted: Column) -> Column:
    senior = (
        F.coalesce(F.col("seniority_level") == "Senior Level", F.lit(False))
        | senior_level(F.col("_level"))
        | F.coalesce(F.col("comp_max") >= settings.comp_floor, F.lit(False))
    )
    return F.col("_backend") & (F.size(demoted) == 0) & senior


def screen(postings: DataFrame, settings: Screen = Screen()) -> DataFrame:
    """Postings with band, reject_reasons, demote_reasons and near_miss. Nothing is dropped.

    A rejected posting lists no demotions. A near miss is one that only the pay floor rejects.
    """
    # Only a flagged posting is searched for what bears the flag out; each text is folded once.
    out = postings.withColumns({name: SIGNALS[0][name]() for name in SIGNALS[0]})
    out = out.withColumns({"_backend": SIGNALS[1]["_backend"](), "_manages": F.col("_flag") & (SIGNALS[1]["_manager_title"]() | says(folded(F.col("requirements")), fixed.MANAGEMENT_LANGUAGE))})
    out = out.withColumn("reject_reasons", reasons(REJECT, settings))
    rejected, only_pay = F.size("reject_reasons") > 0, F.col("reject_reasons") == F.array(F.lit("comp below floor"))
    # Only what isn't rejected, or is for its pay alone, needs the rest of the rules.
    out = out.withColumn("_open", ~rejected | only_pay)
    out = out.withColumns({name: F.when(F.col("_open"), SIGNALS[1][name]()) for name in ("_builds", "_level")})
    out = out.withColumn("_demoted", F.when(F.col("_open"), reasons(DEMOTE, settings)).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("_strong", F.col("_open") & strong_case(settings, F.col("_demoted")))
    return out.withColumns(
        {
            "band": F.when(rejected, "rejected").when(F.col("_strong"), "strong").otherwise("possible"),
            "demote_reasons": F.when(rejected, F.array().cast("array<string>")).otherwise(F.col("_demoted")),
            "near_miss": only_pay & F.col("_strong"),
        }
    ).select(*postings.columns, "band", "reject_reasons", "demote_reasons", "near_miss")


def surfaced(screened: DataFrame, bands: tuple[str, ...] = ("strong", "possible")) -> DataFrame:
    """The screened postings of some bands; the filter reads the band and doesn't apply the rules again."""
    return computed(screened, "band").where(F.col("band").isin(*bands))


def reason_counts(screened: DataFrame, column: str = "reject_reasons") -> DataFrame:
    """(reason, n), most frequent first, ties by the first posting that has it.

    Counted by whole lists of reasons first, of which there are few, so the rules run once a posting.
    """
    lists = screened.groupBy(F.col(column).alias("r")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"))
    each = lists.select("ord", "n", F.posexplode("r").alias("place", "reason"))
    return each.groupBy("reason").agg(F.sum("n").alias("n"), F.min(F.struct("ord", "place")).alias("first")).orderBy(F.desc("n"), "first").select("reason", "n")


def sole_reason_counts(screened: DataFrame) -> DataFrame:
    # The size is aggregated, so that the filter stays behind the count and the rules run once a posting.
    lists = screened.groupBy(F.col("reject_reasons").alias("r")).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("reject_reasons")).alias("size"))
    return lists.where("size = 1").groupBy(F.col("r")[0].alias("reason")).agg(F.sum("n").alias("n"))


def funnel(screened: DataFrame, scraped: int | None = None) -> DataFrame:
    """One row of counts through the screen; duplicates are what deduplication took out of the ``scraped`` records before it."""
    n = F.count(F.lit(1))
    scraped = F.lit(scraped).cast("bigint") if scraped is not None else n
    return screened.agg(
        scraped.alias("scraped"), (scraped - n).alias("duplicates"), n.alias("screened"),
        F.count_if(F.col("band") == "rejected").alias("rejected"), F.count_if(F.col("band") == "strong").alias("strong"),
        F.count_if(F.col("band") == "possible").alias("possible"), F.count_if("near_miss").alias("near_misses"),
    )


def flag_audit(screened: DataFrame) -> DataFrame:
    """Cross-table of the vendor's manager flag and seniority field against the titles."""
    senior_field = F.coalesce(F.col("seniority_level") == "Senior Level", F.lit(False))
    return with_signals(screened).groupBy(
        F.col("_flag").alias("manager_flag"), F.col("_manager_title").alias("manager_title"), senior_field.alias("senior_field"), senior_level(F.col("_level")).alias("senior_title")
    ).agg(F.count(F.lit(1)).alias("n"))


def flag_reliability(screened: DataFrame) -> DataFrame:
    """One row: how often the vendor's manager flag and seniority field disagree with the posting."""
    s = with_signals(screened)
    senior_field, senior = F.coalesce(F.col("seniority_level") == "Senior Level", F.lit(False)), senior_level(F.col("_level"))
    alone, leveled = F.col("_flag") & ~F.col("_manages"), F.col("_level") != ""
    return s.agg(
        F.count(F.lit(1)).alias("postings"), F.count_if("_flag").alias("flagged"), F.count_if(alone).alias("uncorroborated"), F.count_if(alone & F.col("_backend")).alias("uncorroborated_backend"),
        F.count_if(leveled).alias("leveled_titles"), F.count_if(leveled & senior & ~senior_field).alias("senior_title_only"), F.count_if(leveled & ~senior & senior_field).alias("senior_field_only"),
    )


#: Order of shortlists: band, then pay, then company.
def shortlist_order(lower_company: bool = False) -> list[Column]:
    rank = F.when(F.col("band") == "strong", 0).when(F.col("band") == "possible", 1).otherwise(2)
    company = F.lower("company") if lower_company else F.col("company")
    return [rank.asc(), F.coalesce("comp_max", F.lit(0)).desc(), company.asc(), F.col("ord").asc()]
