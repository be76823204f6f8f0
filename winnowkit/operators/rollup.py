"""Companies out of postings: one grouped aggregation by host, or by careers link where there is no host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import geo
from ..functions import guards as g
from ..functions.careers import link_of, link_parts
from ..functions.hosts import ends_with_any, host_url, normalize_host
from ..functions.keys import newest_first, tier_rank
from ..tables import computed
from .dedup import first_members
from .graph import durable


@dataclass(frozen=True)
class Rollup:
    home_lat: float
    home_lon: float
    radius_miles: float
    excluded_states: tuple[str, ...] = ()
    excluded_sources: tuple[str, ...] = ()
    excluded_domains: tuple[str, ...] = ()


def company_inputs(records: DataFrame, variant: str = "record") -> DataFrame:
    """What the rollup reads of a raw record, flat."""
    v, job, firm = F.col(variant), "$.v5_processed_job_data", "$.enriched_company_data"
    labels = F.transform(
        F.coalesce(F.try_variant_get(v, f"{job}.workplace_cities", "array<variant>"), F.array().cast("array<variant>")),
        lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")),
    )
    coordinate = lambda x, f: F.when(F.rlike(F.schema_of_variant(F.try_variant_get(x, f"$.{f}", "variant")), F.lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")), F.try_variant_get(x, f"$.{f}", "double"))
    points = F.transform(
        F.coalesce(F.try_variant_get(v, "$._geoloc", "array<variant>"), F.array().cast("array<variant>")),
        lambda x: F.struct(*[coordinate(x, f).alias(f) for f in ("lat", "lon", "lng")]),
    )
    given = lambda x: F.when(F.schema_of_variant(x) != "VOID", x)
    profile = F.to_json(F.struct(*[given(F.try_variant_get(v, f"{firm}.{f}", "variant")).alias(f) for f in fixed.PROFILE_FIELDS]))
    return records.select(
        "ord", g.text_at(v, "$.source").alias("source"), g.true_at(v, "$.is_expired").alias("is_expired"),
        g.text_at(v, f"{firm}.homepage_uri").alias("homepage"), labels.alias("labels"), points.alias("points"),
        g.text_at(v, "$.apply_url").alias("apply_url"), g.text_at(v, f"{firm}.name").alias("enriched_name"),
        g.text_at(v, f"{job}.company_name").alias("posting_name"), F.nullif(profile, F.lit("{}")).alias("profile"),
        g.text_at(v, f"{job}.job_category").alias("category"), g.text_at(v, f"{job}.estimated_publish_date").alias("published"),
        F.coalesce(g.text_at(v, f"{job}.core_job_title"), g.text_at(v, "$.job_information.title")).alias("title"),
    )


def judged(rows: DataFrame, options: Rollup) -> DataFrame:
    """``rows`` with host, nearby places, careers link, key and the one reason a row is dropped for, if any."""
    rows = rows.withColumns({"host": normalize_host(F.col("homepage")), "_places": geo.places(F.col("labels"), F.col("points")), "_link": link_parts(F.col("apply_url"), F.col("source"))})
    rows = rows.withColumns(
        {
            "places": geo.near(F.col("_places"), options.home_lat, options.home_lon, options.radius_miles, list(options.excluded_states)),
            "careers": link_of(F.col("_link")),
        }
    )
    sources = [s.strip().lower() for s in options.excluded_sources]
    reason = (
        F.when(F.coalesce(F.lower("source").isin(*sources), F.lit(False)) if sources else F.lit(False), "excluded_source")
        .when(F.coalesce("is_expired", F.lit(False)), "expired")
        .when(ends_with_any(F.col("host"), list(options.excluded_domains)), "excluded_website_tld")
        .when((F.size("_places") > 0) & (F.size("places") == 0), "no_qualifying_location")
        .when(F.col("host").isNull() & F.col("careers.url").isNull(), "unidentifiable")
    )
    rows = rows.withColumns(
        {
            "key": F.coalesce("host", "careers.url"),
            "has_website": F.col("host").isNotNull(),
            "drop_reason": reason,
            "without_location": F.size("_places") == 0,
        }
    ).drop("_places", "_link")
    return computed(rows, "drop_reason")


def _earliest(value: Column) -> Column:
    return F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), F.col("ord")))


def companies(rows: DataFrame) -> DataFrame:
    """One row a company from judged rows.

    Four aggregations read the kept rows, so what they need is written to the shared folder once
    and the records are parsed and judged once.
    """
    kept = durable(
        rows.where(F.col("drop_reason").isNull()).select(
            "key", "ord", "host", "places", "careers", "source", "enriched_name", "posting_name", "profile", "published", "title",
            F.coalesce("category", F.lit(fixed.UNKNOWN_CATEGORY)).alias("category"),
        )
    )
    published = F.coalesce(F.col("published"), F.lit(""))
    link_order = F.struct(tier_rank(F.col("careers.tier")).alias("r"), newest_first(published).alias("d"), F.col("ord"))
    linked = F.col("careers.url").isNotNull()
    main = kept.groupBy("key").agg(
        F.count(F.lit(1)).alias("posting_count"),
        F.min("ord").alias("ord"),
        F.max("host").alias("website_host"),
        F.coalesce(_earliest(F.coalesce("enriched_name", "posting_name")), F.max("host"), F.first("key")).alias("name"),
        F.min_by(F.when(linked, F.col("careers")), F.when(linked, link_order)).alias("careers"),
        F.max(F.nullif(published, F.lit(""))).alias("latest_published_at"),
        F.array_sort(F.collect_set(F.lower("source"))).alias("sources"),
        F.array_sort(F.collect_set("enriched_name")).alias("observed_names"),
        _earliest(F.col("profile")).alias("profile"),
    )
    counts = kept.groupBy("key", "category").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("key").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("category_counts"),
        F.coalesce(F.sum(F.when(F.col("category") == fixed.SOFTWARE_CATEGORY, F.col("n"))), F.lit(0)).alias("software_posting_count"),
    )
    return (
        main.join(counts, "key").join(_locations(kept), "key", "left").join(_sample_titles(kept), "key", "left")
        .select(
            "key", "name", "website_host", host_url(F.col("website_host")).alias("website_url"),
            F.col("website_host").isNotNull().alias("has_website"), F.col("careers.url").alias("careers_url"),
            F.coalesce("careers.tier", F.lit("none")).alias("careers_tier"), F.round("distance_miles", 2).alias("distance_miles"),
            F.coalesce("locations", F.array().cast("array<string>")).alias("locations"), "posting_count", "category_counts",
            "software_posting_count", F.coalesce("sample_titles", F.array().cast("array<string>")).alias("sample_titles"),
            "latest_published_at", "sources", "observed_names", "profile", "ord",
        )
    )


def _locations(kept: DataFrame) -> DataFrame:
    """(key, distance_miles, locations): a label counts once, where it stood first, with a distance if any row has one."""
    each = kept.select("key", "ord", F.posexplode("places").alias("nth", "p"))
    merged = each.groupBy("key", F.col("p.label").alias("label")).agg(
        F.min(F.struct("ord", "nth")).alias("at"), F.min_by("p.distance_miles", F.struct(F.col("p.distance_miles").isNull().alias("far"), "ord", "nth")).alias("d")
    )
    item = F.struct(F.col("d").isNull().alias("far"), F.coalesce("d", F.lit(0.0)).alias("d"), "at", "label")
    out = merged.groupBy("key").agg(F.min("d").alias("distance_miles"), F.array_sort(F.collect_list(item)).alias("l"))
    return out.select("key", "distance_miles", F.transform("l", lambda x: x["label"]).alias("locations"))


def _sample_titles(kept: DataFrame, n: int = fixed.SAMPLE_TITLES) -> DataFrame:
    """(key, sample_titles): the newest distinct titles, software first; undated ones last."""
    rows = kept.where(F.col("title").isNotNull())
    order = F.struct(
        (F.col("category") != fixed.SOFTWARE_CATEGORY).alias("other"), newest_key_plain(F.coalesce(F.col("published"), F.lit(""))).alias("d"), F.col("ord")
    )
    best = rows.groupBy("key", "title").agg(F.min(order).alias("o"))
    out = first_members(best, ["key"], "o", n)
    return out.select("key", F.transform("members", lambda x: x["title"]).alias("sample_titles"))


def newest_key_plain(date: Column) -> Column:
    """Sorts later strings first and the empty one last, unlike ``newest_first``."""
    return F.struct((date == "").alias("undated"), F.concat(newest_first(date), F.lit("G")).alias("k"))  # G is behind all digits of the key


def drop_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


def tier_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("careers_tier").agg(F.count(F.lit(1)).alias("n"))


def ambiguous(found: DataFrame) -> DataFrame:
    """Companies with a website that enrichment knows by several names."""
    return found.where("has_website").where(F.size("observed_names") > 1).select("key", "observed_names")
