"""From raw records to flat postings: one projection, on a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..tables import settle
from ..functions import guards as g
from ..functions.hosts import normalize_host
from ..functions.keys import fallback_key

POSTING_DDL = (
    "object_id string, cluster_key string, dedup_key string, fallback_key string, duplicate_count int, "
    "alternate_object_ids array<string>, alternate_apply_urls array<string>, title string, raw_title string, "
    "company string, company_host string, job_category string, seniority_level string, role_type string, "
    "employer_type string, min_years_experience int, workplace_type string, cities array<string>, city_count int, "
    "comp_min int, comp_max int, comp_frequency string, comp_transparent boolean, comp_implausible boolean, "
    "commitment array<string>, security_clearance string, certifications array<string>, requirements string, "
    "tools array<string>, air_travel string, source string, apply_url string, published_at string, is_expired boolean"
)
COLUMNS = [c.strip().split(" ")[0] for c in POSTING_DDL.split(", ")]
VERDICT_COLUMNS = ["band", "reject_reasons", "demote_reasons"]


class SchemaDrift(ValueError):
    """Flat postings have columns that the schema doesn't know."""


def conform(df: DataFrame, extra: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Postings on the fixed schema: unknown columns are an error, missing ones take their defaults."""
    unknown = set(df.columns) - set(COLUMNS) - set(VERDICT_COLUMNS) - set(extra)
    if unknown:
        raise SchemaDrift(f"unknown posting columns: {', '.join(sorted(unknown))}")
    out = {}
    for part in POSTING_DDL.split(", "):
        name, kind = part.strip().split(" ")
        default: Column = F.lit(None)
        if kind.startswith("array"):
            default = F.array().cast(kind)
        elif kind == "boolean":
            default = F.lit(False)
        elif name == "duplicate_count":
            default = F.lit(1)
        elif name == "city_count":
            default = F.lit(0)
        out[name] = (F.coalesce(F.col(name), default) if name in df.columns else default).cast(kind)
    return df.withColumns(out)


def project(records: DataFrame, variant: str = "record") -> DataFrame:
    """Flat postings of raw records (a VARIANT column and ``ord``); wrong types count as absent."""
    v = F.col(variant)
    job, info, firm = "$.v5_processed_job_data", "$.job_information", "$.enriched_company_data"
    low, high = g.number_at(v, f"{job}.yearly_min_compensation"), g.number_at(v, f"{job}.yearly_max_compensation")
    low, high = low.try_cast("bigint"), high.try_cast("bigint")
    raw_title = F.coalesce(g.text_at(v, f"{info}.job_title_raw"), g.text_at(v, f"{info}.title"), F.lit(""))
    title = F.coalesce(g.text_at(v, f"{job}.core_job_title"), raw_title)
    company = F.coalesce(g.text_at(v, f"{firm}.name"), g.text_at(v, f"{job}.company_name"), F.lit(fixed.UNKNOWN_COMPANY))
    cities = g.strings_at(v, f"{job}.workplace_cities")
    cluster = g.text_at(v, "$.liberal_dedup_cluster")
    flat = records.select(
        "ord",
        F.coalesce(g.text_at(v, "$.objectID"), g.text_at(v, "$.id"), F.lit("")).alias("object_id"),
        cluster.alias("cluster_key"),
        F.coalesce(cluster, F.lit("")).alias("dedup_key"),
        F.lit(1).alias("duplicate_count"),
        F.array().cast("array<string>").alias("alternate_object_ids"),
        F.array().cast("array<string>").alias("alternate_apply_urls"),
        title.alias("title"), raw_title.alias("raw_title"), company.alias("company"),
        normalize_host(g.string_at(v, f"{firm}.homepage_uri")).alias("company_host"),
        g.text_at(v, f"{job}.job_category").alias("job_category"),
        g.text_at(v, f"{job}.seniority_level").alias("seniority_level"),
        g.text_at(v, f"{job}.role_type").alias("role_type"),
        g.text_at(v, f"{job}.position_employer_type").alias("employer_type"),
        g.number_at(v, f"{job}.min_industry_and_role_yoe").try_cast("int").alias("min_years_experience"),
        g.text_at(v, f"{job}.workplace_type").alias("workplace_type"),
        cities.alias("cities"),
        g.plausible(low).cast("int").alias("comp_min"), g.plausible(high).cast("int").alias("comp_max"),
        g.text_at(v, f"{job}.listed_compensation_frequency").alias("comp_frequency"),
        g.true_at(v, f"{job}.is_compensation_transparent").alias("comp_transparent"),
        (g.implausible(low) | g.implausible(high)).alias("comp_implausible"),
        g.strings_at(v, f"{job}.commitment").alias("commitment"),
        g.text_at(v, f"{job}.security_clearance").alias("security_clearance"),
        g.strings_at(v, f"{job}.licenses_or_certifications").alias("certifications"),
        g.text_at_or_empty(v, f"{job}.requirements_summary").alias("requirements"),
        g.strings_at(v, f"{job}.technical_tools").alias("tools"),
        g.text_at(v, f"{job}.air_travel_requirement").alias("air_travel"),
        g.text_at_or_empty(v, "$.source").alias("source"),
        g.text_at(v, "$.apply_url").alias("apply_url"),
        g.text_at(v, f"{job}.estimated_publish_date").alias("published_at"),
        g.true_at(v, "$.is_expired").alias("is_expired"),
    )
    flat = flat.withColumns({"city_count": F.size("cities"), "fallback_key": fallback_key(F.col("company"), F.col("title"), F.col("cities"))})
    return flat.select("ord", *COLUMNS)


#: The objects of a record whose fields are told one by one.
OBJECTS = ("job_information", "enriched_company_data", "v5_processed_job_data")
#: What the projection reads, and the kinds that it takes.
READ_FIELDS = {
    **dict.fromkeys(("objectID", "id", "liberal_dedup_cluster", "source", "apply_url"), "string"), "is_expired": "boolean", **dict.fromkeys(OBJECTS, "object"),
    "job_information.job_title_raw": "string", "job_information.title": "string", "enriched_company_data.name": "string", "enriched_company_data.homepage_uri": "string",
    **{f"v5_processed_job_data.{c}": "string" for c in (
        "core_job_title", "company_name", "job_category", "seniority_level", "role_type", "position_employer_type", "workplace_type", "listed_compensation_frequency",
        "security_clearance", "requirements_summary", "air_travel_requirement", "estimated_publish_date",
    )},
    **{f"v5_processed_job_data.{c}": "number" for c in ("min_industry_and_role_yoe", "yearly_min_compensation", "yearly_max_compensation")},
    "v5_processed_job_data.is_compensation_transparent": "boolean",
    **{f"v5_processed_job_data.{c}": "array" for c in ("workplace_cities", "commitment", "licenses_or_certifications", "technical_tools")},
}


def field_kinds(records: DataFrame, variant: str = "record") -> DataFrame:
    """(path, kind, n): in how many raw records each field, of the record and of its three objects, is of which kind. Counts combine map-side."""
    v = F.col(variant)
    fields = lambda x, at: F.transform(F.map_entries(F.try_variant_get(x, "$", "map<string,variant>")), lambda e: F.struct(F.concat(F.lit(at), e["key"]).alias("path"), e["value"].alias("v")))
    none = F.array().cast("array<struct<path:string,v:variant>>")
    inner = [F.coalesce(fields(F.try_variant_get(v, f"$.{o}", "variant"), f"{o}."), none) for o in OBJECTS]
    each = records.select(F.explode(F.concat(F.coalesce(fields(v, ""), none), *inner)).alias("x")).select("x.path", F.lower(F.coalesce(F.schema_of_variant("x.v"), F.lit("void"))).alias("k"))
    kind = (
        F.when(F.rlike("k", F.lit("^(bigint|double|float|decimal)")), "number").when(F.startswith("k", F.lit("array")), "array").when(F.startswith("k", F.lit("object")), "object")
        .when(F.col("k") == "void", "null").otherwise(F.col("k"))
    )
    return each.groupBy("path", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def drift(records: DataFrame, variant: str = "record") -> DataFrame:
    """(path, kind, n, state) of what differs from what the projection reads: new fields, fields of another kind than it takes (retyped), and those that no
    record has (lost, with the kind that is read). Nulls are no drift."""
    read = F.broadcast(records.sparkSession.createDataFrame(list(READ_FIELDS.items()), "read string, takes string"))
    found = settle(field_kinds(records, variant), "fields")  # a row a field and kind
    state = F.when(F.col("read").isNull(), "new").when(F.col("kind") != F.col("takes"), "retyped")
    seen = found.join(read, F.col("path") == F.col("read"), "left").where("kind <> 'null'").select("path", "kind", "n", state.alias("state")).where("state is not null")
    lost = read.join(found.select("path").distinct(), F.col("read") == F.col("path"), "left_anti")
    return seen.union(lost.select("read", "takes", F.lit(0).cast("bigint"), F.lit("lost")))


def normalize_counters(postings: DataFrame) -> DataFrame:
    """One row: postings, share with a vendor key, implausible pay, blank requirements."""
    return postings.agg(
        F.count(F.lit(1)).alias("postings"),
        F.round(F.avg(F.col("cluster_key").isNotNull().cast("int")), 4).alias("cluster_key_share"),
        F.count_if("comp_implausible").alias("implausible_pay"),
        F.count_if(F.col("requirements") == "").alias("blank_requirements"),
    )
