"""The visit log against companies and hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.hosts import covered_by, normalize_host


def split_log(log: DataFrame) -> DataFrame:
    """(key, applied) entries with their kind: posting, company (host normalised), or unusable."""
    host = normalize_host(F.col("key"))
    kind = F.when(F.startswith("key", F.lit(fixed.POSTING_PREFIX)), "posting").when(host.isNotNull(), "company").otherwise("unusable")
    return log.select("key", kind.alias("kind"), F.when(kind == "company", host).alias("host"), F.coalesce("applied", F.lit(False)).alias("applied"))


def visited_hosts(log: DataFrame) -> DataFrame:
    """(host, applied) of the companies in the log, once each."""
    return split_log(log).where("kind = 'company'").groupBy("host").agg(F.bool_or("applied").alias("applied"))


def remaining(companies: DataFrame, log: DataFrame, host: str = "website_host") -> DataFrame:
    """Companies that the log doesn't have; one without a host can't be matched and stays."""
    hosts = visited_hosts(log).select(F.col("host").alias("_h"))
    return companies.join(hosts, normalize_host(companies[host]) == F.col("_h"), "left_anti")


def excluded(companies: DataFrame, log: DataFrame, host: str = "website_host") -> DataFrame:
    """Companies that the log has, with applied."""
    hosts = visited_hosts(log).select(F.col("host").alias("_h"), F.col("applied"))
    return companies.join(hosts, normalize_host(companies[host]) == F.col("_h")).drop("_h")


def filter_counters(companies: DataFrame, log: DataFrame, host: str = "website_host") -> DataFrame:
    """One row: companies, kept, excluded, excluded_applied, kept_unmatchable."""
    hosts = visited_hosts(log).select(F.col("host").alias("_h"), F.col("applied"))
    marked = companies.join(hosts, normalize_host(companies[host]) == F.col("_h"), "left")
    return marked.agg(
        F.count(F.lit(1)).alias("companies"), F.count_if(F.col("_h").isNull()).alias("kept"), F.count_if(F.col("_h").isNotNull()).alias("excluded"),
        F.count_if(F.coalesce("applied", F.lit(False))).alias("excluded_applied"), F.count_if(F.col(host).isNull()).alias("kept_unmatchable"),
    )


def applied_companies(rows: DataFrame, applied_hosts: DataFrame, host: str = "company_host") -> DataFrame:
    """``rows`` with company_applied: a résumé went to the host or to one below it."""
    sent = applied_hosts.select(normalize_host(F.col("host")).alias("host"))
    found = covered_by(sent, "host", rows.select(normalize_host(F.col(host)).alias("o")), "o").select(F.col("owner").alias("_o")).distinct()
    return rows.join(found, normalize_host(rows[host]) == F.col("_o"), "left").withColumn("company_applied", F.col("_o").isNotNull()).drop("_o")
