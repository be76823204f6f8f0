"""The visit log: one JSON object of keys (hosts, or postings) to an entry with a date and a mark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed


class BadVisitLog(ValueError):
    """The file isn't one JSON object."""


def read(spark: SparkSession, path: str) -> DataFrame:
    """(key, date, applied): applied only where the entry's mark is the boolean true."""
    whole = spark.read.option("wholetext", "true").text(path)
    log = whole.select(F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>").alias("m"))
    if not log.where("m is null").isEmpty():
        raise BadVisitLog(f"{path} is not a JSON object")
    entries = log.select(F.explode("m").alias("key", "v"))
    kind = F.schema_of_variant(F.try_variant_get("v", "$.r", "variant"))
    marked = F.coalesce((kind == "BOOLEAN") & F.try_variant_get("v", "$.r", "boolean"), F.lit(False))
    return entries.select("key", F.try_variant_get("v", "$.date", "string").alias("date"), marked.alias("applied"))


def opened_postings(log: DataFrame) -> DataFrame:
    """(key, applied) of posting keys, as they are."""
    return log.where(F.startswith("key", F.lit(fixed.POSTING_PREFIX))).select("key", "applied")


def applied_hosts(log: DataFrame) -> DataFrame:
    """(host) of other keys with the mark, not normalised."""
    return log.where(~F.startswith("key", F.lit(fixed.POSTING_PREFIX)) & F.col("applied")).select(F.col("key").alias("host"))
