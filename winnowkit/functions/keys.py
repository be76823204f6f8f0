"""Sort keys, identity keys and ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import squeeze


def newest_first(date: Column) -> Column:
    """A key that sorts later strings first, as a string of complemented code points.

    An empty or null date sorts before every other: undated rows win ties on purpose. The code points are
    eight digits each, from F down to 0.
    """
    return F.translate(F.hex(F.encode(F.coalesce(date, F.lit("")), "UTF-32")), "0123456789ABCDEF", "FEDCBA9876543210")


def fallback_key(company: Column, title: Column, cities: Column) -> Column:
    """The company as it is spelled, the title in its compared form, and the cities in order."""
    return F.concat_ws("|", company, squeeze(title), F.array_join(F.sort_array(cities), ","))


def match_keys(object_id: Column, alternates: Column, cluster: Column) -> Column:
    """Every identity a posting is known under, sorted and distinct."""
    ids = F.array_remove(F.array_compact(F.concat(F.array(object_id), F.coalesce(alternates, F.array().cast("array<string>")))), "")
    named = F.transform(ids, lambda x: F.concat(F.lit("id:"), x))
    vendor = F.when(F.coalesce(cluster, F.lit("")) != "", F.array(F.concat(F.lit("cluster:"), cluster))).otherwise(F.array().cast("array<string>"))
    return F.sort_array(F.array_distinct(F.concat(named, vendor)))


def ranked(value: Column, ranks: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, rank in ranks.items():
        out = F.when(value == name, rank).otherwise(out)
    return out


def band_rank(band: Column) -> Column:
    return ranked(band, fixed.BAND_RANKS, 0)


def tier_rank(tier: Column) -> Column:
    return ranked(tier, fixed.TIER_RANKS, max(fixed.TIER_RANKS.values()))


def posting_key(object_id: Column) -> Column:
    return F.concat(F.lit(fixed.POSTING_PREFIX), object_id)


def record_key(record: Column) -> Column:
    """The id of a raw record (VARIANT) as a string: ``objectID`` unless it is empty, zero or false, else ``id`` as it is.

    Only a record with neither is without a key. Lists and objects give their JSON text.
    """

    (first, nothing), (other, _) = _shown(record, "$.objectID"), _shown(record, "$.id")
    return F.when(nothing, other).otherwise(first)


def own_id(record: Column) -> Column:
    """``objectID`` of a raw record as a string; null where it is missing, empty, zero or false."""
    shown, nothing = _shown(record, "$.objectID")
    return F.when(~nothing, shown)


def _shown(record: Column, path: str) -> tuple[Column, Column]:
    """A value as a string, and whether it is missing, empty, zero or false."""
    found = F.try_variant_get(record, path, "variant")
    kind, text = F.schema_of_variant(found), F.try_variant_get(record, path, "string")
    number = F.rlike(kind, F.lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"))
    shown = F.when(kind == "BOOLEAN", F.initcap(text)).when((kind == "STRING") | number, text).when(kind != "VOID", F.to_json(found))
    empty = (shown.isin("", "[]", "{}")) | (kind == "BOOLEAN") & (shown == "False") | number & (F.try_variant_get(record, path, "double") == 0)
    return shown, F.coalesce(empty, F.lit(True))
