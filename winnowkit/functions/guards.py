"""Type-checked access to VARIANT records: a value of another type counts as absent.

Plain variant casts would turn numbers into strings and strings into numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import strip, text_or_empty, text_or_null


def kind(v: Column, path: str) -> Column:
    """STRING, BIGINT, DOUBLE, DECIMAL(p,s), BOOLEAN, ARRAY<..>, OBJECT<..>, VOID, or null for no such path."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def string_at(v: Column, path: str) -> Column:
    return F.when(kind(v, path) == "STRING", F.try_variant_get(v, path, "string"))


def text_at(v: Column, path: str) -> Column:
    return text_or_null(string_at(v, path))


def text_at_or_empty(v: Column, path: str) -> Column:
    return text_or_empty(string_at(v, path))


def number_at(v: Column, path: str) -> Column:
    return F.when(F.rlike(kind(v, path), F.lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")), F.try_variant_get(v, path, "double"))


def int_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "double").cast("bigint") if path is None else F.when(number_at(v, path).isNotNull(), number_at(v, path).try_cast("bigint"))


def true_at(v: Column, path: str) -> Column:
    """Only the boolean true is true."""
    return F.coalesce((kind(v, path) == "BOOLEAN") & F.try_variant_get(v, path, "boolean"), F.lit(False))


def strings_at(v: Column, path: str) -> Column:
    """The non-blank strings of an array, trimmed; an empty array for anything else."""
    items = F.try_variant_get(v, path, "array<variant>")
    texts = F.transform(items, lambda x: F.when(F.schema_of_variant(x) == "STRING", strip(F.try_variant_get(x, "$", "string"))))
    return F.coalesce(F.filter(texts, lambda t: t.isNotNull() & (t != "")), F.array().cast("array<string>"))


def plausible(amount: Column) -> Column:
    return F.when((amount > fixed.MONEY_OVER) & (amount < fixed.MONEY_UNDER), amount)


def implausible(amount: Column) -> Column:
    return amount.isNotNull() & plausible(amount).isNull()
