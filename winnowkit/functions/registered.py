"""The column expressions as functions of SQL.

``register`` makes temporary SQL functions of them, so that a query in SQL alone has what a query in
DataFrames has. They are inlined by the optimizer: no Python runs in them, filters and column pruning go through
them, and they are part of the generated code. Their results are those of the expressions, nulls included.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..sources import pages
from . import careers, guards, hosts, keys, text

#: Operators that the SQL text of an expression has as calls.
_CALLS = re.compile(r"(?<![\w`'\])])(<=>|<=|>=|!=|==|=|<|>|!|\+|-|\*|/|%|and|or|not|in)\(")
_LITERAL = re.compile(r"'(?:[^'\\]|\\.)*'", re.S)


def body(expression: Column) -> str:
    """The SQL text of an expression, with its operators as quoted function names."""
    sql, out, at = expression._jc.node().sql(), [], 0
    for m in _LITERAL.finditer(sql):
        out += [_CALLS.sub(r"`\1`(", sql[at : m.start()]), m.group()]
        at = m.end()
    return "".join([*out, _CALLS.sub(r"`\1`(", sql[at:])])


def _defined() -> dict[str, tuple[str, Column]]:
    """Name: (parameters, expression over them)."""
    c = F.col
    return {
        "host_of": ("value STRING", hosts.normalize_host(c("value"))),
        "host_covers": ("owner STRING, candidate STRING", hosts.covers(c("owner"), c("candidate"))),
        "host_suffixes": ("host STRING", hosts.dot_suffixes(c("host"))),
        "careers_link": ("apply_url STRING, source STRING", careers.careers_link(c("apply_url"), c("source"))),
        "careers_entry": ("careers_url STRING, company_host STRING", careers.entry_url(c("careers_url"), c("company_host"))),
        "careers_search": ("name STRING", careers.search_link(c("name"))),
        "title_level": ("title STRING", text.level_signature(c("title"))),
        "title_tokens": ("title STRING", text.tokens(c("title"))),
        "posting_keys": ("object_id STRING, alternates ARRAY<STRING>, cluster STRING", keys.match_keys(c("object_id"), c("alternates"), c("cluster"))),
        "fallback_key_of": ("company STRING, title STRING, cities ARRAY<STRING>", keys.fallback_key(c("company"), c("title"), c("cities"))),
        "record_key_of": ("record VARIANT", keys.record_key(c("record"))),
        "pay_plausible": ("amount BIGINT", guards.plausible(c("amount"))),
        "text_between": ("html STRING, opening STRING, closing STRING", pages.embedded(c("html"), c("opening"), c("closing"))),
        "page_totals_of": ("payload STRING", pages.reported_totals(c("payload"))),
        "page_records_of": ("payload STRING", pages.record_list(c("payload"))),
    }


def register(spark: SparkSession, prefix: str = "wk_") -> list[str]:
    """The names of the functions, made anew in this session."""
    for name, (parameters, expression) in _defined().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURN {body(expression)}")
    # A row a record: in a FROM list with LATERAL, or alone.
    rows = f"SELECT pos, record FROM posexplode({body(pages.record_list(F.col('payload')))}) AS t(pos, record)"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}page_rows(payload STRING) RETURNS TABLE (pos INT, record VARIANT) RETURN {rows}")
    return [prefix + name for name in (*_defined(), "page_rows")]
