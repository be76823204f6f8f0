"""Quality rules: base counts of a text and cross-document line frequency, without Python on the executors.

Base counts are per-row array expressions; 5-word windows are compared through their 64-bit
hash inside one document. Lines are normalised (A-Z lowered, trimmed, white-space runs made
one space), hashed, and counted once a document and host. A line is above the limits when
it stands in more than ``min_docs`` documents of the host and in more than ``max_share`` of
them. Those lines are removed; a document that keeps less than ``min_kept`` of its line
characters is depleted and rejected.

The texts are read once: counts and line hashes go to a table in the shared folder. Counting
aggregates map-side, so a line or host with a third of all rows costs one row a task; the way
back from frequent lines to documents is a plain join, which adaptive execution splits. Texts
are not shuffled unless the rows with removed lines are too many to broadcast.

Defined results: a null text has no words and fails the base rules, as an empty one does. A
null host is a host of its own. Repeated rows and equal keys are separate rows with equal
verdicts and count as separate documents. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import settle, small
from .textnorm import SPACE, SPACE_CHARS, WORD, lower_ascii


@dataclass(frozen=True)
class Limits:
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5
    min_docs: int = 10
    max_share: float = 0.01
    min_kept: float = 0.30


SYMBOLS = "#*$%&|<>"


def normalised_line(line: Column) -> Column:
    return lower_ascii(F.regexp_replace(F.btrim(line, F.lit(SPACE_CHARS)), f"[{SPACE}]+", " "))


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")


def measure(docs: DataFrame, carry: dict[str, Column], text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``carry`` and the base counts; ``lines`` is array<struct<h, n>>: hash and length of each line with a word."""
    k = limits.window
    names = list(carry)
    d = docs.select(*[c.alias(n) for n, c in carry.items()], F.coalesce(F.col(text), F.lit("")).alias("_t"))
    d = d.select(*names, "_t", F.regexp_extract_all("_t", F.lit(WORD), F.lit(0)).alias("_w"), lines_of(F.col("_t")).alias("_l"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (k - 1), F.lit(1)))
    d = d.select(
        *names,
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("_t", f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.transform("_l", lambda x: F.struct(F.xxhash64(normalised_line(x)).alias("h"), F.length(x).alias("n"))).alias("lines"),
        F.when(F.size("_w") >= k, F.transform(starts, lambda i: F.xxhash64(F.slice("_w", i, k)))).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    counted = [*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "lines"]
    # Only a text with a repeated window pays for the sort that finds where.
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    by_hash = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select(*counted, F.when(repeats, by_hash).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("_s"))
    twin = F.filter(
        "_s",
        lambda x, i: F.coalesce(F.get("_s", i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get("_s", i + 1)["h"] == x["h"], F.lit(False)),
    )
    d = d.select(*counted, F.sort_array(F.transform(twin, lambda x: x["i"])).alias("_p"))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(-k).alias("at"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("at"), (acc["n"] + F.least(F.lit(k), p - acc["at"])).alias("n")),
        lambda acc: acc["n"].cast("bigint"),
    )
    d = d.select(*counted, covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_percent
    )
    return d.withColumn("base_failed", failed)


def frequent_lines(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(host, h) of the lines above the limits. ``measured`` has host and lines."""
    per_doc = measured.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    counts = per_doc.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limits.min_docs)
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("docs")).withColumnRenamed("host", "of_host")
    return counts.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).where(
        F.col("n") > F.col("docs") * limits.max_share
    ).select("host", "h")


def _hits(measured: DataFrame, limits: Limits) -> DataFrame:
    """(hit_row, removed_chars, removed): the rows that have a line above the limits, settled."""
    bad = settle(frequent_lines(measured, limits), "frequent").select(F.col("host").alias("bad_host"), F.col("h").alias("bad_h"))
    lines = measured.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.h", "x.n")
    hit = lines.join(bad, lines["host"].eqNullSafe(bad["bad_host"]) & (lines["h"] == bad["bad_h"]))
    hit = hit.groupBy(F.col("row").alias("hit_row")).agg(F.sum("n").alias("removed_chars"), F.collect_set("h").alias("removed"))
    return settle(hit, "hits")


def verdicts(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``measured`` (with host, row and lines) with removed: array of line hashes, kept and no lines.

    The rows with removed lines go to the others, which stay where they are, if they hold few enough hashes in all.
    """
    hit = small(_hits(measured, limits), F.size("removed") + 2)
    out = measured.join(hit, F.col("row") == F.col("hit_row"), "left")
    total = F.aggregate("lines", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
    left = total - F.coalesce("removed_chars", F.lit(0))
    depleted = F.col("removed_chars").isNotNull() & (left < total * limits.min_kept)
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("hit_row", "removed_chars", "lines")


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """One row a document: (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    carry = {"id": F.col(key), "host": F.col(host), "row": F.monotonically_increasing_id()}
    measured = settle(measure(docs, carry, text, limits), "measured")
    return verdicts(measured, limits).select(
        F.col("id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def filter_quality(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", n_chars: str | None = "n_chars", limits: Limits = Limits()) -> DataFrame:
    """The documents that are kept, without the lines above the limits. Columns as in ``docs``."""
    carry = {"host": F.col(host), "row": F.monotonically_increasing_id(), "doc": F.struct(*docs.columns)}
    measured = settle(measure(docs, carry, text, limits), "measured")
    docs2 = verdicts(measured, limits).where("kept").select("doc", "removed")
    stays = lambda line: ~F.array_contains(F.col("removed"), F.xxhash64(normalised_line(line))) | (F.btrim(line, F.lit(SPACE_CHARS)) == "")
    lines = F.split(F.col("doc")[text], "\n", -1)
    cleaned = F.when(F.col("removed").isNull(), F.col("doc")[text]).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    out = docs2.select("doc", cleaned.alias("new_text"))
    cols = {c: F.col("doc")[c] for c in docs.columns}
    cols[text] = F.col("new_text")
    if n_chars in docs.columns:
        changed = F.length("new_text").cast(docs.schema[n_chars].dataType)
        cols[n_chars] = F.when(F.col("new_text").eqNullSafe(F.col("doc")[text]), F.col("doc")[n_chars]).otherwise(changed)
    return out.select(*[v.alias(c) for c, v in cols.items()])
