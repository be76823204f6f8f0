"""Connected sets of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import discard, settle


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again, for several readers."""
    return settle(df, "table")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: bigint); root is the smallest node it reaches.

    Alternating large-star and small-star rounds: their number grows with the logarithm of the
    longest path. Each round rewrites the links in a few shuffles and is written to the shared
    folder; the round before goes. Minima are aggregated map-side, and the joins back are plain
    ones that adaptive execution splits, so a node with very many links is no one task's burden.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = settle(pairs.distinct(), "links"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        seen = mark
        both = now.union(now.select("b", "a"))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low2 = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low2, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = settle(small.union(low2).distinct(), "links")
        discard(now)
        now = after
