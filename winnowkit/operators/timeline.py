"""Places in an order, and what came last before them, without one task that sees a whole key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import settle

_MASK = (1 << 33) - 1


def _ranges(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows``, sorted and settled, with _range and _row: the task that sorted a range of them, and the place in it."""
    row = F.monotonically_increasing_id()
    return settle(rows.orderBy(*order).withColumns({"_range": F.shiftright(row, 33), "_row": row.bitwiseAND(F.lit(_MASK))}), name)


def number(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with n: their numbers from 1 in order. Ranges of rows are sorted in tasks of their own; their sizes give the numbers."""
    ranges = _ranges(rows, order, "sorted")
    sizes, start, starts = sorted(tuple(r) for r in ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()), 1, []  # a row a task
    for at, n in sizes:
        starts.append((at, start))
        start += n
    begun = rows.sparkSession.createDataFrame(starts, "_at bigint, _start bigint")
    return ranges.join(F.broadcast(begun), F.col("_range") == F.col("_at")).withColumn("n", F.col("_start") + F.col("_row")).drop("_range", "_row", "_at", "_start")


def latest_before(asked: DataFrame, marks: DataFrame, inclusive: bool = False) -> DataFrame:
    """``asked`` (k, t, further columns) with mark: the latest t of ``marks`` (k, t) with its k that is smaller, or not larger if ``inclusive``; else null.

    Both are sorted by k and t in ranges. Inside a range it is a running maximum; what a range
    has to know of those before it is their last key and its latest mark, a row a range. So a key with very many rows is
    spread over ranges.
    """
    rest = [c for c in asked.columns if c not in ("k", "t")]
    ask = asked.select("k", "t", F.lit(None).cast("bigint").alias("mark"), F.lit(1 if inclusive else 0).alias("kind"), F.struct(F.lit(True).alias("is"), *rest).alias("rest"))
    mark = marks.select("k", "t", F.col("t").alias("mark"), F.lit(0 if inclusive else 1).alias("kind"))
    both = ask.unionByName(mark, allowMissingColumns=True)
    ranges = _ranges(both, [F.col("k"), F.col("t"), F.col("kind")], "timeline")
    edges = ranges.groupBy("_range").agg(F.max(F.struct("k", F.coalesce("mark", F.lit(-1)).alias("m"))).alias("e")).select(F.col("_range").alias("_before"), "e.k", "e.m")
    edges = edges.where("m >= 0").withColumnRenamed("k", "_k")  # a row a task
    carried = ranges.select(F.col("_range").alias("_to"), F.col("k").alias("_first")).groupBy("_to").agg(F.min("_first").alias("_first"))
    carried = carried.join(F.broadcast(edges), (F.col("_first") == F.col("_k")) & (F.col("_before") < F.col("_to"))).groupBy("_to", "_k").agg(F.max("m").alias("_carry"))
    inside = Window.partitionBy("_range", "k").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    found = ranges.withColumn("mark", F.max("mark").over(inside)).where("rest is not null")
    found = found.join(F.broadcast(carried), (F.col("_range") == F.col("_to")) & (F.col("k") == F.col("_k")), "left")
    return found.select("k", "t", *[F.col(f"rest.{c}").alias(c) for c in rest], F.coalesce("mark", "_carry").alias("mark"))
