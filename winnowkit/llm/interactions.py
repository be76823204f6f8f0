"""Filter interaction audit: what each filter removes in every order in which the filters can be applied.

A direct relational replay. Each document has a flag a filter, as bits of one integer; the
documents are crossed with the broadcast orders (120 for five filters, a fixed number), each pair
gets its first failing step, the steps are exploded, and conditional counts are summed by part,
order and step. Partial aggregation runs in the task that made the rows, so the 600 rows of a
document are never shuffled: each task passes on at most parts * orders * steps sums, however
many documents a part has.

Texts are read once. Flags, keys and digests go to a table in the shared folder; equal texts meet
as digests in an aggregation, and only digests of more than one row come back to the flags, which
stay where they are as long as those are few enough to broadcast (counted first).

Defined results: a null text is empty, has no words and fails A only, and E if an empty one has a
smaller key. A null part is the empty string. A null key is smaller than no other and none is
smaller than it, so such rows never fail E, and no label is theirs. Rows that repeat a key and its
text are documents of their own, and none of them fails E for the others. Labels that repeat a
key count once: a document is good if any of them says so, and toxic likewise. Documents without
a label are neither. No rows give no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settle, small
from .textnorm import WORD

#: The filter that needs the whole table: a text that some document with a smaller key has too.
DUPLICATE = "E"


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The failure condition of each filter on a text alone. ``words`` is the array of its words."""
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")) * 100 > F.length(text) * 2,
        "D": text.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """A row a document: (id, part, fails): the bits of the filters that it fails, the first filter's the lowest. Settled inputs, not shuffled texts."""
    t, w = F.col("t"), F.col("w")
    d = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    d = d.select("id", "part", "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(failures(t, w).values())), F.lit(0))
    rows = settle(d.select("id", "part", bits.alias("fails"), F.unhex(F.sha2(t.cast("binary"), 256)).alias("digest")), "flags")
    same = rows.groupBy(F.col("digest").alias("same")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    same = small(settle(same.select("same", "first"), "equal-texts"))
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    bit = 1 << len(failures(t, w))
    return rows.join(same, F.col("digest") == F.col("same"), "left").select("id", "part", (F.col("fails") + F.when(later, bit).otherwise(0)).alias("fails"))


def labelled(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rows`` (with id) with good and toxic."""
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    said = labels.groupBy(F.col(key).alias("of")).agg(says("quality").alias("good"), says("toxic").alias("toxic")).where("good or toxic")
    out = rows.join(small(settle(said, "labels")), F.col("id") == F.col("of"), "left")
    return out.select(*rows.columns, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def replay(rows: DataFrame, letters: str) -> DataFrame:
    """The counts of every (part, filter_order, step) for rows of (part, fails, good, toxic); bit i of fails is the filter ``letters[i]``."""
    n, bit = len(letters), {c: 1 << i for i, c in enumerate(letters)}
    of_step = [f"b{i}" for i in range(1, n + 1)]
    orders = [("".join(p), *[bit[c] for c in p]) for p in permutations(letters)]
    orders = rows.sparkSession.createDataFrame(orders, ", ".join(["filter_order string", *[f"{b} int" for b in of_step]]))
    first = F.lit(n + 1)
    for i in range(n, 0, -1):
        first = F.when(F.col("fails").bitwiseAND(F.col(f"b{i}")) != 0, i).otherwise(first)
    # The one product of tables here: each document with all orders, whose number doesn't depend on the data.
    each = rows.select("part", "fails", "good", "toxic").crossJoin(F.broadcast(orders))
    each = each.select("part", "fails", "good", "toxic", "filter_order", first.alias("first"), *of_step)
    steps = F.array(*[F.struct(F.lit(i).alias("step"), F.col(b).alias("bit")) for i, b in enumerate(of_step, 1)])
    each = each.select("part", "fails", "good", "toxic", "filter_order", "first", F.inline(steps))
    fails_here, removed = F.col("fails").bitwiseAND(F.col("bit")) != 0, F.col("first") == F.col("step")
    count = lambda c: F.sum(F.when(c, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    out = each.groupBy("part", "filter_order", "step").agg(
        count(F.col("first") > F.col("step")).alias("kept"),
        count(removed).alias("removed"),
        count(fails_here & (F.col("first") < F.col("step"))).alias("redundant"),
        count(F.col("fails") == F.col("bit")).alias("unique_fails"),
        count(removed & F.col("good")).alias("good_lost"),
        count(removed & F.col("toxic")).alias("toxic_lost"),
    )
    of_filter = Window.partitionBy("part", F.substr("filter_order", F.col("step"), F.lit(1)))
    return out.withColumn("shapley", F.sum("removed").over(of_filter))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders of the five filters."""
    letters = "".join([*failures(F.lit(""), F.array()), DUPLICATE])
    return replay(labelled(flagged(docs, key, text, part), labels, key), letters)


def shares(audited: DataFrame) -> DataFrame:
    """(part, filter, share): the documents that a filter removes on average over all orders, its Shapley value."""
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    orders = F.count_distinct("filter_order")
    return audited.groupBy("part", letter.alias("filter")).agg((F.sum("removed") / orders).alias("share"))
