"""Hard negatives by a two-dimensional block matrix product.

The scores of all anchors with all rows are one matrix product, cut along both sides and along the
dimensions, SUMMA-style. Rows are numbered densely and cut into panels of ``ROWS`` rows by ``CHUNK``
dimensions, anchors into panels of ``ANCHORS`` by ``CHUNK``. A shuffle brings ``GRID`` panels of either side to each
cell of a grid, chunk by chunk; a cell multiplies them pair by pair and adds the partial tiles, as integers, in place. Its
summed tile yields the best rows of each anchor's label, which a shuffle reduces to its positives. Then
the product is formed again, and each tile yields the best rows of another label in each (anchor, positive) window,
which reduce to the negatives.

Only panels and best rows travel, and no score is stored: tiles are a matrix of anchors by rows, which outgrows any
disk long before its panels do, so they are made twice instead. A cell holds one tile and the panels of one chunk,
whatever the number of rows, dimensions or equal vectors. Anchors against all rows are
quadratic where anchors are a share of the rows: that is the query set that is asked for, in blocks.

Defined results: a row takes no part if its key, label or vector is null or a component is null or not finite. Where vectors
differ in length, the shorter ones are filled with zeros; an empty one scores 0 with all. Rows that repeat a key are
rows of their own: each may be an anchor, another one's positive or negative; equal scores and keys are ties that
give the same output whichever comes first. An anchor without another row of its label has no output, a window
without rows none either. No rows give no rows. Components whose scores could leave 64 bits raise a ValueError.
Keys and labels are integers. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import settle

ROWS, ANCHORS, CHUNK, GRID = 1024, 256, 32, 4
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95

_OUT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df``, settled, with n: its rows numbered from 0 without gaps."""
    t = settle(df.withColumn("m", F.monotonically_increasing_id()), name)
    part = F.shiftright("m", 33)
    counts = t.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))  # a row a task of the scan
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    return t.join(F.broadcast(base), part == F.col("part")).withColumn("n", F.col("base") + F.col("m").bitwiseAND((1 << 33) - 1)).drop("m", "part", "base")


def vectors(rows: DataFrame, key: Column, label: Column, vector: Column, scale: int = 256) -> DataFrame:
    """(id, label, v) of the rows that take part; v has the scaled components, rounded down."""
    x = F.transform(vector, lambda c: c.cast("double"))
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    d = rows.select(key.cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("x")).where("id is not null and label is not null and x is not null")
    return d.where(whole).select("id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _panels(rows: DataFrame, size: int, chunks: int, chunk: int, cell: str) -> DataFrame:
    """(block, k, ids, labels, ns, cells): ids, labels and row numbers come with the first chunk only."""
    part = F.slice("v", F.col("k") * chunk + 1, chunk)
    part = F.concat(part, F.array_repeat(F.lit(0).cast("bigint"), chunk - F.size(part))).cast(f"array<{cell}>")
    each = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    each = each.select((F.col("n") / size).cast("bigint").alias("block"), "k", F.struct("n", "id", "label", "row", part.alias("part")).alias("r"))
    held = each.groupBy("block", "k").agg(F.sort_array(F.collect_list("r")).alias("r"))  # at most ``size`` rows of a chunk
    first = lambda c: F.when(F.col("k") == 0, F.transform("r", lambda r: r[c])).alias(f"{c}s")
    return held.select("block", "k", first("id"), first("label"), first("row"), F.flatten(F.transform("r", lambda r: r["part"])).alias("cells"))


def _best(scores: np.ndarray, fits: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the first ``most`` that fit in each row of scores: highest score, then first column."""
    least = np.iinfo(scores.dtype).min if scores.dtype.kind == "i" else -np.inf
    left, rows, found = np.where(fits, scores, scores.dtype.type(least)), np.arange(len(scores)), []
    for _ in range(min(most, scores.shape[1])):
        col = left.argmax(axis=1)
        there = rows[left[rows, col] > least]
        found.append((there, col[there]))
        left[rows, col] = least
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))


def _flat(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def _cells(batches: Iterator[pa.RecordBatch], chunk: int, kind: type) -> Iterator[tuple[list, list, np.ndarray, list]]:
    """(anchors, rows, tile, positives) of each cell; anchors and rows are (ids, labels, row numbers) arrays, rows in the order of their ids.

    A cell comes sorted: of each chunk the anchors' panels (side 0), then the rows' (1); at last, where they are known, the anchors' positives (2).
    """
    at, tile, held = None, None, None

    def done():
        (a, b), places = [[np.concatenate([m[block][x] for block in sorted(m)]) for x in range(3)] for m in held["meta"]], held["places"]
        order = np.argsort(b[0], kind="stable")
        total = np.concatenate([np.concatenate([tile[i, j] for j in places[1]], axis=1) for i in places[0]])[:, order]
        return a, [x[order] for x in b], total, held["positives"]

    for batch in batches:
        ci, cj, ks, sides, blocks = (batch[c].to_pylist() for c in ("ci", "cj", "k", "side", "block"))
        for x, place in enumerate(zip(ci, cj, strict=True)):
            if place != at:
                if at is not None and all(held["meta"]):
                    yield done()
                at, tile, held = place, {}, {"meta": ({}, {}), "places": ([], []), "positives": [], "k": None, "a": {}}
            side, block, k = sides[x], blocks[x], ks[x]
            if side == 2:
                held["positives"].append((block, *(_flat(batch[c], x) for c in ("ids", "labels", "rows", "scores"))))
                continue
            if k == 0:
                held["meta"][side][block] = [_flat(batch[c], x) for c in ("ids", "labels", "rows")]
                held["places"][side].append(block)
            if held["k"] != k:
                held["k"], held["a"] = k, {}
            panel = _flat(batch["cells"], x).astype(kind).reshape(-1, chunk)
            if side == 0:
                held["a"][block] = panel
                continue
            for i, a in held["a"].items():
                partial = a @ panel.T
                if (i, block) in tile:
                    tile[i, block] += partial
                else:
                    tile[i, block] = partial
    if at is not None and all(held["meta"]):
        yield done()


def _positives(chunk: int, kind: type, positives: int):
    """The best rows of its anchors' labels in each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, a_labels, a_rows), (b_ids, b_labels, b_rows), scores, _ in _cells(batches, chunk, kind):
            at, col = _best(scores, (a_labels[:, None] == b_labels[None, :]) & (a_rows[:, None] != b_rows[None, :]), positives)
            yield pa.RecordBatch.from_arrays([pa.array(a_rows[at]), pa.array(scores[at, col].astype(np.int64)), pa.array(b_ids[col])], ["a", "score", "id"])

    return run


def _windows(chunk: int, kind: type, negatives: int, low: int, high: int):
    """The best rows of another label in each (anchor, positive) window of a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (a_ids, a_labels, a_rows), (b_ids, b_labels, _), scores, held in _cells(batches, chunk, kind):
            if not held:
                continue
            pos, nth, of, least = (np.concatenate([h[x] for h in held]) for x in (1, 2, 3, 4))
            order = np.argsort(a_rows)
            of = order[np.searchsorted(a_rows[order], of)]  # places of the anchors in the tile
            other = a_labels[:, None] != b_labels[None, :]
            for p in np.unique(nth):
                rows = np.flatnonzero(nth == p)
                s, a = scores[of[rows]], of[rows]
                # low * positive <= 100 * score <= high * positive, in whole numbers that can't overflow
                first, last = -(-low * _wide(least[rows]) // 100), high * _wide(least[rows]) // 100
                fits = other[a] & (s >= first.astype(kind)[:, None]) & (s <= last.astype(kind)[:, None])
                at, col = _best(s, fits, negatives)
                if len(at):
                    r = rows[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(y) for y in (a_rows[of[r]], nth[r], a_ids[of[r]], pos[r], least[r], b_ids[col], s[at, col].astype(np.int64))],
                        ["a", "p", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"],
                    )

    return run


def _wide(x: np.ndarray) -> np.ndarray:
    """Integers that products by a percentage can't overflow."""
    return x if len(x) == 0 or np.abs(x).max() < 1 << 55 else x.astype(object)


def hard_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", scale: int = 256,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sizes: tuple[int, int, int, int] = (ROWS, ANCHORS, CHUNK, GRID),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). ``anchors`` is a condition on the column id."""
    spark = rows.sparkSession
    per_row, per_anchor, chunk, grid = sizes
    label = F.col(label) if isinstance(label, str) else label
    all_rows = _numbered(vectors(rows, F.col(key), label, F.col(vector), scale), "vectors")
    is_anchor = F.coalesce(anchors, F.lit(False))
    largest = F.max(F.aggregate("v", F.lit(0.0), lambda m, c: F.greatest(m, F.abs(c.cast("double")))))
    n, n_anchors, dims, largest = all_rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("v")), largest).first()
    if not n_anchors:
        return spark.createDataFrame([], _OUT)
    bound = dims * largest * largest
    if bound >= 2.0**62:
        raise ValueError("components are so large that scores don't fit 64 bits")
    # Numbers in which every sum is exact, and the narrowest type that holds the components.
    kind = np.float32 if bound < 2.0**24 else np.float64 if bound < 2.0**53 else np.int64
    cell = next(name for name, bits in (("smallint", 15), ("int", 31), ("bigint", 63)) if largest < 2.0**bits)
    chunks = max(1, -(-dims // chunk))
    own = _numbered(all_rows.where(is_anchor).withColumnRenamed("n", "row"), "anchors")
    a = settle(_panels(own, per_anchor, chunks, chunk, cell), "anchor-panels")
    b = settle(_panels(all_rows.withColumn("row", F.col("n")), per_row, chunks, chunk, cell), "row-panels")
    cells_i, cells_j = -(-n_anchors // (per_anchor * grid)), -(-n // (per_row * grid))

    def to_cells(panels: DataFrame, side: int, block: str, across: str, cells: int, scores: str | None = None) -> DataFrame:
        """Each panel goes to all cells of its grid row or column."""
        out = panels.withColumn(f"c{block}", (F.col("block") / grid).cast("bigint")).withColumn(f"c{across}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint"))))
        return out.select("ci", "cj", "k", F.lit(side).alias("side"), "block", "ids", "labels", "rows", "cells", (F.col(scores) if scores else F.lit(None).cast("array<bigint>")).alias("scores"))

    met = to_cells(a, 0, "i", "j", cells_j).union(to_cells(b, 1, "j", "i", cells_i))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), cells_i * cells_j // 4)
    placed = lambda panels: panels.repartition(tasks, "ci", "cj").sortWithinPartitions("ci", "cj", "k", "side", "block")

    first = Window.partitionBy("a").orderBy(F.desc("score"), "id")
    top = placed(met).mapInArrow(_positives(chunk, kind, positives), "a bigint, score bigint, id bigint").withColumn("p", F.row_number().over(first)).where(F.col("p") <= positives)
    # The rows of ``own`` are numbered as its panels are; top has them by their number among all rows.
    place = own.select(F.col("row").alias("_row"), "n")
    top = top.join(place, F.col("a") == F.col("_row")).select((F.col("n") / per_anchor).cast("bigint").alias("block"), F.col("id"), F.col("p").cast("bigint").alias("p"), "a", "score")
    held = top.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("a", "p", "id", "score"))).alias("t"))  # some rows an anchor of the block
    of = [F.col("t")[c].cast("array<bigint>").alias(name) for c, name in (("id", "ids"), ("p", "labels"), ("a", "rows"))]
    held = settle(held.select("block", F.lit(chunks).alias("k"), *of, F.array().cast(f"array<{cell}>").alias("cells"), F.col("t")["score"].alias("s")), "positives")
    known = to_cells(held, 2, "i", "j", cells_j, "s")
    schema = "a bigint, p bigint, anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    found = placed(met.union(known)).mapInArrow(_windows(chunk, kind, negatives, low, high), schema)
    ranked = Window.partitionBy("a", "p").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
