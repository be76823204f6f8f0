"""Deduplicating postings: by the vendor's cluster key, else by similar requirements inside a fallback key."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import newest_first
from ..functions.text import jaccard, level_signature, strip, tokens
from ..tables import discard, settle, small
from .timeline import number

#: A group of so many sets, and of so many tokens in all of them, is folded by one task; a larger one is worked through in blocks of that size.
BLOCK = 1 << 15
ROOM = 1 << 23
#: Groups of so few sets are compared one by one.
FEW = 16
#: Of the tokens that two similar sets must share, this part is left out of the index: each set's most frequent ones. Of sets of under SMALL tokens, none.
LEFT_OUT = 0.9
SMALL = 48
#: Groups are cut down to their first members in two steps, so that a hot group is no one task's burden.
SALTS = 32


def first_members(rows: DataFrame, group: list[str], order: str, n: int) -> DataFrame:
    """(group, members): the first n rows of each group as an ordered array of structs.

    Each salted part of a group is cut to n rows first; at most SALTS * n of a group meet.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(SALTS)))
    part = Window.partitionBy(*group, "_salt").orderBy(order)
    cut = salted.withColumn("_n", F.row_number().over(part)).where(F.col("_n") <= n)
    rest = [order, *[c for c in rows.columns if c not in (*group, order)]]
    return cut.groupBy(*group).agg(F.slice(F.array_sort(F.collect_list(F.struct(*rest))), 1, n).alias("members"))


def mean_similarity(rows: DataFrame, group: str, text: str, order: str = "ord", max_pairs: int = fixed.MAX_PAIRS_PER_GROUP) -> DataFrame:
    """(group, similarity): mean over the first pairs, in order, of a group's non-blank texts; null under two."""
    usable = rows.where(strip(F.col(text)) != "").select(group, order, tokens(F.col(text)).alias("w"))
    return _mean_of(usable, group, order, max_pairs)


def _mean_of(usable: DataFrame, group: str, order: str, max_pairs: int) -> DataFrame:
    """``mean_similarity`` of rows with the tokens w of their texts."""
    members = first_members(usable, [group], order, max_pairs + 1)
    # A member meets as many of the later ones as the pairs of those before it leave, so no other pair is compared.
    left = lambda i: F.greatest(F.lit(0), max_pairs - (i * (2 * F.size("members") - i - 1) / 2).cast("int"))
    first = F.flatten(
        F.transform(
            F.col("members"),
            lambda a, i: F.transform(F.slice("members", i + 2, left(i)), lambda b: jaccard(a["w"], b["w"])),
        )
    )
    mean = F.when(F.size(first) > 0, F.aggregate(first, F.lit(0.0), lambda acc, x: acc + x) / F.size(first))
    return members.select(group, mean.alias("similarity"))


def _nth(v: DataFrame, nth: int) -> float:
    """The nth smallest v: by a histogram whose range narrows until one value is left in it."""
    while True:
        low, high = v.agg(F.min("v"), F.max("v")).first()
        if low == high:
            return low
        width = (high - low) / 4096
        bucket = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(4095)) if width else F.when(F.col("v") == low, 0).otherwise(1)
        for b, size in sorted(tuple(r) for r in v.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()):
            if nth <= size:
                break
            nth -= size
        v = v.where(bucket == b)


def exclusive_quantiles(values: DataFrame, column: str, percents: list[int]) -> tuple[list[float] | None, int]:
    """(values, n): the percentiles by exclusive interpolation, exact at any size; None of no values, the value itself of one.

    One histogram of at most 4,097 rows tells in which narrow ranges all the order statistics lie;
    those are divided again until one value is left.
    """
    v = values.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    low, high, n = v.agg(F.min("v"), F.max("v"), F.count(F.lit(1))).first()
    if n < 2:
        return ([low] * len(percents) if n else None), n
    width = (high - low) / 4096 or 1.0
    bucket = F.floor((F.col("v") - F.lit(low)) / F.lit(width))
    histogram = sorted(tuple(r) for r in v.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect())
    places = {}
    for percent in percents:
        at = percent * (n + 1)
        j = min(max(at // 100, 1), n - 1)
        places[percent] = (j, at - 100 * j)
    value = {}
    for rank in {r for j, _ in places.values() for r in (j, j + 1)}:
        before = 0
        for b, size in histogram:
            if before + size >= rank:
                value[rank] = _nth(v.where(bucket == b), rank - before)
                break
            before += size
    return [(value[j] * (100 - rest) + value[j + 1] * rest) / 100 for j, rest in places.values()], n


def exclusive_percentile(values: DataFrame, column: str, percent: int = fixed.CALIBRATION_PERCENTILE) -> tuple[float | None, int]:
    """(value, n) of one percentile."""
    found, n = exclusive_quantiles(values, column, [percent])
    return (found[0] if found else None), n


def calibrate(postings: DataFrame, group: str = "cluster_key", text: str = "requirements", order: str = "ord") -> tuple[float, int]:
    """(threshold, groups): the weak end of similarity inside the vendor's own clusters, or the default."""
    grouped = postings.where(F.col(group).isNotNull())
    value, n = exclusive_percentile(mean_similarity(grouped, group, text, order), "similarity")
    return (value, n) if n >= fixed.MIN_CALIBRATION_GROUPS else (fixed.DEFAULT_SIMILARITY, n)


class _Anchors:
    """Token sets of a block by their rarer tokens, so that a look at a set's rarer tokens tells which of them can be similar.

    Tokens are ordered by how many sets of the block have them. Of a set of n tokens the last part, less than the threshold times n, isn't in the index.
    What two sets share is in the index of both, or in what is left out of the set whose index ends first: so a set with fewer shared
    tokens there than similarity needs, less that part, isn't similar. Others are compared token by token, in order.
    """

    def __init__(self, threshold: float, lens: np.ndarray, values: np.ndarray, alone: bool = False) -> None:
        """``alone``: only sets of the block are looked for, so a token of one set finds nothing."""
        order = np.argsort(values, kind="stable")
        values = values[order]
        new = np.concatenate(([True], values[1:] != values[:-1]))[: len(values)]
        self.tokens, at = values[new], np.cumsum(new, dtype=np.int32) - 1
        counts = np.bincount(at)
        self.rank = np.empty(len(counts), np.int64)
        self.rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
        self.skip = int((counts == 1).sum()) if alone else 0
        del values, new
        key = np.empty(len(order), np.int64)
        key[order] = self.rank[at]
        del order, at
        self.threshold, self.lens = threshold, lens.astype(np.int64)
        self.left_out = self.out_of(self.lens)
        key += np.repeat(np.arange(len(lens), dtype=np.int64) << 32, lens)
        key.sort()
        self.all = (key & 0xFFFFFFFF).astype(np.int32)  # each set's tokens, rare ones first
        del key
        self.start = np.concatenate(([0], np.cumsum(self.lens)))
        room = np.zeros(len(counts), np.int64)
        for i in range(0, len(lens), 1024):
            part = slice(i, i + 1024)
            n, first = self.lens[part], self.start[i]
            nth = np.arange(n.sum()) - np.repeat(self.start[:-1][part] - first, n)
            room += np.bincount(self.all[first : first + len(nth)][nth < np.repeat(n - self.left_out[part], n)], minlength=len(counts))
        self.begin = np.concatenate(([0], np.cumsum(room)))[:-1]
        self.end, self.found_at = self.begin.copy(), np.empty(room.sum(), np.int64)
        self.held, self.many, self.flags = np.empty(len(lens), np.int64), 0, np.zeros(len(counts), np.int8)

    def out_of(self, n):
        return np.where(n < SMALL, 0, np.floor(LEFT_OUT * self.threshold * n)).astype(np.int64)

    def of(self, i: int) -> np.ndarray:
        return self.all[self.start[i] : self.start[i + 1]]

    def add(self, i: int) -> None:
        """Make the i-th set of the block an anchor; they are added in order."""
        indexed = self.of(i)[: self.lens[i] - self.left_out[i]]
        self.found_at[self.end[indexed]] = self.many
        self.end[indexed] += 1
        self.held[self.many] = i
        self.many += 1

    def ranked(self, lens: np.ndarray, values: np.ndarray) -> Iterator[np.ndarray]:
        """The tokens of sets that the block has, rare ones first."""
        at = np.minimum(np.searchsorted(self.tokens, values), len(self.tokens) - 1)
        known, rank, start = self.tokens[at] == values, self.rank[at], 0
        for n in lens.tolist():
            yield np.sort(rank[start : start + n][known[start : start + n]])
            start += n

    def first(self, known: np.ndarray, n: int) -> int | None:
        """The place in the block of the first anchor whose Jaccard similarity to a set of n tokens, of which the block has ``known``, is the threshold or more."""
        t, out = self.threshold, int(self.out_of(n))
        indexed = known[: max(0, len(known) - out)]
        indexed = indexed[np.searchsorted(indexed, self.skip) :]
        begin, end = self.begin[indexed], self.end[indexed]
        some = end > begin
        found = [self.found_at[a:b] for a, b in zip(begin[some].tolist(), end[some].tolist(), strict=True)]
        if not found:
            return None
        shared = np.bincount(np.concatenate(found))
        maybe = np.flatnonzero(shared >= max(1.0, (1 - LEFT_OUT) * t * n - 1e-3))
        if not len(maybe):
            return None
        at = self.held[maybe]
        lens = self.lens[at]
        most = np.minimum(shared[maybe] + np.maximum(out, self.left_out[at]), np.minimum(n, lens))  # that they have in common
        at = at[most >= t / (1 + t) * (n + lens) - 1e-3]
        if not len(at):
            return None
        self.flags[known], hit, step = 1, None, 4
        while len(at) and hit is None:
            now, at, step = at[:step], at[step:], min(4 * step, 256)
            lens = self.lens[now]
            ends = np.cumsum(lens)
            both = np.concatenate(([0], np.cumsum(self.flags[np.concatenate([self.of(i) for i in now.tolist()])], dtype=np.int64)))
            both = both[ends] - both[ends - lens]
            alike = np.flatnonzero(both / (n + lens - both) >= t)
            hit = int(now[alike[0]]) if len(alike) else None
        self.flags[known] = 0
        return hit


def _pieces(batches: Iterator[pa.RecordBatch], *by: str) -> Iterator[tuple]:
    """(key, ids, lengths of w, values of w) of the runs of a key, cut where a batch ends."""
    for batch in batches:
        keys, ids, w, at = list(zip(*(batch[c].to_pylist() for c in by), strict=True)), batch["id"].to_numpy(), batch["w"], 0
        offsets, values = w.offsets.to_numpy(), w.values.to_numpy()
        for key, run in groupby(keys):
            to = at + sum(1 for _ in run)
            yield key, ids[at:to], np.diff(offsets[at : to + 1]), values[offsets[at] : offsets[to]]
            at = to


def _decided(ids: list[int], anchors: list[int | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(anchors, pa.int64())], ["id", "anchor"])


def _fold_few(ids: list[int], lens: np.ndarray, values: np.ndarray, threshold: float) -> Iterator[int]:
    anchors, values, start = [], values.tolist(), 0
    for i, n in zip(ids, lens.tolist(), strict=True):
        w, start = set(values[start : start + n]), start + n
        found = next((a for a, x in anchors if (both := len(w & x)) / (n + len(x) - both) >= threshold), None)
        if found is None:
            anchors.append((i, w))
        yield i if found is None else found


def _fold_block(ids: list[int], lens: np.ndarray, values: np.ndarray, threshold: float) -> Iterator[int]:
    anchors = _Anchors(threshold, lens, values, alone=True)
    for i, n in enumerate(lens.tolist()):
        found = anchors.first(anchors.of(i), n)
        if found is None:
            anchors.add(i)
        yield ids[i if found is None else found]


def _fold(threshold: float):
    """Stream (g, id, w) sorted by group and id: (id, anchor). A task holds one group, or its block, at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out = [], []
        for _, pieces in groupby(_pieces(batches, "g"), key=lambda p: p[0]):
            mine, lens, values = (list(x) for x in list(zip(*pieces, strict=True))[1:])
            mine, lens, values = np.concatenate(mine).tolist(), np.concatenate(lens), np.concatenate(values)
            ids += mine
            out += (_fold_few if len(mine) <= FEW or threshold <= 0 else _fold_block)(mine, lens, values, threshold)
            if len(ids) >= 10_000:
                yield _decided(ids, out)
                ids, out = [], []
        yield _decided(ids, out)

    return run


def _meet(threshold: float):
    """Stream (g, b, is_set, id, w) sorted so, the anchors of a block before the sets of the group's block b: (id, anchor) of the sets that are similar to one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, pieces in groupby(_pieces(batches, "g", "b", "is_set"), key=lambda p: p[0][:2]):
            held, of, anchors = [], [], None
            for (_, _, is_set), ids, lens, values in pieces:
                if not is_set:
                    held.append((ids, lens, values))
                    continue
                if anchors is None:
                    if not held:  # none of the group in this round
                        continue
                    of, many, all_values = (np.concatenate(x) for x in zip(*held, strict=True))
                    held, anchors = [], _Anchors(threshold, many, all_values)
                    del all_values
                    for i in range(len(many)):
                        anchors.add(i)
                found = [anchors.first(known, n) for known, n in zip(anchors.ranked(lens, values), lens.tolist(), strict=True)]
                hits = [(int(i), int(of[x])) for i, x in zip(ids, found, strict=True) if x is not None]
                yield _decided([i for i, _ in hits], [a for _, a in hits])

    return run


def anchors_by_rounds(sets: DataFrame, threshold: float, block: int = BLOCK, room: int = ROOM) -> DataFrame:
    """(id, anchor) for sets (g, id, w) with unique ids: the first earlier anchor of the group that is similar, else the set itself.

    A group is cut into blocks in order, of about ``block`` sets or of ``room`` tokens where that is less. In a round the next block of every group is
    folded by one task, and its anchors meet the sets of all later blocks, each block in a task of its own; what is similar to one takes the first such
    and is out. So a set meets the anchors in their order, and a task holds the anchors of one block.
    What is written is the sets that are left, once a round, and the round before goes: no pairs, whatever tokens are frequent. Time is quadratic in
    the anchors of a group, which unlike sets are by nature.
    """
    if threshold > 1:
        return sets.select("id", F.col("id").alias("anchor"))
    if threshold <= 0:
        first = sets.groupBy(F.col("g").alias("_g")).agg(F.min("id").alias("anchor"))
        return sets.join(first, F.col("g") == F.col("_g")).select("id", "anchor")
    step = max(1, block // 64)
    placed = number(sets.select("g", "id", F.size("w").alias("size")), [F.col("g"), F.col("id")])
    begin = placed.groupBy(F.col("g").alias("_g")).agg(F.min("n").alias("_first"))
    chunks = placed.join(begin, F.col("g") == F.col("_g")).groupBy("g", F.floor((F.col("n") - F.col("_first")) / step).alias("c")).agg(F.min("id").alias("id"), F.sum("size").alias("size"))
    before = Window.partitionBy("g").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)  # a row for so many sets
    weight = F.greatest(F.lit(step / block), F.col("size") / room)
    cut = chunks.withColumn("b", F.floor(F.coalesce(F.sum(weight).over(before), F.lit(0.0)) + 1e-9)).groupBy("g", "b").agg(F.min("id").alias("id"))
    cuts = settle(cut.groupBy(F.col("g").alias("_g")).agg(F.array_sort(F.collect_list("id")).alias("_cuts")), "cuts")  # a number a block
    left = sets.join(small(cuts), F.col("g") == F.col("_g")).select("g", "id", "w", (F.size(F.filter("_cuts", lambda x: x <= F.col("id"))) - 1).alias("b"))
    found, r, last, settled = None, 0, cuts.agg(F.max(F.size("_cuts"))).first()[0] - 1, False
    while True:
        now = left.where(F.col("b") == r)
        folded = settle(now.select("g", "id", "w").repartition("g").sortWithinPartitions("g", "id").mapInArrow(_fold(threshold), "id bigint, anchor bigint"), "folded")
        found = folded if found is None else found.union(folded)
        if r >= last:
            return found
        later = left.where(F.col("b") > r)
        anchors = now.join(small(folded.where("id = anchor").select(F.col("id").alias("_id"))), F.col("id") == F.col("_id"), "left_semi")
        ahead = small(settle(later.select(F.col("g").alias("_g"), F.col("b").alias("_b")).distinct(), "ahead"))  # a row a block
        met = anchors.drop("b").join(ahead, F.col("g") == F.col("_g")).select("g", F.col("_b").alias("b"), F.lit(False).alias("is_set"), "id", "w")
        met = met.union(later.select("g", "b", F.lit(True).alias("is_set"), "id", "w")).repartition("g", "b").sortWithinPartitions("g", "b", "is_set", "id")
        out = settle(met.mapInArrow(_meet(threshold), "id bigint, anchor bigint"), "met")
        found = found.union(out)
        after = settle(later.join(small(out.select(F.col("id").alias("_id"))), F.col("id") == F.col("_id"), "left_anti"), "blocks")
        if settled:
            discard(left)
        left, settled = after, True
        r, last = left.agg(F.min("b"), F.max("b")).first()
        if r is None:
            return found


def greedy_groups(rows: DataFrame, group: list[str], text: str, level: Column, threshold: float, order: str = "ord", most: int = BLOCK, heads: int = BLOCK) -> DataFrame:
    """(order, anchor): the first member of the subgroup that each row belongs to.

    In order, a row joins the first subgroup of its group whose first member has its level and a
    similar text; else it starts one. Blank texts stay alone. Levels never mix, so they split
    the groups. A text enters as the hashes of its tokens; rows with the same tokens share their fate without more ado, for they are similar.

    A task folds groups of up to ``most`` rows and ROOM tokens and holds one. Larger ones are
    worked through by ``anchors_by_rounds`` in blocks of ``heads`` sets, all of them together, and no task holds any of those.
    """
    by = [*group, "_level"]
    keyed = rows.select(*group, F.col(order).cast("bigint").alias("_ord"), level.alias("_level"), tokens(F.col(text)).alias("_w"), (F.coalesce(strip(F.col(text)), F.lit("")) == "").alias("_blank"))
    keyed = keyed.select(
        F.col("_ord").alias("id"), (F.col("_blank") | (F.size("_w") == 0)).alias("_lonely"), F.to_json(F.struct(*by)).alias("g"), F.array_sort(F.transform("_w", lambda t: F.xxhash64(t))).alias("w")
    )
    keyed = settle(keyed.withColumns({"_set": F.xxhash64("w"), "_size": F.size("w")}), "token-sets")
    alone = keyed.where("_lonely").select("id", F.col("id").alias("anchor"))
    live = keyed.where("not _lonely")
    sizes = live.groupBy(F.col("g").alias("_g")).agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("size"), F.min("id").alias("only"), ((F.min("_set") == F.max("_set")) & F.lit(threshold <= 1)).alias("same"))
    sizes, in_group, is_large = settle(sizes, "sizes"), F.col("g") == F.col("_g"), (F.col("n") > most) | (F.col("size") > ROOM)
    one = live.select("id", "g").join(small(sizes.where("same").select("_g", "only")), in_group).select("id", F.col("only").alias("anchor"))  # all of the group's rows have the same tokens
    few = live.select("g", "id", "w").join(small(sizes.where(~F.col("same") & ~is_large).select("_g")), in_group, "left_semi").repartition("g").sortWithinPartitions("g", "id")
    found = alone.union(one).union(settle(few.mapInArrow(_fold(threshold), "id bigint, anchor bigint"), "folded"))
    large = sizes.where(~F.col("same") & is_large).select("_g")
    if not large.isEmpty():
        found = found.union(anchors_by_rounds(live.select("g", "id", "w").join(small(large), in_group, "left_semi"), threshold, heads))
    return found.select(F.col("id").alias(order), "anchor")


def representative_order() -> Column:
    """Which listing of a group survives: an employer's own before an aggregator's, newest, most text, first."""
    return F.struct(
        F.lower("source").isin(*fixed.AGGREGATOR_SOURCES).alias("copy"), newest_first(F.col("published_at")).alias("new"), (-F.length("requirements")).alias("long"), F.col("ord")
    )


def merge(postings: DataFrame, group: str) -> DataFrame:
    """The surviving posting of each group, with the others' ids and urls, distinct, in order, and ``_first``, the group's first ord.

    The survivor and the count are aggregated map-side. Of each id and url of a group one row is
    left before they meet: what comes together is what the surviving row then holds.
    """
    best = postings.groupBy(group).agg(
        F.min_by(F.struct(*[c for c in postings.columns if c != group]), representative_order()).alias("r"),
        F.count(F.lit(1)).alias("duplicate_count"), F.min("ord").alias("_first"),
    )
    best = settle(best, "survivors")
    chosen = best.select(F.col("r.ord").alias("_chosen"))
    others = postings.join(chosen, F.col("ord") == F.col("_chosen"), "left_anti").select(
        F.col(group).alias("_of"), "ord", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in ("object_id", "apply_url")])).alias("x")
    )
    others = others.where(F.coalesce("x.value", F.lit("")) != "").groupBy("_of", "x.field", "x.value").agg(F.min("ord").alias("at"))
    lists = others.groupBy("_of").agg(F.array_sort(F.collect_list(F.struct("at", "field", "value"))).alias("all"))
    listed = lambda f: F.coalesce(F.transform(F.filter("all", lambda m: m["field"] == f), lambda m: m["value"]), F.array().cast("array<string>"))
    skip = {group, "duplicate_count", "alternate_object_ids", "alternate_apply_urls"}
    return best.join(lists, F.col(group) == F.col("_of"), "left").select(
        F.col(group), *[F.col(f"r.{c}").alias(c) for c in postings.columns if c not in skip], F.col("duplicate_count").cast("int").alias("duplicate_count"),
        listed("object_id").alias("alternate_object_ids"), listed("apply_url").alias("alternate_apply_urls"), "_first",
    )


def deduplicate(postings: DataFrame, threshold: float | None = None) -> tuple[DataFrame, float]:
    """(survivors, threshold): vendor clusters merge as they are, the rest by similarity inside a fallback key.

    ``place`` tells the survivors' order: clusters as they were first seen, then fallback keys as they
    were, the subgroups of one side by side.
    """
    if threshold is None:
        threshold, _ = calibrate(postings)
    postings = postings.withColumn("_sub", F.lit(0).cast("bigint"))
    clustered = postings.where(F.col("cluster_key").isNotNull()).withColumns({"_path": F.lit(0), "_g": F.col("cluster_key")})
    rest = postings.where(F.col("cluster_key").isNull()).drop("_sub")
    anchors = settle(greedy_groups(rest, ["fallback_key"], "requirements", level_signature(F.col("raw_title")), threshold), "anchor-of")
    grouped = rest.join(anchors, "ord").withColumnRenamed("anchor", "_sub").withColumns({"_path": F.lit(1), "_g": F.col("fallback_key")})
    both = clustered.unionByName(grouped).withColumn("_key", F.struct("_path", "_g", "_sub"))
    out = settle(merge(both.drop("_path", "_g", "_sub"), "_key"), "merged")
    # Subgroups of a fallback key are numbered by their anchors; the first has no number.
    within = Window.partitionBy("_key._path", "_key._g")
    nth = F.row_number().over(within.orderBy("_key._sub")) - 1
    name = F.when(nth == 0, F.col("_key._g")).otherwise(F.concat("_key._g", F.lit("#"), nth.cast("string")))
    numbered = out.withColumns({"dedup_key": name, "place": F.struct(F.col("_key._path").alias("path"), F.min("_first").over(within).alias("key"), F.col("_key._sub").alias("sub"))})
    return numbered.drop("_key", "_first"), threshold


def dedup_counters(postings: DataFrame, survivors: DataFrame) -> dict[str, int]:
    before = postings.count()
    after, merged = survivors.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("duplicate_count") > 1).cast("int")), F.lit(0))).first()
    return {"postings": before, "survivors": after, "merged_groups": merged, "duplicates": before - after}


def key_structure(rows: DataFrame, key: str) -> DataFrame:
    """One row: rows with the key, distinct keys, keys of several rows, and rows merged by it."""
    groups = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("present"), F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("multi"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("merged"),
    )


def compare_keys(rows: DataFrame, keys: list[str], text: str, threshold: float, order: str = "ord") -> DataFrame:
    """For each candidate key: groups of several, rows merged, and groups whose texts do or don't look alike. A text is cut into tokens once for all keys."""
    usable, out = settle(rows.where(strip(F.col(text)) != "").select(order, *keys, tokens(F.col(text)).alias("w")), "tokens"), None
    for key in keys:
        groups = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        alike = _mean_of(usable.where(F.col(key).isNotNull()).select(key, order, "w"), key, order, fixed.MAX_PAIRS_PER_GROUP)
        one = groups.join(alike, key, "left").agg(
            F.lit(key).alias("key"), F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("merged"),
            F.count_if(F.col("similarity") >= threshold).alias("believable"), F.count_if(F.col("similarity") < threshold).alias("suspicious"),
        )
        out = one if out is None else out.union(one)
    return out




def truth(rows: DataFrame, key: str = "cluster_key", text: str = "requirements") -> dict:
    """How alike the members of the vendor's own groups are: groups, mean, min, max and quartiles (of four groups or more) of their similarity."""
    scored = settle(mean_similarity(rows.where(F.col(key).isNotNull()), key, text).where("similarity is not null"), "scored")
    groups = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").count()
    mean, low, high, n = scored.agg(F.avg("similarity"), F.min("similarity"), F.max("similarity"), F.count(F.lit(1))).first()
    quartiles = exclusive_quantiles(scored, "similarity", [25, 50, 75])[0] if n > 3 else None
    return {"groups": groups, "scored": n, "mean": mean, "min": low, "max": high, "quartiles": quartiles}


def keyed_skew(rows: DataFrame, columns: list[str], key: str = "cluster_key", most: int = 4) -> DataFrame:
    """(keyed, field, value, n, nth): the ``most`` frequent values of each column among rows with the key and without it."""
    each = rows.select(F.col(key).isNotNull().alias("keyed"), F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x"))
    counts = each.groupBy("keyed", "x.field", "x.value").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("keyed", "field").orderBy(F.desc("n"), "value"))  # each task keeps its first few
    return counts.withColumn("nth", nth).where(F.col("nth") <= most)


def worst_merges(rows: DataFrame, key: str, text: str, threshold: float, most: int, varies: list[str]) -> DataFrame:
    """(key, similarity, n, distinct values of each of ``varies``): the ``most`` groups whose texts are least alike, of those below the threshold."""
    keyed = rows.where(F.col(key).isNotNull())
    scored = mean_similarity(keyed, key, text).where(F.col("similarity") < threshold)
    worst = settle(scored.orderBy(F.round("similarity", 9), key).limit(most), "worst")  # a bounded list, cut in each task
    members = keyed.join(F.broadcast(worst.withColumnRenamed(key, "_k")), F.col(key) == F.col("_k"))
    counts = [F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in varies]
    return members.groupBy(key, "similarity").agg(F.count(F.lit(1)).alias("n"), *counts)
