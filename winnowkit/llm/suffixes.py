"""Benchmark decontamination by suffix arrays over the training texts.

Documents are read in shards of about ``SHARD_WORDS`` words, whole texts each, wherever they lie:
nothing is shuffled. A shard numbers its words by the vocabulary of the test items, sorts its
suffixes by prefix doubling together with those of the test items, and finds the place of every
test suffix among its own by binary search. The two neighbours of that place hold the longest
verbatim match; the suffixes around it that share a whole window with it are its other places. A word that
no item has ends a suffix, and stretches between such words in which no window fits are left out
of the array before it is sorted: what they hold can't match a window.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
window. Document words inside any occurrence of a window are hit, and a document with a hit is
affected.

Test items are stored in the shared folder, in blocks of about ``BLOCK_BYTES``; a task reads them from
there, one block at a time, so neither the driver nor a task holds a large benchmark whole. Every
shard meets every block: that is one pass over the documents whatever their number. A worker's memory is a
shard, a block and some 100 bytes a word of those for the sorting; a text of more words than a shard is a shard of
its own.

Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lowered. Defined
results: a null text has no words, is never hit and never an item's; a null item id counts as the empty
string. Items that share an id count as one, repeated rows too. Equal keys and repeated rows of
documents give a row each. No items leave all documents untouched, no documents give no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import drop_matches, file_system, new_path, on_workers, settle

WINDOW = 10
SHARD_WORDS = 1 << 21
BLOCK_BYTES = 4 << 20

#: Bytes of the word rule: A-Z lowered, other ASCII than letters and digits a space.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def clean(text: bytes | None) -> bytes:
    """The words of a UTF-8 text between spaces."""
    return (text or b"").translate(_WORD_BYTES)


def suffix_ranks(ids: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(left, levels) of word ids in which a negative id ends a suffix; the last id is one.

    ``left`` is the number of words to the end; ``levels[k]`` ranks the suffixes by their first
    2^k words, equal ranks where those are equal, 0 at an end. The last level knows ``depth`` words at least, or no ties.
    """
    n = len(ids)
    ends = np.flatnonzero(ids < 0)
    left = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    order = np.flatnonzero(ids >= 0)
    order = order[np.argsort(ids[order], kind="stable")]

    def ranked(slots: np.ndarray, keys: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Ranks in which the suffixes of these slots are told apart by their sorted keys."""
        rank = before.copy()
        new = np.append(True, keys[1:] != keys[:-1])
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))] + 1
        return rank

    if not len(order):
        return left, [np.zeros(n, np.int64)]
    levels = [ranked(np.arange(len(order)), ids[order], np.zeros(n, np.int64))]
    h = 1
    while h < depth:
        rank = levels[-1]
        by_slot = rank[order]
        tied = np.zeros(len(order), bool)
        same = by_slot[1:] == by_slot[:-1]
        tied[1:] = same
        tied[:-1] |= same
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        at = order[slots]
        keys = rank[at] * (n + 1) + np.where(left[at] > h, rank[np.minimum(at + h, n - 1)], 0)
        by_key = np.argsort(keys, kind="stable")
        order[slots] = at[by_key]
        levels.append(ranked(slots, keys[by_key], rank))
        h *= 2
    return left, levels


def common_words(left: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words the suffixes at places a and b have in common, as far as the levels know."""
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        rank = levels[k]
        step = np.where((rank[a] == rank[b]) & (rank[a] > 0), np.minimum(1 << k, left[a]), 0)
        a, b, out = a + step, b + step, out + step
    return out


class TestBlock:
    """Some test items, as word ids."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        texts = [(name, clean(t).split()) for name, t in items]
        texts = [(name, words) for name, words in texts if words]
        self.names = [name for name, _ in texts]
        self.vocab = {w: i for i, w in enumerate(sorted({w for _, words in texts for w in words}))}
        self.longest = max((len(words) for _, words in texts), default=0)
        ids, item, start, size = [], [], [], []
        for i, (_, words) in enumerate(texts):
            n = len(words)
            ids += [self.vocab[w] for w in words] + [-1]
            item += [i] * (n + 1)
            start += range(n + 1)
            size += [window] * (n - window + 1) + [0] * window if n >= window else [n] + [0] * n
        self.ids, self.item, self.start = np.array(ids, np.int64), np.array(item, np.int64), np.array(start, np.int64)
        #: Places in ids of the suffixes that begin with a window, and the words of that window.
        self.at = np.flatnonzero(size)
        self.size = np.array(size, np.int64)[self.at]
        #: The fewest words of a window that begins with this word; the last entry is for words of no item.
        self.least = np.full(len(self.vocab) + 1, np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.ids[self.at], self.size)


class Matches:
    """The longest match of each test suffix in a shard: ``ids`` are its word ids by the block's vocabulary, -1 for other words and behind each document."""

    def __init__(self, ids: np.ndarray, block: TestBlock):
        n, self.block = len(ids), block
        ends = np.flatnonzero(ids < 0)
        begins = np.append(0, ends[:-1] + 1)
        run = np.repeat(np.arange(len(ends)), ends - begins + 1)
        starts = block.least[ids] <= ends[run] - np.arange(n)  # a window may begin here
        keep = np.zeros(len(ends), bool)
        keep[run[starts]] = True
        place = np.flatnonzero(keep[run])
        t = len(block.ids)
        self.left, self.levels = suffix_ranks(np.concatenate([block.ids, ids[place]]), block.longest)
        rank = self.levels[-1]
        own = t + np.flatnonzero(starts[place])
        self.own = own[np.argsort(rank[own], kind="stable")]  # the suffix array of the shard
        self.place = np.concatenate([np.full(t, -1), place])[self.own]
        found = np.searchsorted(rank[self.own], rank[block.at])
        self.length, self.near = np.zeros(len(block.at), np.int64), np.zeros(len(block.at), np.int64)
        for side in (found - 1, found):
            q = np.flatnonzero((side >= 0) & (side < len(self.own)))
            words = common_words(self.left, self.levels, block.at[q], self.own[side[q]])
            better = words > self.length[q]
            self.length[q[better]], self.near[q[better]] = words[better], side[q[better]]
        #: Words that neighbours in the suffix array have in common.
        self.shared = common_words(self.left, self.levels, self.own[:-1], self.own[1:])

    def windows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length of window that occurs: (length, groups of places, places, groups of items, items).

        Places and items of the same group share the window. Each (group, place) and (group, item) comes once.
        """
        for size in np.unique(self.block.size):
            q = np.flatnonzero((self.block.size == size) & (self.length >= size))
            if not len(q):
                continue
            group = np.cumsum(np.append(0, self.shared < size))
            of_q = group[self.near[q]]
            hit = np.zeros(group[-1] + 1, bool)
            hit[of_q] = True
            members = np.flatnonzero(hit[group])
            pairs = np.unique(of_q * len(self.block.names) + self.block.item[self.block.at[q]])
            yield int(size), group[members], self.place[members], pairs // len(self.block.names), pairs % len(self.block.names)


def _meet(groups: np.ndarray, docs: np.ndarray, item_groups: np.ndarray, items: np.ndarray, n_items: int, most: int = 1 << 22) -> np.ndarray:
    """Distinct doc * n_items + item of those that meet in a group, some ``most`` pairs at a time."""
    n_docs = int(docs.max()) + 1
    by_group = np.unique(groups * n_docs + docs)
    group, doc = by_group // n_docs, by_group % n_docs
    lo, hi = np.searchsorted(group, item_groups, "left"), np.searchsorted(group, item_groups, "right")
    parts = np.cumsum(hi - lo) // most
    out = []
    for p in np.unique(parts):
        i = np.flatnonzero(parts == p)
        n = hi[i] - lo[i]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out.append(np.unique(doc[np.repeat(lo[i], n) + within] * n_items + np.repeat(items[i], n)))
    return np.unique(np.concatenate(out))


@lru_cache(maxsize=1)
def _block(folder: str, number: int, window: int) -> TestBlock:
    import pyarrow.dataset as ds

    fs, base = file_system(folder)
    t = ds.dataset(f"{base}/block={number}", filesystem=fs, format="parquet").to_table(columns=["item", "text"])
    return TestBlock(list(zip(t["item"].to_pylist(), t["text"].cast(pa.binary()).to_pylist(), strict=True)), window)


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(keys, cleaned texts) of some ``most`` words each; whole texts."""
    keys, texts, size = [], [], 0
    for batch in batches:
        first, column = 0, batch.column(1).cast(pa.binary())
        for i, t in enumerate(column):
            text = clean(t.as_py())
            texts.append(text)
            size += text.count(b" ") + 2
            if size >= most:
                keys.append(batch.column(0).slice(first, i + 1 - first))
                yield pa.concat_arrays(keys), texts
                first, keys, texts, size = i + 1, [], [], 0
        if first < len(column):
            keys.append(batch.column(0).slice(first))
    if texts:
        yield pa.concat_arrays(keys), texts


def _ids(texts: list[bytes], vocab: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word ids, each text ended by -1; words of each text)."""
    out, sizes = [], []
    for t in texts:
        words = t.split()
        sizes.append(len(words))
        out.append(np.fromiter(map(vocab.get, words, repeat(-1)), np.int64, len(words)))
        out.append(np.full(1, -1))
    return np.concatenate(out), np.array(sizes, np.int64)


def store_items(bench: DataFrame, item: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[str, list[int]]:
    """(folder, numbers of the blocks) of the test items in the shared folder."""
    spark = bench.sparkSession
    rows = bench.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).where("text is not null").distinct()
    rows = settle(rows, "items")
    n = -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes)
    folder = new_path(spark, "test-blocks")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(max(1, n))))
    rows.repartition("block").write.partitionBy("block").parquet(folder)
    return folder, sorted(r[0] for r in rows.select("block").distinct().collect())


def audit(
    docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row a document: (key, n_words, n_hit, items, spans).

    ``items`` are the ids of the items with occurring windows, as sorted strings; ``spans`` are the
    runs of hit words, as [start, end) in words.
    """
    on_workers(docs.sparkSession)
    folder, numbers = store_items(bench, item, item_text, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _shards(batches, shard_words):
            names: dict[int, set[str]] = {}
            sizes, hit = None, None
            for number in numbers:
                block = _block(folder, number, window)
                ids, sizes = _ids(texts, block.vocab)
                bounds = np.cumsum(sizes + 1) - sizes - 1
                edges = np.zeros(len(ids) + 1, np.int64)
                for n, groups, places, item_groups, items in Matches(ids, block).windows():
                    np.add.at(edges, places, 1)
                    np.add.at(edges, places + n, -1)
                    of = np.searchsorted(bounds, places, "right") - 1
                    for pair in _meet(groups, of, item_groups, items, len(block.names)).tolist():
                        names.setdefault(pair // len(block.names), set()).add(block.names[pair % len(block.names)])
                here = np.cumsum(edges[:-1]) > 0
                hit = here if hit is None else hit | here
            if hit is None:
                sizes = np.array([len(t.split()) for t in texts], np.int64)
                hit = np.zeros(int((sizes + 1).sum()), bool)
            bounds = np.cumsum(sizes + 1) - sizes - 1
            total = np.append(0, np.cumsum(hit))
            turns = np.flatnonzero(np.diff(hit, prepend=False, append=False)).reshape(-1, 2)
            of = np.searchsorted(bounds, turns[:, 0], "right") - 1
            spans = pa.StructArray.from_arrays([pa.array(turns[:, i] - bounds[of]) for i in (0, 1)], ["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [
                    keys, pa.array(sizes), pa.array(total[bounds + sizes] - total[bounds]),
                    pa.array([sorted(names.get(i, ())) for i in range(len(texts))], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)), spans),
                ],
                [key, "n_words", "n_hit", "items", "spans"],
            )

    rows = docs.select(key, text)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, n_words bigint, n_hit bigint, items array<string>, spans array<struct<start:bigint,end:bigint>>")


def longest_matches(
    docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item, item_start, length, key, doc_start): the longest verbatim match of each test suffix that holds a window, over all shards.

    Places are in words. Of places with equally long matches it is the one with the smallest key, then
    the earliest, among those that the shards report, one each. A suffix whose window occurs nowhere has no row.
    """
    on_workers(docs.sparkSession)
    folder, numbers = store_items(bench, item, item_text, block_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _shards(batches, shard_words):
            for number in numbers:
                block = _block(folder, number, window)
                ids, sizes = _ids(texts, block.vocab)
                found = Matches(ids, block)
                bounds = np.cumsum(sizes + 1) - sizes - 1
                q = np.flatnonzero(found.length >= block.size)
                place = found.place[found.near[q]]
                of = np.searchsorted(bounds, place, "right") - 1
                names = np.array([*block.names, ""], object)[block.item[block.at[q]]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(block.start[block.at[q]]), pa.array(found.length[q]), keys.take(pa.array(of)), pa.array(place - bounds[of])],
                    ["item", "item_start", "length", "k", "doc_start"],
                )

    rows = docs.select(key, text)
    found = rows.mapInArrow(run, f"item string, item_start bigint, length bigint, k {rows.schema[0].dataType.simpleString()}, doc_start bigint")
    best = found.groupBy("item", "item_start").agg(F.min(F.struct(-F.col("length"), F.col("k"), F.col("doc_start"))).alias("b"))
    return best.select("item", "item_start", (-F.col("b.col1")).alias("length"), F.col("b.k").alias(key), F.col("b.doc_start").alias("doc_start"))


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without those that are affected. Equal texts are affected alike, so they are told by their digests, and rows stay where they are if those are few."""
    digest = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    found = audit(docs.select(digest.alias("digest"), F.col(text).alias("text")), bench, "digest", "text", item, item_text, window)
    bad = settle(found.where("n_hit > 0").select("digest").distinct(), "affected")
    return drop_matches(docs, digest, bad, "digest")
