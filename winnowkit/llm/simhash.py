"""SimHash near-duplicates by anchor-point covering.

A fingerprint is cut into two halves of 32 bits. Fingerprints that differ in at most 3 bits
differ in at most one bit of some half. The anchors of a half are the code words of a covering
code of radius 1: the Hamming code of length 31 for bits 0-30, and bit 31 as it is. So in the
half that differs least, both fingerprints lie within radius + threshold = 2 of the anchor next to
either. Each distinct fingerprint is replicated to all anchors within distance 2 of each half
(17 at most), and compared in full inside each anchor.

Equal fingerprints are one, so copies cost nothing here. Inside an anchor only a spanning forest of
the links is returned: exact, and never more rows than members. An anchor with more than ``most``
members is handed out again in cells, each of two chunks of it, and a cell that is still too large
is split in the same way by another hash, until none is left; so no task holds more than a cell
and nothing is capped. The links become components in the shared folder.

Defined results: a null text has no words; texts without words have fingerprint zero, and so are
linked to each other. The component of a document is the smallest non-null key it reaches; null
if there is none. Equal keys and repeated rows give a row each. No rows give no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import settle

THRESHOLD = 3
MOST = 8192
SHINGLE = 3
SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text: bits set in over half of its shingles' XXH64."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six white-space bytes only
    if not words:
        return 0
    flat = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(lengths) - lengths
    ends = (starts + lengths - 1)[shingle - 1 :] if len(words) >= shingle else np.array([len(flat)])
    digest = xxhash.xxh64_intdigest

    def hashes(at: int) -> np.ndarray:
        s, e = starts[at : min(n, at + _BLOCK)].tolist(), ends[at : at + _BLOCK].tolist()
        return np.fromiter([digest(flat[a:b], seed) for a, b in zip(s, e, strict=True)], np.uint64, len(s))

    return majority(map(hashes, range(0, n, _BLOCK)))


def majority(blocks: Iterable[np.ndarray]) -> int:
    """The fingerprint of shingles whose hashes come in blocks: the bits set in over half of them."""
    ones, n = np.zeros(64, np.int64), 0
    for h in blocks:
        n += len(h)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fp is the fingerprint as a signed 64-bit integer."""
    rows = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], [key, "fp"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, fp bigint")


def _syndromes(half: np.ndarray) -> np.ndarray:
    """The 5-bit syndrome of bits 0-30; position p stands for column p + 1 of the Hamming code."""
    s = np.zeros(len(half), np.uint32)
    for p in range(31):
        s ^= np.where(half >> np.uint32(p) & np.uint32(1), np.uint32(p + 1), np.uint32(0))
    return s


#: For each syndrome, the bit patterns that lead to a code word within distance 2.
_TO_ANCHORS = [
    sorted({0, 1 << 31})
    if s == 0
    else sorted({1 << (s - 1), 1 << (s - 1) | 1 << 31} | {1 << (a - 1) | 1 << ((a ^ s) - 1) for a in range(1, 32) if a ^ s and a < a ^ s})
    for s in range(32)
]


def anchors_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor) for each anchor that a fingerprint goes to; bit 32 of an anchor tells the half."""
    index, anchor = [], []
    for h in range(2):
        half = (fp >> np.uint64(32 * h) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        syndrome = _syndromes(half)
        for s in range(32):
            i = np.flatnonzero(syndrome == s)
            if len(i):
                masks = np.array(_TO_ANCHORS[s], np.uint32)
                index.append(np.repeat(i, len(masks)))
                anchor.append((half[i][:, None] ^ masks[None, :]).ravel().astype(np.int64) + (h << 32))
    return (np.concatenate(index), np.concatenate(anchor)) if index else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def near(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= threshold


def forest(fp: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints, as pairs of indices."""
    out, rest = [], np.arange(len(fp))
    while len(rest):
        front, rest = [int(rest[0])], rest[1:]
        while front and len(rest):
            i = front.pop()
            hit = near(fp[rest], fp[i], threshold)
            if hit.any():
                found = rest[hit].tolist()
                out += [(i, j) for j in found]
                front += found
                rest = rest[~hit]
    return out


def _sorted_runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Whole batches of (group, fp) rows, sorted by group; the last group waits for the next batch.

    A group of more than ``most`` rows comes in parts of its own, flagged, none of them held back.
    """
    key, fp, large = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
    for batch in batches:
        key = np.concatenate([key, batch.column(0).to_numpy()])
        fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
        while len(key):
            if large is not None:
                n = int(np.searchsorted(key, large, "right"))
                if n:
                    yield key[:n], fp[:n], True
                key, fp, large = key[n:], fp[n:], large if n == len(key) else None
                continue
            cut = int(np.searchsorted(key, key[-1], "left"))  # where the last group begins
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(starts, len(key)))
            big = np.flatnonzero(sizes > most)
            if len(big):
                s = int(starts[big[0]])
                if s:
                    yield key[:s], fp[:s], False
                large, key, fp = int(key[s]), key[s:], fp[s:]
                continue
            if cut:
                yield key[:cut], fp[:cut], False
            key, fp = key[cut:], fp[cut:]
            break
    if len(key):
        yield key, fp, False


def _links_in(key: np.ndarray, fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links inside each run of equal keys."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    close = np.zeros(len(starts), bool)
    run_of = np.repeat(np.arange(len(starts)), sizes)
    small = np.flatnonzero(sizes <= 32)
    if len(small):
        live = np.flatnonzero((sizes <= 32)[run_of])
        for o in range(1, int(sizes[small].max())):
            i = live[live + o < len(key)]
            i = i[(key[i] == key[i + o])]
            close[run_of[i[near(fp[i], fp[i + o], threshold)]]] = True
            live = i
    close |= sizes > 32
    a, b = [], []
    for r in np.flatnonzero(close):
        part = fp[starts[r] : starts[r] + sizes[r]]
        for i, j in forest(part, threshold):
            a.append(part[i])
            b.append(part[j])
    return np.array(a, np.uint64), np.array(b, np.uint64)


_FOUND = "kind int, a bigint, b bigint"


def _found(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])


def _compare(threshold: int, most: int = MOST):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links (kind 0), and members of groups that are too large for one task (kind 1: group, fp)."""
        for key, fp, large in _sorted_runs(batches, most):
            if large:
                yield _found(1, key, fp)
                continue
            a, b = _links_in(key, fp, threshold)
            if len(a):
                yield _found(0, a, b)

    return run


def links(fps: DataFrame, threshold: int = THRESHOLD, most: int = MOST) -> DataFrame:
    """(a, b): links among distinct fingerprints (column fp) whose components are those of all links."""
    if threshold > THRESHOLD:
        raise ValueError("the anchors cover differences of up to 3 bits")

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            i, anchor = anchors_of(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[i])], ["anchor", "fp"])

    # A count of partitions that adaptive execution leaves alone: rows grow 31-fold here, which it can't foresee.
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = fps.select("fp").repartition(tasks, "fp").mapInArrow(replicate, "anchor bigint, fp bigint")
    dealt = members.repartition("anchor").sortWithinPartitions("anchor")
    found = settle(dealt.mapInArrow(_compare(threshold, most), _FOUND), "found")
    out, level = found.where("kind = 0").select("a", "b"), 0
    while not (crowd := found.where("kind = 1")).isEmpty():
        level += 1
        cells = _cells(crowd.select(F.col("a").alias("anchor"), F.col("b").alias("fp")), most, level)
        dealt = cells.repartition("cell").sortWithinPartitions("cell")
        found = settle(dealt.mapInArrow(_compare(threshold, most), _FOUND), "crowded")
        out = out.union(found.where("kind = 0").select("a", "b"))
    return out


def _cells(crowd: DataFrame, most: int, level: int) -> DataFrame:
    """(cell, fp): each pair of chunks of an anchor as a cell, so that any two members meet in one.

    A chunk has most / 4 members on average, half of what two may fill a cell with: hashed chunks
    vary in size. Every level hashes anew, and has at least two chunks, so that cells shrink.
    """
    sizes = crowd.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    chunks = F.greatest(F.ceil(F.col("n") * 4 / most), F.lit(3)).cast("int")
    return (
        crowd.join(sizes, "anchor")
        .withColumn("chunks", chunks)
        .withColumn("c", F.pmod(F.xxhash64("fp", F.lit(level)), F.col("chunks")).cast("int"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(F.xxhash64("anchor", F.least("c", "o"), F.greatest("c", "o"), F.lit(level)).alias("cell"), "fp")
        .distinct()
    )


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, most: int = MOST) -> DataFrame:
    """One row a document: (key, fingerprint, component_id)."""
    fp = settle(fingerprints(docs, key, text), "fingerprints")
    distinct = fp.groupBy("fp").agg(F.min(key).alias("low"))
    roots = components(links(distinct, threshold, most))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    by_fp = settle(rooted.join(ids, "root").select(F.col("fp").alias("node"), "component_id"), "classes")
    return fp.join(by_fp, F.col("fp") == F.col("node")).select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
