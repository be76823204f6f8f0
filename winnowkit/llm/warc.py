"""Merkle fixity audit of WARC replicas.

``write`` stores records as WARC files, a compressed member each, and returns their index: file,
path, place and size of every record. ``measure`` reads those bytes back, in this replica or in
another, and hashes them; what can't be read, or reads as zeros only, isn't there. Records hash
into the range of ``RANGE`` stored bytes that they begin in; ranges hash in order into their
parent, ``FANOUT`` at a time, level by level, up to one root a file. An audit compares the
roots of two replicas and goes down only where they differ: at each level it reads just the
children of nodes that don't match, until it has the records. A node has at most FANOUT children
and a range as many records as fit its bytes, so no task gathers an unbounded group.

A file is written by one task, so size files as one does WARCs; its records are streamed. Reading
is dealt out by stretches of files, however large one is. Files are written under names of their
own, and only the index says which count, so a task that runs twice or dies leaves nothing that
is read.

Defined results: a null url or html renders as empty. A null file is a file of its own. Records that
one replica has and the other lacks are found as missing or extra. Records at the same place are
compared as a set. Two empty manifests match. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import file_system, settle

RANGE = 1 << 18
FANOUT = 64
#: Stored bytes that a task reads.
STRETCH = 1 << 26
INDEX = "file bigint, path string, record_id bigint, at bigint, size bigint, offset bigint, length bigint"
_FIELDS = [f.split(" ")[0] for f in INDEX.split(", ")]


def record(record_id: Column, url: Column, body: Column) -> Column:
    """A WARC/1.1 resource record as a string."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:record:"), F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string() if f == "path" else pa.int64() for f in _FIELDS]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], _FIELDS)


class _Writer:
    """Files that a task writes one after the other, under names of its own."""

    def __init__(self, folder: str):
        self.fs, self.base = file_system(folder)
        self.out, self.name, self.at = None, "", 0

    def begin(self, file: int | None) -> None:
        self.end()
        self.fs.create_dir(self.base, recursive=True)
        self.name, self.at = f"{'none' if file is None else file}-{uuid.uuid4().hex}.warc.gz", 0
        self.out = self.fs.open_output_stream(f"{self.base}/{self.name}", compression=None)

    def put(self, raw: bytes) -> int:
        """Where the bytes now stand."""
        self.out.write(raw)
        self.at += len(raw)
        return self.at - len(raw)

    def end(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _member(raw: bytes) -> bytes:
    """A gzip member, the same at any time."""
    c = zlib.compressobj(4, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


def _unpacked(raw: bytes) -> bytes | None:
    try:
        return zlib.decompress(raw, 31)
    except zlib.error:
        return None


def write(pages: DataFrame, folder: str, file: str = "file", record_id: str = "record_id", url: str = "url", body: str = "html") -> DataFrame:
    """Store a record for each page in the WARC of its file, by record id; the index of what was stored.

    ``at`` and ``size`` are the member's place in its file, ``offset`` and ``length`` the record's in the unpacked one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, offset = _Writer(folder), None, 0
        for batch in batches:
            rows = []
            for f, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (f,):
                    out.begin(f)
                    now, offset = (f,), 0
                raw = text.encode()
                packed = _member(raw)
                rows.append((f, out.name, i, out.put(packed), len(packed), offset, len(raw)))
                offset += len(raw)
            yield _index(rows)
        out.end()

    rows = pages.select(F.col(file).cast("bigint").alias("f"), F.col(record_id).cast("bigint").alias("i"), F.col(url).alias("u"), F.col(body).alias("b"))
    dealt = rows.repartition("f").sortWithinPartitions("f", "i", "u", F.xxhash64("b"))
    stored = dealt.select("f", "i", record(F.col("i"), F.col("u"), F.col("b")).alias("r")).mapInArrow(run, INDEX)
    return settle(stored, "index", f"{folder.rstrip('/')}/index")


def _read(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes | None]]:
    """Rows of an index with the bytes that stand there; None beyond the end or without the file."""
    fs, base = file_system(folder)
    name, source, size = None, None, 0
    for batch in batches:
        for row in batch.to_pylist():
            if row["path"] != name:
                name = row["path"]
                info = fs.get_file_info(f"{base}/{name}")
                source, size = (fs.open_input_file(info.path), info.size) if info.is_file else (None, 0)
            yield row, source.read_at(row["size"], row["at"]) if source is not None and row["at"] + row["size"] <= size else None


def copy(index: DataFrame, folder: str, to: str, change: Callable[[int, bytes], bytes] | None = None) -> DataFrame:
    """Copy stored files, a task each; the index of the copies. ``change`` may harm a record's bytes, not their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, rows = _Writer(to), None, []
        for row, raw in _read(folder, batches):
            if raw is None:
                raise ValueError(f"{row['path']}: nothing stands at {row['at']}")
            if now != row["path"]:
                now = row["path"]
                out.begin(row["file"])
            out.put(change(row["record_id"], raw) if change else raw)
            rows.append(tuple((row | {"path": out.name}).values()))
            if len(rows) == 4096:
                yield _index(rows)
                rows = []
        out.end()
        yield _index(rows)

    dealt = index.select(*_FIELDS).repartition("path").sortWithinPartitions("path", "at")
    return settle(dealt.mapInArrow(run, INDEX), "index", f"{to.rstrip('/')}/index")


def measure(index: DataFrame, folder: str) -> DataFrame:
    """The manifest of what stands in the files now: (file, record_id, offset, length, digest) of the stored
    bytes, and (record_offset, record_length, record_digest) of the record in them, the last null if it can't be unpacked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for row, raw in _read(folder, batches):
            if raw is not None and raw.count(0) < len(raw):
                text = _unpacked(raw)
                inner = None if text is None else hashlib.sha256(text).hexdigest()
                rows.append((row["file"], row["record_id"], row["at"], row["size"], hashlib.sha256(raw).hexdigest(), row["offset"], row["length"], inner))
            if len(rows) == 4096:
                yield out()
                rows = []
        yield out()

    schema = "file bigint, record_id bigint, offset bigint, length bigint, digest string, record_offset bigint, record_length bigint, record_digest string"
    names = [f.split(" ")[0] for f in schema.split(", ")]
    total = index.agg(F.sum("size")).first()[0] or 0
    dealt = index.select(*_FIELDS).repartitionByRange(1 + total // STRETCH, "path", "at").sortWithinPartitions("path", "at")
    return settle(dealt.mapInArrow(run, schema), "manifest")


def height(*manifests: DataFrame) -> int:
    """Levels below the root, so that no node of any of the manifests has more than FANOUT children."""
    last = max((m.agg(F.max("offset")).first()[0] or 0) for m in manifests) // RANGE
    levels = 1
    while last >= FANOUT:
        last, levels = last // FANOUT, levels + 1
    return levels


def tree(manifest: DataFrame, levels: int | None = None) -> list[DataFrame]:
    """Trees of all files, from the ranges up: (file, node, parent, hash) at each level, the roots last.

    Each level is a table in the shared folder, so comparing reads no records.
    """
    levels = levels or height(manifest)
    leaves = manifest.select(
        "file", (F.col("offset") / RANGE).cast("bigint").alias("node"),
        F.struct("offset", "length", "digest").alias("item"),
    )
    text = lambda x: F.concat_ws(":", x["offset"].cast("string"), x["length"].cast("string"), x["digest"])
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("item")), text), "\n")
    level = leaves.groupBy("file", "node").agg(F.sha2(joined.cast("binary"), 256).alias("hash"))
    out = []
    for i in range(levels):
        parent = (F.col("node") / FANOUT).cast("bigint")
        out.append(settle(level.withColumn("parent", parent), f"level{i}"))
        children = F.array_sort(F.collect_list(F.struct("node", "hash")))
        joined = F.array_join(F.transform(children, lambda x: F.concat_ws(":", x["node"].cast("string"), x["hash"])), "\n")
        level = out[-1].groupBy("file", F.col("parent").alias("node")).agg(F.sha2(joined.cast("binary"), 256).alias("hash"))
    return [*out, level.withColumn("parent", F.lit(None).cast("bigint"))]


def _differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The keys at which the two don't have the same value."""
    b = b.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.col(value).alias("b_value"))
    same = F.lit(True)
    for k in keys:
        same = same & a[k].eqNullSafe(b[f"b_{k}"])
    return (
        a.join(b, same, "full")
        .where(~F.col(value).eqNullSafe(F.col("b_value")))
        .select(*[F.when(a[value].isNotNull(), F.col(k)).otherwise(F.col(f"b_{k}")).alias(k) for k in keys])
    )


def _below(level: DataFrame, bad: DataFrame, on: Column) -> DataFrame:
    return level.join(bad, on & level["file"].eqNullSafe(bad["bad_file"]), "left_semi")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """(file, offset, state) of each record that differs: changed, missing in the replica, or extra there."""
    levels = height(primary, replica)
    ours, theirs = tree(primary, levels), tree(replica, levels)
    bad = _differing(ours[-1], theirs[-1], ["file", "node"], "hash")
    for a, b in zip(ours[-2::-1], theirs[-2::-1], strict=True):
        bad = settle(bad.select(F.col("file").alias("bad_file"), F.col("node").alias("bad_node")), "differing")
        bad = _differing(_below(a, bad, F.col("parent") == F.col("bad_node")), _below(b, bad, F.col("parent") == F.col("bad_node")), ["file", "node"], "hash")
    bad = settle(bad.select(F.col("file").alias("bad_file"), F.col("node").alias("bad_node")), "differing")

    def records(manifest: DataFrame, name: str) -> DataFrame:
        inside = _below(manifest, bad, (manifest["offset"] / RANGE).cast("bigint") == F.col("bad_node"))
        return inside.groupBy("file", "offset").agg(F.array_sort(F.collect_list(F.struct("length", "digest"))).alias(name))

    a, b = records(primary, "ours"), records(replica, "theirs").withColumnsRenamed({"file": "b_file", "offset": "b_offset"})
    both = a.join(b, a["file"].eqNullSafe(b["b_file"]) & (a["offset"] == b["b_offset"]), "full").where(~F.col("ours").eqNullSafe(F.col("theirs")))
    state = F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra").otherwise("changed")
    return both.select(
        F.when(F.col("ours").isNull(), F.col("b_file")).otherwise(F.col("file")).alias("file"),
        F.coalesce("offset", "b_offset").alias("offset"), state.alias("state"),
    )
