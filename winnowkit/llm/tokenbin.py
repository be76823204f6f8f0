"""Token ids in binary files of directly addressable codes.

A shard file holds the ids of a run of documents, in segments of ``SEGMENT`` ids::

    shard    := segment* directory footer
    segment  := "DAC1" levels:u32 n:u64 (items:u64 chunks:u64 bits:u64 ranks:u64)*levels level*
    level    := the low 8 bits of each id that gets so far: u8 each
                continuation bitmap: 1 where the id has higher bits, lowest bit first, padded to 64 bytes
                rank directory: u32 for each 512 bits, the ones before them
    directory:= segment places:u64*, then for each document null:u8*, id:i64*, first token:u64*
    footer   := directory:u64 segments:u64 documents:u64 tokens:u64 "DACSHARD"

The chunk of token i on level 0 is at i. If its bit is set, its chunk on the next level is at the
number of ones before it, which the rank directory and at most 64 bytes of bitmap give; so a
token costs a few bytes on each level, wherever it stands, and no block is decoded. The last
level has no bitmap. All integers are little-endian.

Rows are range-partitioned and sorted by key before they are encoded, one partition a shard.
Tasks write shards under names of their own, and only the table of shards says which count, so
a task that runs twice or dies leaves nothing that is read.

Defined results: a null text is empty and consists of the end id. Null keys come first. Equal
keys and repeated rows stay, in the order of the scan; a key with very many rows spreads
over shards. No rows give no shards and no documents. Other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import file_system, new_path, settle
from .tokens import library_encoder, sub_batches, tokenizer_path

SEGMENT = 1 << 20
_HEAD, _LEVEL, _FOOT = struct.Struct("<4sIQ"), struct.Struct("<4Q"), struct.Struct("<4Q8s")


def encode_segment(ids: np.ndarray) -> bytes:
    """One segment of unsigned ids."""
    levels, rest = [], ids.astype(np.uint64)
    while True:
        more = rest > 0xFF
        levels.append(((rest & 0xFF).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> np.uint64(8)
    at = _HEAD.size + _LEVEL.size * len(levels)
    table, body = [], []
    for i, (chunks, more) in enumerate(levels):
        parts = [chunks.tobytes()]
        if i < len(levels) - 1:
            bits = np.packbits(more, bitorder="little")
            bits = np.pad(bits, (0, -len(bits) % 64))
            ones = np.bitwise_count(bits).reshape(-1, 64).sum(axis=1, dtype=np.int64)
            parts += [bits.tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
        places = [at]
        for p in parts:
            at += len(p)
            places.append(at)
        table.append(_LEVEL.pack(len(chunks), places[0], places[1] if len(parts) > 1 else 0, places[2] if len(parts) > 1 else 0))
        body += parts
    return b"".join([_HEAD.pack(b"DAC1", len(levels), len(ids)), *table, *body])


class ShardReader:
    """Random access to a shard. ``source`` has read_at(n, offset) and size(), as Arrow's files do."""

    def __init__(self, source):
        self.source = source
        directory, segments, self.n_docs, self.n_tokens, magic = _FOOT.unpack(source.read_at(_FOOT.size, source.size() - _FOOT.size))
        if magic != b"DACSHARD":
            raise ValueError("this is no shard file")
        self.segments = np.frombuffer(source.read_at(8 * segments, directory), "<u8")
        at = directory + 8 * segments
        self.null = np.frombuffer(source.read_at(self.n_docs, at), np.uint8).astype(bool)
        self.doc_ids = np.frombuffer(source.read_at(8 * self.n_docs, at + self.n_docs), "<i8")
        self.starts = np.frombuffer(source.read_at(8 * self.n_docs, at + 9 * self.n_docs), "<u8").astype(np.int64)
        self._levels: dict[int, list[tuple[int, int, int, int]]] = {}

    def levels(self, segment: int) -> list[tuple[int, int, int, int]]:
        if segment not in self._levels:
            at = int(self.segments[segment])
            magic, n, _ = _HEAD.unpack(self.source.read_at(_HEAD.size, at))
            if magic != b"DAC1":
                raise ValueError("this is no segment")
            raw = self.source.read_at(_LEVEL.size * n, at + _HEAD.size)
            self._levels[segment] = [tuple([items, *(at + x if x else 0 for x in places)]) for items, *places in _LEVEL.iter_unpack(raw)]
        return self._levels[segment]

    def _ones_before(self, bits: int, ranks: int, i: int) -> int:
        block = i >> 9
        (ones,) = struct.unpack("<I", self.source.read_at(4, ranks + 4 * block))
        n = (i & 511) + 7 >> 3
        if n:
            part = np.frombuffer(self.source.read_at(n, bits + 64 * block), np.uint8).copy()
            if i & 7:
                part[-1] &= (1 << (i & 7)) - 1
            ones += int(np.bitwise_count(part).sum())
        return ones

    def token(self, i: int) -> int:
        """The id at place i of the shard."""
        segment, i = divmod(i, SEGMENT)
        value, shift = 0, 0
        for _, chunks, bits, ranks in self.levels(segment):
            value |= self.source.read_at(1, chunks + i)[0] << shift
            if not bits or not self.source.read_at(1, bits + (i >> 3))[0] >> (i & 7) & 1:
                break
            i, shift = self._ones_before(bits, ranks, i), shift + 8
        return value

    def tokens(self, start: int, n: int) -> np.ndarray:
        """n ids from place start: on each level they are one run."""
        out = []
        while n > 0:
            segment, i = divmod(start, SEGMENT)
            m = min(n, SEGMENT - i)
            out.append(self._run(segment, i, m))
            start, n = start + m, n - m
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def _run(self, segment: int, i: int, n: int) -> np.ndarray:
        values, live, shift = np.zeros(n, np.uint32), np.arange(n), 0
        for _, chunks, bits, ranks in self.levels(segment):
            values[live] |= np.frombuffer(self.source.read_at(len(live), chunks + i), np.uint8).astype(np.uint32) << np.uint32(shift)
            if not bits:
                break
            first, last = i >> 3, i + len(live) + 7 >> 3
            raw = np.unpackbits(np.frombuffer(self.source.read_at(last - first, bits + first), np.uint8), bitorder="little")
            more = raw[i & 7 : (i & 7) + len(live)].astype(bool)
            if not more.any():
                break
            i, live, shift = self._ones_before(bits, ranks, i), live[more], shift + 8
        return values


class _ShardWriter:
    def __init__(self, out):
        self.out, self.at = out, 0
        self.segments: list[int] = []
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.n_tokens, self.held, self.n_held = 0, [], 0

    def _put(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_tokens)
        self.n_tokens += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= SEGMENT:
            every = np.concatenate(self.held)
            self.segments.append(self.at)
            self._put(encode_segment(every[:SEGMENT]))
            self.held, self.n_held = [every[SEGMENT:]], len(every) - SEGMENT

    def close(self) -> None:
        if self.n_held:
            self.segments.append(self.at)
            self._put(encode_segment(np.concatenate(self.held)))
        directory = self.at
        self._put(np.array(self.segments, "<u8").tobytes())
        self._put(bytes(d is None for d in self.doc_ids))
        self._put(np.array([d or 0 for d in self.doc_ids], "<i8").tobytes())
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(_FOOT.pack(directory, len(self.segments), len(self.doc_ids), self.n_tokens, b"DACSHARD"))


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = 1) -> DataFrame:
    """Write the shards of ``docs`` to ``folder`` (a URI that all executors reach); the table of shards.

    Returns (file, shard, n_docs, n_tokens), written beside the shards as ``folder``/shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(path or tokenizer_path("word_bpe_49k.json"))
        context = TaskContext.get()
        fs, base = file_system(folder)
        name = f"shard-{context.partitionId():05d}-{uuid.uuid4().hex}.dac"
        writer = None
        for batch in batches:
            for at, texts in sub_batches(batch.column(1).to_pylist()):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    stream = fs.open_output_stream(f"{base}/{name}")
                    writer = _ShardWriter(stream)
                for k, raw in zip(batch.column(0).slice(at, len(texts)).to_pylist(), enc.encode(texts), strict=True):
                    writer.add(k, np.append(np.frombuffer(raw, enc.dtype), enc.dtype.type(end_id)))
        enc.forget()
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict(
                {"file": [name], "shard": pa.array([context.partitionId()], pa.int64()), "n_docs": pa.array([len(writer.doc_ids)], pa.int64()), "n_tokens": pa.array([writer.n_tokens], pa.int64())}
            )

    rows = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("t"), F.monotonically_increasing_id().alias("nth"))
    ordered = rows.repartitionByRange("k", "nth").sortWithinPartitions("k", "nth").select("k", "t")
    shards = ordered.mapInArrow(run, "file string, shard bigint, n_docs bigint, n_tokens bigint")
    return settle(shards, "shards", f"{folder.rstrip('/')}/shards")


def open_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/shards")


def _checksums(shard: ShardReader, starts: np.ndarray, ends: np.ndarray) -> Iterator[int]:
    """crc32 of each document's ids; documents side by side are read together, up to SEGMENT ids."""
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SEGMENT, "right")))
        ids = shard.tokens(int(starts[first]), int(ends[last - 1] - starts[first])).astype("<u4")
        for a, b in zip((starts[first:last] - starts[first]).tolist(), (ends[first:last] - starts[first]).tolist(), strict=True):
            yield zlib.crc32(ids[a:b])
        first = last


def read_documents(shards: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """One row a document from the files: (key, start, n_tokens, ids_crc32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{base}/{row['file']}") as f:
                    shard = ShardReader(f)
                    ends = np.append(shard.starts[1:], shard.n_tokens)
                    for at in range(0, shard.n_docs, 8192):
                        s, e = shard.starts[at : at + 8192], ends[at : at + 8192]
                        crc = list(_checksums(shard, s, e))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(shard.doc_ids[at : at + 8192], mask=shard.null[at : at + 8192]), pa.array(s + row["base"]), pa.array(e - s), pa.array(crc, pa.int64())],
                            [key, "start", "n_tokens", "ids_crc32"],
                        )

    # One row a shard, so the running sum is over a small table. The rows are dealt out to a stated number of
    # tasks, one a shard: adaptive execution would put them all into one, for they are tiny and their files aren't.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    dealt = placed.repartitionByRange(max(1, shards.count()), "shard")
    return dealt.mapInArrow(run, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def write_and_read(docs: DataFrame, path: str | None = None, folder: str | None = None) -> DataFrame:
    folder = folder or new_path(docs.sparkSession, "tokens")
    return read_documents(write_tokens(docs, folder, path), folder)
