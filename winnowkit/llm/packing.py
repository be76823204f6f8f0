"""Cost-balanced packing of token sequences.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n * n``: attention
inside a sequence doesn't cross documents. Documents are cut at the sequence length; a full
piece is a sequence of its own. What is left of each document is packed in groups: by
descending length, each goes to the lowest-cost sequence that still has room for all of it, and
where none has, it is cut to fill the lowest-cost one that has any room. A group has as many
full sequences as its tokens fill, and its last tokens make sequences whose capacities are
powers of two, which need no padding; so every sequence is full.

Groups are formed inside a partition: no shuffle, no count beforehand, and memory is bounded by
``group`` remainders. A task that is run again packs the same rows in the same way.

Defined results: a null text is empty and consists of the end id. Each row is packed, so ties,
repeated rows and null keys give pieces like any others. No rows give no pieces. Other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .store import on_workers
from .tokens import library_encoder, sub_batches, tokenizer_path

SEQUENCE = 1024
GROUP = 4096


def capacities(tokens: int, sequence: int = SEQUENCE) -> np.ndarray:
    """Full sequences, then the rest as powers of two."""
    full, rest = divmod(tokens, sequence)
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.array([sequence] * full + tail, np.int64)


def pack_group(lengths: np.ndarray, sequence: int = SEQUENCE, linear: float = 1.0, quadratic: float = 1 / 256) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece of a group of lengths, all under ``sequence``."""
    room = capacities(int(lengths.sum()), sequence)
    size, cost, out = room.copy(), np.zeros(len(room)), []
    for d in np.argsort(-lengths, kind="stable"):
        start, left = 0, int(lengths[d])
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room)
            s = fits[np.argmin(cost[fits])]
            n = min(left, int(room[s]))
            out.append((int(d), start, n, int(s), int(size[s] - room[s])))
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            start, left = start + n, left - n
    return out


_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", end_id: int = 0, sequence: int = SEQUENCE, group: int = GROUP) -> DataFrame:
    """One row a piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``sequence_id`` is unique: the partition in the high 32 bits, a running number in the low ones.
    """
    on_workers(docs.sparkSession)
    rows = docs.select(key, text)
    key_type = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(path or tokenizer_path("byte_bpe_50k.json"))
        end = enc.dtype.type(end_id).tobytes()
        next_id = TaskContext.get().partitionId() << 32
        keys: list = []
        out: list[list] = [[] for _ in _COLUMNS]
        rest: list[tuple] = []  # (key, start, ids, doc_tokens)

        def emit(k, *values) -> None:
            keys.append(k)
            for col, v in zip(out, values, strict=True):
                col.append(v)

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array(c, pa.int64()) for c in out)], [key, *_COLUMNS])
                keys.clear()
                for c in out:
                    c.clear()

        def pack_rest() -> None:
            nonlocal next_id
            if not rest:
                return
            lengths = np.array([len(r[2]) for r in rest], np.int64)
            for d, start, n, s, offset in pack_group(lengths, sequence):
                k, at, ids, total = rest[d]
                emit(k, at + start, n, zlib.crc32(ids[start : start + n]), total, next_id + s, offset)
            next_id += len(capacities(int(lengths.sum()), sequence))
            rest.clear()

        for batch in batches:
            kind = batch.schema.field(0).type
            ids_of = batch.column(0).to_pylist()
            for at, run_texts in sub_batches(batch.column(1).to_pylist()):
                for k, raw in zip(ids_of[at:], enc.encode(run_texts), strict=False):
                    ids = np.frombuffer(raw + end, enc.dtype).astype("<u4")
                    full = len(ids) - len(ids) % sequence
                    for s in range(0, full, sequence):
                        emit(k, s, sequence, zlib.crc32(ids[s : s + sequence]), len(ids), next_id, 0)
                        next_id += 1
                    if full < len(ids):
                        rest.append((k, full, ids[full:].copy(), len(ids)))
                        if len(rest) == group:
                            pack_rest()
                yield from flush()
        pack_rest()
        enc.forget()
        if keys:
            yield from flush()

    schema = f"`{key}` {key_type}, " + ", ".join(f"`{c}` bigint" for c in _COLUMNS)
    return rows.mapInArrow(run, schema)
