"""Byte-pair encoding and decoding in numpy.

All words that are still to be encoded lie as symbols in one flat array. A round looks up every
pair of neighbours by binary search over the sorted pair keys, takes the lowest rank of each
word, merges all its places (left to right where they overlap), and sets finished words aside.
Words come from the tokenizer's pattern; ids of frequent words, and for texts that aren't plain
Latin of the pieces between spaces, are kept in bounded tables that only save time. A word of over ``LONG`` bytes goes
through a priority queue instead, for the rounds of one such word would each scan all of it.

Defined results: a null text is empty, with no ids and an empty decoding. Rows are independent,
so ties, repeated rows and null keys give a row each. No rows give no rows. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .store import on_workers
from .tokens import LONGEST_KEPT, PIECES_KEPT, Plain, byte_alphabet, byte_words, split_pieces, sub_batches, tokenizer_path

#: The split pattern of byte-level vocabularies. White space and letters as Unicode has them.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

LONG = 4096
WORDS_KEPT = 800_000
NEVER = np.int32(2**31 - 1)


class NumpyBPE:
    """A byte-level vocabulary from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.first_ids = np.array([vocab[alphabet[b]] for b in range(256)], np.int64)
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys, rank = np.unique(left * self.size + right, return_index=True)
        self.keys, self.rank = keys, rank.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[rank]
        back = {c: b for b, c in alphabet.items()}
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.name_of = [str(i) for i in range(self.size)]
        self.split = regex.compile(PATTERN)
        self.plain = Plain("".join(t[0] for t in self.special))
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (NEVER if it has none) and its place among the keys."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NEVER), at

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by rounds over all of them at once."""
        lengths = np.array([len(w) for w in words], np.int64)
        sym = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            rank = np.full(len(sym), NEVER, np.int32)  # of the pair that begins here
            inside = np.flatnonzero(word[:-1] == word[1:])
            rank[inside], at = self.look_up(sym[inside], sym[inside + 1])
            place = np.zeros(len(sym), np.int64)
            place[inside] = at
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(sym)))
            lowest = np.minimum.reduceat(rank, starts)
            lowest_here = np.repeat(lowest, sizes)
            ended = lowest_here == NEVER
            if ended.any():
                done.append((word[ended], sym[ended]))
            hits = np.flatnonzero((rank == lowest_here) & ~ended)
            if len(hits):
                # Hits side by side overlap (a a a): each second one of such a run falls away.
                run_start = np.append(True, hits[1:] != hits[:-1] + 1)
                nth = np.arange(len(hits)) - np.maximum.accumulate(np.where(run_start, np.arange(len(hits)), 0))
                hits = hits[nth % 2 == 0]
                sym[hits] = self.merged[place[hits]]
            stays = ~ended
            stays[hits + 1] = False
            sym, word = sym[stays], word[stays]
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        owner = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        ids = ids[np.argsort(owner, kind="stable")].astype(self.dtype)
        return np.split(ids, np.cumsum(np.bincount(owner, minlength=len(words)))[:-1]) if words else []

    def merge_long(self, word: bytes) -> np.ndarray:
        """The same for one very long word, by a priority queue."""
        sym = self.first_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        first, at = self.look_up(np.array(sym[:-1]), np.array(sym[1:]))
        heap = [(int(first[i]), i, sym[i], sym[i + 1], int(at[i])) for i in np.flatnonzero(first != NEVER).tolist()]
        heapq.heapify(heap)

        def push(i: int, j: int) -> None:
            key = sym[i] * self.size + sym[j]
            p = int(np.searchsorted(self.keys, key))
            if p < len(self.keys) and self.keys[p] == key:
                heapq.heappush(heap, (int(self.rank[p]), i, sym[i], sym[j], p))

        while heap:
            _, i, a, b, p = heapq.heappop(heap)
            j = after[i] if sym[i] == a else len(sym)
            if j >= len(sym) or sym[j] != b:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[j] = int(self.merged[p]), -1
            after[i] = after[j]
            if after[i] < len(sym):
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([s for s in sym if s >= 0], self.dtype)

    def _fill(self, need: set[str]) -> dict[str, bytes]:
        """Put the ids of pieces in the table; those of very long pieces are returned."""
        if len(self.pieces) + len(need) > PIECES_KEPT:
            self.pieces.clear()
        split = {p: self.split.findall(p) for p in need if p not in self.pieces}
        ids = self._new_words({w for ws in split.values() for w in ws})
        long = {}
        for p, ws in split.items():
            found = b"".join([ids[w] if w in ids else self.words[w] for w in ws])
            (long if len(p) > LONGEST_KEPT else self.pieces)[p] = found
        self.words.update((w, v) for w, v in ids.items() if len(w) <= LONGEST_KEPT)
        return long

    def _new_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of those of the words that aren't in the table, merged all at once. A table that would grow too large is emptied first."""
        new = words.difference(self.words)
        if len(self.words) + len(new) > WORDS_KEPT:
            self.words.clear()
            new = words
        coded = [(w, w.encode()) for w in new]
        short = [x for x in coded if len(x[1]) <= LONG]
        ids = dict(zip((w for w, _ in short), (a.tobytes() for a in self.merge_words([b for _, b in short])), strict=True))
        return ids | {w: self.merge_long(b).tobytes() for w, b in coded if len(b) > LONG}

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Plain texts are split into words at once, the others by pieces and special tokens."""
        plain = [self.plain(t) for t in texts]
        split = [byte_words(t) for t, p in zip(texts, plain, strict=True) if p]
        need: set[str] = set()
        for ws in split:
            need.update(ws)
        ids = self._new_words(need)
        long = {w: v for w, v in ids.items() if len(w) > LONGEST_KEPT}
        self.words.update(ids if not long else {w: v for w, v in ids.items() if w not in long})
        get = (lambda w: long[w] if w in long else self.words[w]) if long else self.words.__getitem__
        found = iter([np.frombuffer(b"".join(map(get, ws)), self.dtype) for ws in split])
        others = iter(self._encode_others([t for t, p in zip(texts, plain, strict=True) if not p]))
        return [next(found) if p else next(others) for p in plain]

    def _encode_others(self, texts: list[str]) -> list[np.ndarray]:
        parts: list[list[str]] = []  # texts between special tokens, as pieces with their space
        plan: list[list[int]] = []  # for each text: >= 0 a part, < 0 the special token -1 - id
        for t in texts:
            own = []
            for s in self.at_special.split(t) if self.at_special and any(x in t for x in self.special) else (t,):
                if s in self.special:
                    own.append(-1 - self.special[s])
                elif s:
                    own.append(len(parts))
                    pieces = split_pieces(s)
                    parts.append([pieces[0], *[" " + p for p in islice(pieces, 1, None)]])
            plan.append(own)
        need: set[str] = set()
        for p in parts:
            need.update(p)
        long = self._fill(need)
        get = (lambda p: long[p] if p in long else self.pieces[p]) if long else self.pieces.__getitem__
        one = lambda x: b"".join(map(get, parts[x])) if x >= 0 else np.array([-1 - x], self.dtype).tobytes()
        return [np.frombuffer(b"".join(map(one, own)), self.dtype) for own in plan]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


_CODERS: dict[str, NumpyBPE] = {}


def coder(path: str) -> NumpyBPE:
    if path not in _CODERS:
        _CODERS[path] = NumpyBPE(path)
    return _CODERS[path]


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): the ids of each text and the text they decode to."""
    on_workers(docs.sparkSession)
    rows = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path or tokenizer_path("byte_bpe_50k.json"))
        for batch in batches:
            for at, texts in sub_batches(batch.column(1).to_pylist()):
                ids = bpe.encode_batch(texts)
                flat = pa.array(np.concatenate([i.astype(np.int32) for i in ids]))
                offsets = pa.array(np.cumsum([0, *map(len, ids)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.ListArray.from_arrays(offsets, flat), pa.array([bpe.decode(i) for i in ids], pa.string())],
                    [key, "ids", "decoded"],
                )

    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256), made in the workers so that no ids travel."""
    on_workers(docs.sparkSession)
    rows = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path or tokenizer_path("byte_bpe_50k.json"))
        name = bpe.name_of.__getitem__
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            for _, texts in sub_batches(batch.column(1).to_pylist()):
                for ids in bpe.encode_batch(texts):
                    n.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(name, ids.tolist())).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return rows.mapInArrow(run, f"`{key}` {rows.schema[0].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
