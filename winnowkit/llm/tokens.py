"""Encoding many texts with the tokenizers library, without encoding any word twice in a row.

A text of plain Latin characters is split by the same pattern as in the tokenizer's file, and its
words go to the library's model. Words repeat, so their ids are kept in a bounded table. Any
other text falls apart, without changing its ids, before every space that follows something other
than white space; pieces that are plain are treated in the same way, the others go through the
library's whole encoder, and the ids of pieces are kept too. The tables only save time: they are
emptied when full, and what is encoded never depends on them.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np

#: Plain characters: tab, line ends, printable ASCII, and Latin letters that are their own NFC form.
_LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0132-\u0148\u014a-\u017e"
_PLAIN = rf"[\t\n\r -~{_LETTERS}]"
#: White space of any kind before a space: the text doesn't fall apart there.
_SPACES = r"\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f-\u2064\u3000\ufeff"
_WIDE = re.compile(rf"[{_SPACES}] ")
_ENDS_WIDE = re.compile(rf"[{_SPACES}]\Z")
_APART = re.compile(rf"(?<=[^ {_SPACES}])(?= )")

#: The two split patterns as the tokenizers' files have them, and the same for plain characters.
_CLITICS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORD_FILE_PATTERN = _CLITICS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTE_RULE = re.compile(rf"{_CLITICS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_WORD_RULE = re.compile(rf"{_CLITICS}|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")

SUB_BATCH_CHARS = 2_000_000
PIECES_KEPT = 400_000
WORDS_KEPT = 400_000
LONGEST_KEPT = 64


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself; the other bytes, in order, take the characters from 256 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def split_pieces(text: str) -> list[str]:
    """Pieces of the text; all but the first have lost the space before them."""
    pieces = text.split(" ")
    if not _WIDE.search(text):
        return pieces
    out = [pieces[0]]
    for p in pieces[1:]:
        # An empty piece stands between two spaces (or at the start): the run of spaces stays whole.
        if out[-1] == "" or _ENDS_WIDE.search(out[-1]):
            out[-1] += " " + p
        else:
            out.append(p)
    return out


def sub_batches(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) in runs of bounded size; null is empty."""
    at, run, chars = 0, [], 0
    for i, t in enumerate(texts):
        run.append(t or "")
        chars += len(run[-1])
        if chars >= SUB_BATCH_CHARS:
            yield at, run
            at, run, chars = i + 1, [], 0
    if run:
        yield at, run


def segments(text: str) -> Iterator[str]:
    """A text in parts of about SUB_BATCH_CHARS, cut before a space that follows something other than white space."""
    at = 0
    while len(text) - at > SUB_BATCH_CHARS:
        cut = _APART.search(text, at + SUB_BATCH_CHARS)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Plain:
    """Tells texts of plain characters only, none of which is in ``firsts``, the first characters of special tokens."""

    def __init__(self, firsts: str):
        self.pattern = re.compile(rf"(?:(?![{re.escape(firsts)}]){_PLAIN})*" if firsts else f"(?:{_PLAIN})*")
        self.ascii = bytes(b for b in (9, 10, 13, *range(32, 127)) if chr(b) not in firsts)

    def __call__(self, text: str) -> bool:
        rest = text.encode("utf-8", "surrogatepass").translate(None, self.ascii)  # what isn't plain ASCII
        return not rest or self.pattern.fullmatch(rest.decode("utf-8", "surrogatepass")) is not None


def byte_words(text: str) -> list[str]:
    """The words of a plain text as byte-level vocabularies split it."""
    return _BYTE_RULE.findall(text)


class _Words(dict):
    """word -> ids as bytes, made when they are asked for; emptied when full, and long words aren't kept."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = ids
        return ids


class LibraryEncoder:
    """Ids of the tokenizers library for a tokenizer file, as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # A piece with the first character of a special token is left to the library.
        self.plain = Plain("".join(t["content"][0] for t in spec["added_tokens"]))
        pre = spec["pre_tokenizer"] or {}
        inner = pre.get("pretokenizers") or [{}]
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not spec["normalizer"]:
            self.rule, self.lower = _BYTE_RULE, False
        elif inner[0].get("pattern", {}).get("Regex") == _WORD_FILE_PATTERN:
            self.rule, self.lower = _WORD_RULE, True
        else:
            self.rule = None
        self.alphabet = {b: c for b, c in byte_alphabet().items() if chr(b) != c}
        self.space = self.alphabet[32]
        self.model = self.tok.model
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.words = _Words(self._word)

    def forget(self) -> None:
        """Empty the tables: a worker outlives its task, and what it does next needs the memory."""
        for table in (self.words, self.first, self.later):
            table.clear()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for _, run in sub_batches(texts):
            out += self._encode_run(run)
        return out

    def is_plain(self, text: str) -> bool:
        """Whether there are plain characters only, none of which begins a special token."""
        return self.rule is not None and self.plain(text)

    def _encode_run(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = []
        get, other = self.words.__getitem__, []
        for i, text in enumerate(texts):
            if self.is_plain(text):
                parts = segments(text) if len(text) > SUB_BATCH_CHARS else (text,)
                out.append(b"".join([b"".join(map(get, self.rule.findall(p.lower() if self.lower else p))) for p in parts]))
            else:
                out.append(None)
                other.append(i)
        for i, ids in zip(other, self._encode_pieces([texts[i] for i in other]), strict=True):
            out[i] = ids
        return out

    def _encode_pieces(self, texts: list[str]) -> list[bytes]:
        split = [split_pieces(t) for t in texts]
        need: set[str] = set()
        for pieces in split:
            need.update(islice(pieces, 1, None))
        long = self._fill(self.later, need, " ")
        first_long = self._fill(self.first, {p[0] for p in split}, "")
        if long or first_long:
            get = lambda p: long.get(p) if p in long else self.later[p]
        else:
            get = self.later.__getitem__
        out = []
        for pieces in split:
            head = first_long[pieces[0]] if pieces[0] in first_long else self.first[pieces[0]]
            out.append(head + b"".join(map(get, islice(pieces, 1, None))))
        return out

    def _fill(self, table: dict[str, bytes], need: set[str], before: str) -> dict[str, bytes]:
        """Put the ids of the pieces in the table; those of the very long pieces are returned instead."""
        if len(table) + len(need) > PIECES_KEPT:
            table.clear()
        long: dict[str, bytes] = {}
        hard = []
        for p in need.difference(table):
            if self.is_plain(p):
                s = (before + p).lower() if self.lower else before + p
                (long if len(p) > LONGEST_KEPT else table)[p] = b"".join(map(self.words.__getitem__, self.rule.findall(s)))
            else:
                hard.append(p)
        for i in range(0, len(hard), 256):
            part = hard[i : i + 256]
            for p, e in zip(part, self.tok.encode_batch_fast([before + p for p in part], add_special_tokens=False), strict=True):
                (long if len(p) > LONGEST_KEPT else table)[p] = np.array(e.ids, self.dtype).tobytes()
        return long

    def _word(self, w: str) -> bytes:
        if not w.isascii():
            mapped = w.encode().decode("latin-1").translate(self.alphabet)
        elif w.isalnum():
            mapped = w
        elif w[0] == " " and w[1:].isalnum():
            mapped = self.space + w[1:]
        else:
            mapped = w.translate(self.alphabet)
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    """One encoder a Python worker and file: workers are reused, so the file is read once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
