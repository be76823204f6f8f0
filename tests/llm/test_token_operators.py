"""BPE, token files and packing against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from winnowkit.llm import bpe, packing, tokenbin, tokens
from winnowkit.llm.tokens import tokenizer_path

ODD = [
    None, "", " ", "  ", "a  b", " a", "a ", "\n", "a\n b", "a \n b", "don't  I'll 's S'S", "<|endoftext|>", "x<|endoftext|> y", "x <|endoftext|>  y<|startoftext|>z",
    "　x　 y", "日本語 テスト ١٢٣ ½ ª", "😀😀 😀a", "a" * 300, "aaa aaaa aaaaa", "\x1c a\x85b \x85c", "İstanbul ß ẞ ΣΑΣ", "x" * 9000 + "y", "word " * 30_000,
]
RND = random.Random(1)
ODD += ["".join(RND.choice(" \n\t'aébsStlrevmd1½日!?_.́<|") for _ in range(RND.randint(1, 60))) for _ in range(300)]


def library(name):
    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def ids_of(name, texts=None):
    return [e.ids for e in library(name).encode_batch([t or "" for t in (texts or ODD)], add_special_tokens=False)]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, "x", 0) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, start string, ids int").repartition(3)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_library_encoder(name):
    enc = tokens.LibraryEncoder(tokenizer_path(name))
    for _ in range(2):  # from an empty and from a filled table
        assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(ODD)] == ids_of(name)


def test_long_texts_are_taken_in_parts(monkeypatch):
    monkeypatch.setattr(tokens, "SUB_BATCH_CHARS", 40)
    monkeypatch.setattr(tokens, "WORDS_KEPT", 30)  # the table is emptied in the middle of texts
    plain = ["Ab cd's  ef\n gh 12 x" * 60, "a" * 500, " " * 300 + "b", "tab\t \n new  lines\r\n " * 40, "Ölm über ñandú " * 50]
    for t in plain:
        assert "".join(tokens.segments(t)) == t
    assert len(list(tokens.segments(plain[0]))) > 10
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc = tokens.LibraryEncoder(tokenizer_path(name))
        assert [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(plain + ODD)] == ids_of(name, plain + ODD)


def test_numpy_rounds_and_queue():
    coder = bpe.NumpyBPE(tokenizer_path("byte_bpe_50k.json"))
    texts = [t or "" for t in ODD]
    got = coder.encode_batch(texts)
    assert [g.tolist() for g in got] == ids_of("byte_bpe_50k.json")
    assert [coder.decode(g) for g in got] == texts
    for word in (b"aaaaaaaaa", "ééèéêabcabc".encode(), bytes(RND.choice(b"abcde") for _ in range(700))):
        assert coder.merge_long(word).tolist() == coder.merge_words([word])[0].tolist()


def test_decoding_is_that_of_the_library():
    """Ids in any order too: bytes that make no character, cut characters, special tokens side by side."""
    name = "byte_bpe_50k.json"
    coder, tok = bpe.NumpyBPE(tokenizer_path(name)), library(name)
    ids = ids_of(name, ["日本語 😀 é ñ ٣", "plain words", "<|endoftext|>x"])
    cases = [x[i:j] for x in ids for i in range(len(x)) for j in range(i, len(x) + 1)]
    cases += [[RND.randrange(coder.size) for _ in range(RND.randint(1, 12))] for _ in range(300)]
    single = [i for i in range(coder.size) if len(coder.bytes_of[i]) == 1 and coder.bytes_of[i][0] >= 128]
    cases += [[RND.choice(single) for _ in range(RND.randint(1, 8))] for _ in range(500)]
    for case in cases:
        assert coder.decode(np.array(case, np.int64)) == tok.decode(case, skip_special_tokens=False), case


def test_bpe_query_shape(table):
    want = dict(enumerate(ids_of("byte_bpe_50k.json")))
    got = bpe.round_trip_digests(table).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r.n_tokens == len(want[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((ODD[r.doc_id] or "").encode()).hexdigest()
    full = {r.doc_id: r for r in bpe.encode(table).collect()}
    assert all(full[i].ids == want[i] and full[i].decoded == (ODD[i] or "") for i in want)
    assert bpe.encode(table.limit(0)).collect() == [] == bpe.round_trip_digests(table.limit(0)).collect()


def test_bpe_with_null_and_repeated_keys(spark):
    rows = [(None, "one two", 1), (None, "one two", 1), (7, "one two", 1), (7, "three", 1), (7, None, 1)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int").repartition(2)
    ids = dict(zip(("one two", "three", ""), ids_of("byte_bpe_50k.json", ["one two", "three", ""]), strict=True))
    want = sorted((str(k), len(ids[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for k, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.decoded_sha256) for r in bpe.round_trip_digests(d).collect()) == want


def test_packing(spark, table):
    want = {i: x + [0] for i, x in enumerate(ids_of("byte_bpe_50k.json"))}
    rows = packing.pack(table).collect()
    pieces, sequences = {}, {}
    for r in rows:
        ids = np.array(want[r.doc_id], "<u4")
        assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start : r.start + r.length]) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in want.items():
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at and length > 0
            at += length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0  # full, or a power of two
    assert packing.pack(table.limit(0)).collect() == []
    twice = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id bigint, text string")
    assert len(packing.pack(twice).collect()) == 2


def test_packing_balances_cost():
    """Costs spread less than by packing tightly (descending best fit), with the same sequences and cuts."""
    lengths = np.random.default_rng(0).integers(1, 700, 4000)
    full = int(lengths.sum()) // 1024
    cost = np.zeros(full + 10)
    for _, _, n, s, _ in packing.pack_group(lengths):
        cost[s] += n + n * n / 256
    room, tight = packing.capacities(int(lengths.sum())), np.zeros(full + 10)
    for n in np.sort(lengths)[::-1].tolist():
        while n:
            fits = np.flatnonzero(room >= n)
            fits = fits if len(fits) else np.flatnonzero(room)
            s = fits[np.argmin(room[fits])]
            m = min(n, int(room[s]))
            room[s] -= m
            tight[s] += m + m * m / 256
            n -= m
    assert cost[:full].std() < tight[:full].std() and cost[:full].max() <= tight[:full].max()


def test_addressable_codes(tmp_path):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    docs = [rng.integers(0, hi, n).astype(np.uint32) for hi, n in ((200, 5000), (256, 1), (50_000, 40_000), (1 << 31, 3000), (1, 0), (300, 1_200_000))]
    path = tmp_path / "s.dac"
    with open(path, "wb") as out:
        writer = tokenbin._ShardWriter(out)
        for i, d in enumerate(docs):
            writer.add(None if i == 1 else i, d)
        writer.close()
    flat = np.concatenate(docs)
    with pa.OSFile(str(path)) as f:
        shard = tokenbin.ShardReader(f)
        assert shard.n_tokens == len(flat) and shard.null.tolist() == [i == 1 for i in range(6)]
        for i in [0, 5, 5000, 5001, 45_000, len(flat) - 1, *rng.integers(0, len(flat), 500).tolist()]:
            assert shard.token(i) == flat[i]
        for _ in range(50):
            a, b = sorted(rng.integers(0, len(flat), 2).tolist())
            assert (shard.tokens(a, b - a) == flat[a:b]).all()


def test_token_files(spark, table):
    want = {i: x + [1] for i, x in enumerate(ids_of("word_bpe_49k.json"))}
    got = {r.doc_id: r for r in tokenbin.write_and_read(table).collect()}
    at = 0
    for i in sorted(want):
        ids = np.array(want[i], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    assert tokenbin.write_and_read(table.limit(0)).collect() == []
    odd = spark.createDataFrame([(5, "b"), (None, None), (5, "b")], "doc_id bigint, text string")
    rows = sorted((r.start, r.doc_id) for r in tokenbin.write_and_read(odd).collect())
    assert [r[1] for r in rows] == [None, 5, 5]


def test_each_shard_is_read_by_a_task_of_its_own(spark, table, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is too small for several shards
    shards = tokenbin.write_tokens(table.repartition(3), folder)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = tokenbin.read_documents(tokenbin.open_shards(spark, folder), folder)
    tasks = read.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert shards.count() > 1 and len(tasks) == read.rdd.getNumPartitions() == shards.count()
