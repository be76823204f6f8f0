"""Near-duplicates by exact Jaccard similarity against brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from winnowkit.llm import jaccard, simhash


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute(rows):
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(k, low.get(find(i), k))
    return [(k, low.get(find(i))) for i, (k, _) in enumerate(rows)]


def texts(rnd):
    words = [f"W{i}" for i in range(400)]
    out = [None, "", " \t", "A", "a", "a b c d", "A b\tc d", "a b c d e", "a b c d e f", "é x y z w q r"]
    line = " ".join(rnd.choice(words) for _ in range(60))  # a passage of many texts, in some of them nearly all
    for _ in range(40):
        out.append(line + " " + " ".join(rnd.choice(words) for _ in range(rnd.choice((2, 10, 16, 60)))))
    for n in (12, 40, 200):
        for _ in range(12):
            base = [rnd.choice(words) for _ in range(n)]
            for _ in range(5):
                copy = list(base)
                for _ in range(rnd.randint(0, max(1, n // 25))):
                    copy[rnd.randrange(n)] = rnd.choice(words)
                out.append(" ".join(copy))
    return out


def test_components_are_those_of_all_pairs(spark, monkeypatch):
    made = texts(random.Random(4))
    rows = [(1000 - i, t) for i, t in enumerate(made)] + [(5000, made[-1]), (5000, made[-1]), (None, made[-1]), (None, "alone in null")]
    d = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id bigint, text string, digest string, n int")
    want = sorted(brute(rows), key=str)
    assert len({c for _, c in want}) > 60
    for common in (10, 3, 10_000):  # what counts as common moves work only
        monkeypatch.setattr(jaccard, "COMMON", common)
        assert sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(d).collect()), key=str) == want
    assert jaccard.near_duplicates(d.limit(0)).collect() == []


def test_stage_takes_out_copies_that_fingerprints_miss(spark, tmp_path):
    rnd = random.Random(5)
    rows = []
    for i in range(30):
        base = [f"w{rnd.randrange(3000)}" for _ in range(80)]
        copy = [*base[:40], "changed", *base[41:]]
        rows += [(i, " ".join(base)), (100 + i, " ".join(copy))]
    far = [bin(simhash.fingerprint(a[1]) ^ simhash.fingerprint(b[1])).count("1") for a, b in zip(rows[::2], rows[1::2], strict=True)]
    assert sum(n > simhash.THRESHOLD for n in far) > 10
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, d, str(tmp_path)).collect()} == set(range(30))


def test_bitmaps_never_differ_in_more_places_than_the_sets_have_terms_alone(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 700))).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(rng.integers(0, len(a) + 1))], rng.integers(0, 1 << 63, int(rng.integers(1, 900))).astype(np.uint64)]))
        rows.append((jaccard.parity(a).view(np.int64).tolist(), jaccard.parity(b).view(np.int64).tolist(), len(np.setxor1d(a, b))))
    assert {len(r[0]) * 64 for r in rows} >= {64, 256, 1024}
    d = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>, n int")
    found = d.select(jaccard._differing(F.col("a"), F.col("b")).alias("d"), "n").collect()
    assert all(0 < r.d <= r.n for r in found if r.n) and sum(r.d > 0.3 * r.n for r in found) > 100


def test_odd_tables(spark):
    """Clashing column names, very long texts, null and repeated keys, and an empty table."""
    long = "a b c d e f g h i j " * 20_000
    rows = [(1, long, "x", "k"), (2, long + "tail", "x", "k"), (None, "same words here once more", "x", "k"), (None, "same words here once more", "x", "k"), (4, None, "x", "k"), (5, "", "x", "k"), (6, "one", "x", "k")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, digest string, k string")
    kept = jaccard.keep_representatives(d)
    assert kept.columns == d.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 4, 6]
    assert jaccard.keep_representatives(d.limit(0)).collect() == []
