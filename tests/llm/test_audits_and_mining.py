"""Decontamination, hard negatives and the filter audit against plain models."""

import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowkit.llm import interactions, negatives, suffixes


def item_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def windows(items, size):
    for name, text in items:
        words = item_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            yield "" if name is None else str(name), tuple(words[i : i + n])


def brute_audit(docs, items, size=10):
    out = []
    for key, text in docs:
        words, hit, names = item_words(text), set(), set()
        for name, w in windows(items, size):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    names.add(name)
        spans = []
        for i in sorted(hit):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append((key, len(words), len(hit), sorted(names), [tuple(s) for s in spans]))
    return out


def rnd_texts():
    rnd = random.Random(7)
    vocab = ["Alpha", "beta", "été", "x1", "the", "of", "一二", "Z"]
    prose = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(2, prose(30)), (10, prose(14)), (10, prose(12)), (3, prose(4)), (4, "solo"), (None, prose(11)), (5, None), (6, " ,;! "), (7, "a " * 40), (2, "again " * 11)]
    items += [items[0], (8, items[0][1])]
    passages = [item_words(t) for _, t in items if t]
    docs = [None, "", " ", "solo", "SOLO!", "x solo-y", "nothing known here at all", "a " * 9, "A." * 10, "b " + "a " * 300]
    for _ in range(60):
        words = item_words(prose(rnd.randint(0, 60)))
        for _ in range(rnd.randint(0, 2)):
            p = rnd.choice([x for x in passages if x])
            i = rnd.randrange(len(p))
            at = rnd.randint(0, len(words))
            words[at:at] = p[i : i + rnd.randint(1, 30)]
        docs.append(rnd.choice([" ", ", ", "\n"]).join(words))
    docs += [docs[-1], docs[-1]]
    return [(k if k != 5 else None, t) for k, t in enumerate(docs)], items


def audited(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in df.collect()), key=str)


@pytest.mark.parametrize(("shard_words", "block_bytes"), [(1 << 21, 4 << 20), (70, 4 << 20), (200, 100)])
def test_hits_are_those_of_all_windows(spark, shard_words, block_bytes):
    docs, items = rnd_texts()
    d = spark.createDataFrame([(*x, "s", 1) for x in docs], "doc_id bigint, text string, items string, block int").repartition(3)
    b = spark.createDataFrame([(*x, "t") for x in items], "item_id bigint, text string, item string")
    got = audited(suffixes.audit(d, b, shard_words=shard_words, block_bytes=block_bytes))
    want = sorted(brute_audit(docs, items), key=str)
    assert got == want
    assert sum(x[2] > 0 for x in want) > 20 and any(len(x[3]) > 2 for x in want) and any(len(x[4]) > 1 for x in want)


def test_longest_matches(spark):
    docs, items = rnd_texts()
    want = {}
    for name, text in items:
        words = item_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            best = 0
            for _, t in docs:
                d = item_words(t)
                for j in range(len(d)):
                    m = 0
                    while i + m < len(words) and j + m < len(d) and words[i + m] == d[j + m]:
                        m += 1
                    best = max(best, m)
            if best >= n:
                at = ("" if name is None else str(name), i)
                want[at] = max(best, want.get(at, 0))
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = suffixes.longest_matches(d, spark.createDataFrame(items, "item_id bigint, text string"), shard_words=100).collect()
    assert {(r["item"], r.item_start): r.length for r in found} == want and len(want) > 30
    texts = {}
    for k, t in docs:
        texts.setdefault(k, []).append(item_words(t))
    by_item = {}
    for name, t in items:
        by_item.setdefault("" if name is None else str(name), []).append(item_words(t))
    for r in found:  # the place that is reported holds the match
        here = [w[r.doc_start : r.doc_start + r.length] for w in texts[r.doc_id]]
        assert any(w[r.item_start : r.item_start + r.length] in here for w in by_item[r["item"]])


def test_suffix_ranks_of_hard_texts():
    rng = np.random.default_rng(3)
    for ids in ([-1], [0] * 50 + [-1], [0, 1] * 20 + [-1, -1] + [0, 1] * 9 + [-1], [*rng.integers(-1, 3, 300).tolist(), -1]):
        ids = np.array(ids)
        left, levels = suffixes.suffix_ranks(ids, 64)
        tails = [tuple(ids[i : i + left[i]]) for i in range(len(ids))]
        assert all(min(x, default=0) >= 0 for x in tails)
        for k, rank in enumerate(levels):
            want = [t[: 1 << k] for t in tails]
            order = sorted(range(len(ids)), key=lambda i: want[i])
            for a, b in zip(order, order[1:], strict=False):
                assert (rank[a] == rank[b]) == (want[a] == want[b]) and rank[a] <= rank[b]
        pairs = rng.integers(0, len(ids), (200, 2))
        got = suffixes.common_words(left, levels, pairs[:, 0], pairs[:, 1])
        for (a, b), n in zip(pairs, got, strict=True):
            m = next((i for i, (x, y) in enumerate(zip(tails[a], tails[b], strict=False)) if x != y), min(len(tails[a]), len(tails[b])))
            assert n == m


def test_affected_documents_go(spark):
    docs, items = rnd_texts()
    d = spark.createDataFrame([(t, "x") for _, t in docs], "text string, digest string")
    left = suffixes.decontaminate(d, spark.createDataFrame(items, "item_id bigint, text string"))
    assert left.columns == ["text", "digest"]
    want = [t for (_, t), x in zip(docs, brute_audit(docs, items), strict=True) if not x[2]]
    assert sorted(map(str, (r.text for r in left.collect()))) == sorted(map(str, want))


def test_no_items_and_no_documents(spark):
    docs, items = rnd_texts()
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert audited(suffixes.audit(d, b.limit(0))) == sorted(brute_audit(docs, []), key=str)
    assert audited(suffixes.audit(d, spark.createDataFrame([(1, None), (2, "--")], b.schema))) == sorted(brute_audit(docs, []), key=str)
    assert suffixes.audit(d.limit(0), b).collect() == []
    assert suffixes.longest_matches(d.limit(0), b).collect() == []


def brute_negatives(rows, anchors=50):
    own = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a, (a_id, av, al) in enumerate(own):
        if a_id % anchors:
            continue
        score = [sum(x * y for x, y in zip(av, v, strict=False)) for _, v, _ in own]
        order = sorted(range(len(own)), key=lambda i: (-score[i], own[i][0]))
        for p in [i for i in order if own[i][2] == al and i != a][:5]:
            fits = [i for i in order if own[i][2] != al and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a_id, own[p][0], n, own[i][0], score[p], score[i]) for n, i in enumerate(fits[:3], 1)]
    return sorted(out)


def vectors(rnd, n, dims):
    rows = [(i, [rnd.uniform(-0.5, 0.5) + (0.2 if d == i % 3 else 0) for d in range(dims)], i % 3) for i in range(n)]
    rows += [rows[0], rows[0], rows[50], (7_000, rows[3][1], 1), (7_001, rows[3][1], 2), (-50, rows[9][1], 0)]  # repeated rows, equal vectors
    rows += [(None, rows[1][1], 1), (100_000, None, 1), (100_050, rows[1][1], None), (3, [None] * dims, 0), (4, [math.nan] * dims, 0), (5, [math.inf, *[0.0] * (dims - 1)], 0)]
    return rows + [(8_000, [], 0), (8_001, [0.5], 1), (8_050, rows[2][1] + [9.0], 2)]


NEG = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("sizes", [(1024, 256, 32, 4), (64, 2, 3, 2), (7, 1, 10, 1)])
def test_negatives_are_those_of_all_pairs(spark, sizes):
    rows = vectors(random.Random(5), 330, 10)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], NEG + ", id int, row string").repartition(3)
    got = negatives.hard_negatives(df, F.col("id") % 50 == 0, sizes=sizes).collect()
    want = brute_negatives(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 40


def test_no_scores_are_stored_or_shuffled(spark, monkeypatch):
    """What is written grows with the panels and the best rows, not with anchors times rows."""
    made, write = {}, negatives.settle
    monkeypatch.setattr(negatives, "settle", lambda df, name, *a: made.setdefault(name, write(df, name, *a)))
    df = spark.createDataFrame(vectors(random.Random(8), 400, 6), NEG)
    got = negatives.hard_negatives(df, F.col("id") % 50 == 0, sizes=(64, 2, 3, 2))
    assert "binary" not in {t for d in made.values() for _, t in d.dtypes} and "BinaryType" not in got._jdf.queryExecution().analyzed().treeString()
    assert got._jdf.queryExecution().executedPlan().toString().count("tile") == 0 and got.count() > 40


def test_large_components_are_added_as_64_bits(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.randint(-9, 9) * 2.0**k for _ in range(4)], i % 2) for k in (0, 8, 18) for i in range(101)]
    for k in (8, 18):  # more than 4 bytes a score; more than a double holds
        mine = [r for r in rows if max(map(abs, r[1])) <= 9 * 2.0**k]
        got = negatives.hard_negatives(spark.createDataFrame(mine, NEG), F.col("id") % 50 == 0, sizes=(16, 2, 3, 2)).collect()
        assert sorted(map(tuple, got)) == brute_negatives(mine)
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(50, [3e38, 1.0], 1)], NEG), F.col("id") % 50 == 0)


def test_no_vectors_and_no_anchors(spark):
    for rows in ([], [(1, [0.5], 1), (2, [0.25], 1)], [(None, None, None)], [(50, [], 1)]):
        got = negatives.hard_negatives(spark.createDataFrame(rows, NEG), F.col("id") % 50 == 0)
        assert got.collect() == [] and got.columns[0] == "anchor_id"


def brute_filters(docs, labels):
    out = {}
    good, toxic = {k for k, q, _ in labels if q == 1}, {k for k, _, t in labels if t == 1}
    for key, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": any(k is not None and key is not None and k < key and (x or "") == t for k, x, _ in docs),
        }
        for order in permutations("ABCDE"):
            first = next((i for i, c in enumerate(order) if fails[c]), 9)
            for i, c in enumerate(order):
                row = out.setdefault((part or "", "".join(order), i + 1), [0] * 7)
                row[0] += first > i
                row[1] += first == i
                row[2] += fails[c] and first < i
                row[3] += fails[c] and sum(fails.values()) == 1
                row[4] += first == i and key is not None and key in good
                row[5] += first == i and key is not None and key in toxic
    for (part, order, step), row in out.items():
        row[6] = sum(r[1] for (p, o, s), r in out.items() if p == part and o[s - 1] == order[step - 1])
    return sorted((*k, *v) for k, v in out.items())


def filter_docs():
    rnd = random.Random(8)
    docs = [(1, None, "a"), (2, "", "a"), (3, "", None), (4, " \t\n", ""), (None, "same", "a"), (5, "same", "a"), (5, "same", "b"), (6, "same", "b"), (6, "Same", "b"), (7, "É|é" * 3, "a")]
    words = [f"w{i}" for i in range(300)] + ["W", "Q&A", "x#"]
    for i in range(10, 50):
        pool = rnd.sample(words, rnd.choice([20, 303]))
        docs.append((i, rnd.choice([" ", "\t", "\x0b\n"]).join(rnd.choice(pool) for _ in range(rnd.choice([50, 199, 200, 400]))), rnd.choice("ab")))
    docs += [(90 - i, d[1], "b") for i, d in enumerate(docs[10:20])] + [docs[12], (200, "word " * 100_000, "long")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 60, 2)] + [(5, 0, 1), (5, 1, 0), (None, 1, 1), (6, None, None)]
    return docs, [(k, q, None if t is None else int(t)) for k, q, t in labels]


def test_replay_of_all_orders(spark):
    docs, labels = filter_docs()
    d = spark.createDataFrame([(*x, 3, "x") for x in docs], "doc_id bigint, text string, source string, fails int, first string").repartition(3)
    lab = spark.createDataFrame([(*x, "z") for x in labels], "doc_id bigint, quality int, toxic int, part string")
    got = interactions.audit(d, lab)
    want = brute_filters(docs, labels)
    assert sorted(map(tuple, got.collect())) == want and {x[0] for x in want} == {"", "a", "b", "long"}
    share = {(r.part, r["filter"]): r.share for r in interactions.shares(got).collect()}
    mine = {}
    for part, order, step, _, removed, *_ in want:
        mine[part, order[step - 1]] = mine.get((part, order[step - 1]), 0) + removed / 120
    assert share == pytest.approx(mine)


def test_no_documents_and_no_labels(spark):
    docs, labels = filter_docs()
    d, lab = spark.createDataFrame(docs, "doc_id bigint, text string, source string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    assert interactions.audit(d.limit(0), lab).collect() == []
    assert sorted(map(tuple, interactions.audit(d, lab.limit(0)).collect())) == brute_filters(docs, [])
