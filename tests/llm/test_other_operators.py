"""SimHash, language ID, WARC audit and the pipeline against brute force."""

import gzip
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_near_duplicates import brute as brute_near
from winnowkit.llm import langid, packing, simhash, warc
from winnowkit.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, threshold=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(simhash.near(fps[i + 1 :], fps[i], threshold)):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


TEXTS = [None, "", " \t", "A", "a B", "A b C", "a b\tc  D\x0be", "é È X y z w q", "a b c " * 30_000]


def test_fingerprint():
    for t in TEXTS:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_simhash_components(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    texts = list(TEXTS)
    for _ in range(30):
        base = [rnd.choice(words) for _ in range(300)]
        for _ in range(6):
            copy = list(base)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(300)] = rnd.choice(words)
            texts.append(" ".join(copy))
    rows = [(1000 - i, t, "x", 7) for i, t in enumerate(texts)] + [(5000, texts[-1], "x", 7), (5000, texts[-1], "x", 7), (None, texts[-1], "x", 7)]
    got = simhash.simhash(spark.createDataFrame(rows, "doc_id bigint, text string, fp string, component_id int")).collect()
    assert len(got) == len(rows)
    ids = [r[0] for r in rows]
    root = brute_components(np.array([brute_fingerprint(r[1]) for r in rows], np.uint64))
    low = {}
    for i, r in zip(ids, root, strict=True):
        if i is not None:
            low[r] = min(i, low.get(r, i))
    want = sorted((i or -1, f"{brute_fingerprint(t[1]):016x}", low[r]) for i, t, r in zip(ids, rows, root, strict=True))
    assert sorted((r.doc_id or -1, r.fingerprint, r.component_id) for r in got) == want
    assert simhash.simhash(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def ball(n, rng):
    """A dense ball: far more members of an anchor than a task may hold."""
    fps = {0}
    while len(fps) < n:
        x = 0
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            x |= 1 << int(b)
        fps.add(x)
    return np.array(sorted(fps), np.uint64)


def test_crowded_anchors_are_found():
    fps = ball(600, np.random.default_rng(4))
    index, anchor = simhash.anchors_of(fps)
    order = np.argsort(anchor, kind="stable")
    batches = [pa.RecordBatch.from_arrays([pa.array(anchor[order][i : i + 97]), pa.array(fps[index][order][i : i + 97].view(np.int64))], ["a", "fp"]) for i in range(0, len(order), 97)]
    rows = [r for b in simhash._compare(3, 64)(iter(batches)) for r in b.to_pylist()]
    sizes = dict(zip(*np.unique(anchor, return_counts=True), strict=True))
    assert {r["a"] for r in rows if r["kind"] == 1} == {a for a, n in sizes.items() if n > 64}


@pytest.mark.parametrize("most", [64, 12])
def test_crowded_anchors_are_split(spark, monkeypatch, most):
    """Down to cells so small that some are too large again and are split a second time."""
    fps, written, settle = ball(600, np.random.default_rng(4)), [], simhash.settle
    monkeypatch.setattr(simhash, "settle", lambda df, name, path=None: written.append((name, settle(df, name, path))) or written[-1][1])
    links = simhash.links(spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint"), most=most)
    crowded = [d for name, d in written if name == "crowded"]
    assert written[0][0] == "found" and written[0][1].where("kind = 1").count() > 100 and len(crowded) >= (1 if most == 64 else 2)
    assert crowded[0].where("kind = 0").count() > 0 and crowded[-1].where("kind = 1").count() == 0
    got = {r.node: r.root for r in components(links).collect()}
    want = brute_components(fps)
    signed = fps.view(np.int64).tolist()
    groups, found = {}, {}
    for i, w in enumerate(want):
        groups.setdefault(w, set()).add(signed[i])
    for x in signed:
        found.setdefault(got.get(x, x), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, found.values()))


def test_components(spark):
    rnd = random.Random(8)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root if any(x in p and p[0] != p[1] for p in links)}


def speech(n=160):
    rnd = random.Random(9)
    syllables = {"aa": ["ka", "to", "mi", "ra", "su"], "bb": ["sch", "eib", "unt", "gr", "ölm"], "cc": ["ção", "ñe", "lla", "ió", "que"]}
    rows = []
    for i in range(n * 3):
        lang = ("aa", "bb", "cc")[i % 3]
        rows.append((i, " ".join("".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(3, 60))), lang))
    return rows


def test_language_id(spark):
    rows = speech() + [(10_001, None, "aa"), (10_002, "", "aa"), (10_003, "123 !? _ ½", "bb"), (10_004, "ka to mi", None), (None, "ka to mi ra", "aa"), (10_006, "kato " * 60_000, None)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string")
    got = langid.identify(d, langid.fit(d)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, _, _ in rows:
        assert by[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(by[i].lang_pred == "und" and by[i].rejected for i in (10_001, 10_002, 10_003))
    held = [(by[i].lang_pred, lang) for i, _, lang in rows[:480] if by[i].held_out]
    assert len(held) > 80 and sum(a == b for a, b in held) >= 0.97 * len(held)
    assert by[None].lang_pred == by[10_004].lang_pred == by[10_006].lang_pred == "aa"
    none = d.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(none, langid.fit(none)).collect()} == {"und"}
    assert langid.keep_identified(d).columns == d.columns and langid.keep_identified(d.limit(0)).collect() == []


def test_labels_of_held_out_rows_are_not_learned(spark):
    d = spark.createDataFrame(speech(), "doc_id bigint, text string, lang string")
    lied = d.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    a, b = langid.fit(d), langid.fit(lied)
    assert a.languages == b.languages and (a.table == b.table).all()


def test_merkle_audit(spark):
    rnd = random.Random(6)
    rows, theirs, want = [], [], {}
    for f in (0, 1, 2, None):
        at = 0
        for i in range(400):
            n = rnd.randint(200, 60_000)
            rows.append((f, at, n, f"d{f}-{i}"))
            fate = rnd.random() if f != 2 else 1
            if fate < 0.01:
                want[(f, at)] = "missing"
            else:
                theirs.append((f, at, n, f"d{f}-{i}" if fate >= 0.02 else "bad"))
                if fate < 0.02:
                    want[(f, at)] = "changed"
            at += n
    theirs.append((7, 0, 5, "new"))
    want[(7, 0)] = "extra"
    ddl = "file bigint, offset bigint, length bigint, digest string"
    ours, other = spark.createDataFrame(rows, ddl), spark.createDataFrame(theirs, ddl)
    assert {(r.file, r.offset): r.state for r in warc.audit(ours, other).collect()} == want
    assert warc.audit(ours, ours).collect() == [] and warc.audit(ours.limit(0), ours.limit(0)).collect() == []
    assert len(warc.audit(ours.limit(0), ours).collect()) == len(rows)


def test_every_node_has_at_most_fanout_children(spark, monkeypatch):
    monkeypatch.setattr(warc, "FANOUT", 4)
    monkeypatch.setattr(warc, "RANGE", 100)
    rows = [(f, i * 60, 60, f"{f}-{i}") for f in (1, 2) for i in range(500)]
    ours = spark.createDataFrame(rows, "file bigint, offset bigint, length bigint, digest string")
    levels = warc.tree(ours)
    assert len(levels) - 1 == warc.height(ours) == 5  # 300 ranges
    for level, above in zip(levels, levels[1:], strict=False):
        assert max(r["count"] for r in level.groupBy("file", "parent").count().collect()) <= 4
        assert {(r.file, r.parent) for r in level.collect()} == {(r.file, r.node) for r in above.collect()}
    assert levels[-1].count() == 2
    other = ours.withColumn("digest", F.when((F.col("file") == 2) & (F.col("offset") == 17_940), "x").otherwise(F.col("digest")))
    assert [tuple(r) for r in warc.audit(ours, other).collect()] == [(2, 17_940, "changed")]


def crawl(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "record_id bigint, file bigint, url string, html string, offset int, path string")


def test_damage_on_disk_is_found(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(i, i // 50, f"http://h/{i}", "".join(rnd.choice("abc<é日>\n") for _ in range(rnd.choice((0, 50, 4000))))) for i in range(200)]
    rows += [(300, None, None, None), (301, None, "u", "x" * 3_000_000), (302, 9, "same", "same"), (302, 9, "same", "same")]
    here, there = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    index = warc.write(crawl(spark, rows), here)
    assert index.count() == len(rows)
    for r in index.collect():  # the files are WARCs that any reader of gzip members reads
        raw = (tmp_path / "a" / r.path).read_bytes()
        text = gzip.decompress(raw[r["at"] : r["at"] + r["size"]]).decode()
        assert gzip.decompress(raw).decode()[: 8] == "WARC/1.1" and f"urn:record:{r.record_id}>" in text and len(text.encode()) == r.length
    ours = warc.measure(index, here)
    twin = warc.copy(index, here, there)
    assert warc.audit(ours, warc.measure(twin, there)).collect() == []
    places, want = {(r.record_id, r.file): r for r in twin.collect()}, {}
    for i in (3, 77, 301):
        r = places[(i, None if i == 301 else i // 50)]
        path = tmp_path / "b" / r.path
        raw = bytearray(path.read_bytes())
        raw[r["at"] + r["size"] // 2] ^= 1
        path.write_bytes(raw)
        want[(r.file, r["at"])] = "changed"
    r = places[(120, 2)]
    path = tmp_path / "b" / r.path
    raw = bytearray(path.read_bytes())
    raw[r["at"] : r["at"] + r["size"]] = bytes(r["size"])
    path.write_bytes(raw)
    want[(2, r["at"])] = "missing"
    path = tmp_path / "b" / places[(199, 3)].path
    path.write_bytes(path.read_bytes()[: places[(180, 3)]["at"]])  # a cut end
    want |= {(3, places[(i, 3)]["at"]): "missing" for i in range(180, 200)}
    (tmp_path / "b" / places[(302, 9)].path).unlink()
    want |= {(9, r["at"]): "missing" for r in twin.where("file = 9").collect()}
    for c in (tmp_path / "b").glob(".*.crc"):
        c.unlink()
    assert {(r.file, r.offset): r.state for r in warc.audit(ours, warc.measure(twin, there)).collect()} == want


def test_an_empty_crawl(spark, tmp_path):
    index = warc.write(crawl(spark, []), f"file://{tmp_path}/a")
    twin = warc.copy(index, f"file://{tmp_path}/a", f"file://{tmp_path}/b")
    ours, theirs = warc.measure(index, f"file://{tmp_path}/a"), warc.measure(twin, f"file://{tmp_path}/b")
    assert index.collect() == [] == ours.collect() == warc.audit(ours, theirs).collect()


def test_a_record(spark):
    pages = spark.createDataFrame([(2, None, "é"), (1, "http://x", None)], "id bigint, url string, html string")
    recs = {r.id: r.r for r in pages.select("id", warc.record(F.col("id"), F.col("url"), F.col("html")).alias("r")).collect()}
    assert recs[2].endswith("WARC-Target-URI: \r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 2\r\n\r\né\r\n\r\n") and "Content-Length: 0\r\n" in recs[1]


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null and repeated ids, clashing columns, very long texts, and an empty table, stage by stage."""
    rnd = random.Random(4)
    words = ["kato", "mira", "suka", "tomi", "rasu", "neko"]
    make = lambda n: " ".join(rnd.choice(words) + rnd.choice(words) + rnd.choice(words) for _ in range(n))
    rows = [(i, make(80), "aa") for i in range(80)]
    long = make(30_000)
    rows += [(None, rows[0][1], "aa"), (None, make(60), None), (7, make(90), "aa"), (7, rows[7][1], "aa"), (200, long, "aa"), (201, long + " end", None), (202, None, None), (203, "", "aa")]
    other = make(70)
    rows += [(None, other, "aa"), (None, other, "aa")]
    ddl = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, digest string, m string, k int, h bigint, component_id int, rejected boolean"
    df = spark.createDataFrame([(d, t, lang, None, len(t or ""), 1, "x", "y", 2, 3, 4, None) for d, t, lang in rows], ddl)
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
        empty = stage(spark, df.limit(0), str(tmp_path))
        assert empty.columns == df.columns and empty.collect() == []
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in docs.collect())
    want = sorted([(d, t) for d, t, _ in rows[:80]] + [(-1, rows[81][1]), (7, rows[82][1]), (200, long), (-1, other)])
    assert got == want and all(r.digest == "x" and r.m == "y" and r.source is None for r in docs.collect())
    assert {r.doc_id for r in corpus_pipeline.pack(spark, docs, str(tmp_path)).collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.pack(spark, df.limit(0), str(tmp_path)).collect() == []


def test_pipeline(spark, tmp_path):
    rnd = random.Random(3)
    words = {"aa": ["kato", "mira", "suka", "tomi", "rasu"], "bb": ["scheib", "untgr", "ölmsch", "eibunt", "grölm"]}
    make = lambda lang, n: " ".join(rnd.choice(words[lang]) + rnd.choice(words[lang]) + rnd.choice(words[lang]) for _ in range(n))
    rows = [(i, make(("aa", "bb")[i % 2], 120), ("aa", "bb")[i % 2]) for i in range(200)]
    exact_copies = [(1000 + i, re.sub("[a-z]+", lambda m: m[0].upper(), rows[i][1]) if i % 2 else rows[i][1], rows[i][2]) for i in range(20)]
    near = [(2000 + i, rows[i + 50][1] + " tail", rows[i + 50][2]) for i in range(20)]
    bad = [(3000, None, "aa"), (3001, "too short", "aa"), (3002, "same words again now " * 30, "aa"), (3003, "12 34 56 78 90 11 13 14 15 16 17", "bb")]
    every = rows + exact_copies + near + bad
    df = spark.createDataFrame([(d, t, lang, f"s{d % 3}", len(t or "")) for d, t, lang in every], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    docs, columns = df, df.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    texts = {d: t for d, t, _ in every}
    alive = [d for d in texts if texts[d] and d < 3000]
    last = {}
    for d in alive:
        key = texts[d].lower()
        last[key] = max(d, last.get(key, d))
    unique = sorted(last.values())
    want = {c for _, c in brute_near([(d, texts[d]) for d in unique])}
    assert {r.doc_id for r in docs.collect()} == want
    assert not want & set(range(20)) and len(want) < len(unique)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == want and [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "exact dedup", "SimHash near-dedup", "packing"]
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values()) and set(out[0].asDict()) == {"doc_id", *packing._COLUMNS}
