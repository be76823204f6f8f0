"""Quality rules, exact dedup, chat formatting and license scans on small tables with odd rows."""

import hashlib
import random
import re
import textwrap
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from winnowkit.llm import chat, exact, licenses, quality, store

DOCS = "doc_id bigint, text string, source string, n_chars bigint, lines string, digest string, row int, keep_id int"


def docs(spark, rows):
    """Rows of (doc_id, text, source), with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, s, len(t or ""), "x", "y", 1, 2) for d, t, s in rows], DOCS)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def base_counts(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {p for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), failed


def odd_texts():
    rnd = random.Random(3)
    words = ["a", "B", "cé", "#x", "日本", "dd"]
    made = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    made += ["\n".join(" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 12))) for _ in range(60)]
    return [None, "", " \n\t\x0b", "a b c d e " * 5000, "x", *made]


def test_base_counts(spark):
    texts = odd_texts()
    got = quality.quality(docs(spark, [(i, t, f"s{i % 3}") for i, t in enumerate(texts)])).collect()
    assert len(got) == len(texts)
    for r in got:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert found == base_counts(texts[r.doc_id]), texts[r.doc_id]


def frequency_rows():
    unique = lambda i: f"w{i} v{i} u{i} t{i} s{i} r{i} q{i} p{i} o{i} n{i} m{i}"
    rows = [(i, f"Common  boilerplate of the host\n{unique(i)}\n{unique(-i - 1)}", "h1") for i in range(40)]
    rows += [(100 + i, "COMMON boilerplate of the host\n" * 1 + f"only few {i} words here in all of it", "h1") for i in range(3)]
    rows += [(200 + i, f"Common boilerplate of the host\n{unique(200 + i)}", None) for i in range(5)]
    return rows


@pytest.mark.parametrize("most", [store.BROADCAST_ROWS, 0])
def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark, monkeypatch, most):
    monkeypatch.setattr(store.small, "__defaults__", (None, most))
    limits = quality.Limits(min_docs=10, max_share=0.1, min_kept=0.6, min_words=3)
    rows = frequency_rows()
    got = {r.doc_id: r.kept for r in quality.quality(docs(spark, rows), limits=limits).collect()}
    assert all(got[i] for i in range(40)) and not any(got[100 + i] for i in range(3)) and all(got[200 + i] for i in range(5))
    kept = {r.doc_id: r for r in quality.filter_quality(docs(spark, rows), limits=limits).collect()}
    assert set(kept) == {d for d, k in got.items() if k}
    assert kept[3].text == rows[3][1].split("\n", 1)[1] and kept[3].n_chars == len(kept[3].text) and kept[3].digest == "y"
    assert kept[201].text == rows[44][1]  # the null host is one of its own, under the limit


def test_quality_on_an_empty_table(spark):
    assert quality.quality(docs(spark, [])).collect() == []
    assert quality.filter_quality(docs(spark, [])).columns == [c.split(" ")[0] for c in DOCS.split(", ")]


def test_exact_dedup(spark):
    rows = [(1, "Abc É", "s"), (2, "aBC É", "s"), (3, "abc é", "s"), (4, None, "s"), (5, "", "s"), (9, "x", "s"), (9, "x", "s"), (None, "x", "s"), (None, "n", "s"), (None, "n", "s")]
    got = exact.exact_dedup(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    of = lambda i: [(r.keep_id, r.group_size, r.kept) for r in got if r.doc_id == i]
    assert of(1) == [(2, 2, False)] and of(2) == [(2, 2, True)] and of(3) == [(3, 1, True)]
    assert of(4) == [(5, 2, False)] and of(5) == [(5, 2, True)]
    assert sorted(of(9)) == [(9, 3, False), (9, 3, True)]
    assert sorted(of(None), key=str) == [(9, 3, False), (None, 2, False), (None, 2, True)]
    assert {r.text_sha256 for r in got if r.doc_id == 1} == {hashlib.sha256("abc É".encode()).hexdigest()}
    assert exact.exact_dedup(docs(spark, [])).collect() == []


def test_index_outlives_its_batch(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    first = exact.DigestIndex(spark, path, 4)
    assert first.add(docs(spark, [(1, "a", "s"), (2, "b", "s")])).where("kept").count() == 2
    again = exact.DigestIndex(spark, path, 16)
    assert again.buckets == 4 and again.table().count() == 2
    got = {r.doc_id: (r.keep_id, r.kept) for r in again.add(docs(spark, [(3, "A", "s"), (4, "c", "s"), (1, "a", "s")])).collect()}
    assert got == {3: (1, False), 4: (4, True), 1: (1, False)}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index")]


def test_a_batch_that_is_added_again_keeps_the_same_rows(spark, tmp_path):
    one = docs(spark, [(1, "a", "s"), (2, "b", "s"), (3, "A", "s"), (None, "n", "s"), (None, "n", "s")])
    two = docs(spark, [(9, "a", "s"), (10, "c", "s")])
    index = exact.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    verdicts = lambda d, b: sorted(((r.doc_id or 0, r.keep_id or 0, r.kept) for r in index.add(d, batch=b).collect()))
    first, second = verdicts(one, "one"), verdicts(two, "two")
    assert [x[0] for x in first if x[2]] == [0, 2, 3] and [x[0] for x in second if x[2]] == [10]
    assert verdicts(one, "one") == first and verdicts(two, "two") == second and index.table().count() == 4
    # A crash in the append: part of the batch's digests are in the index.
    part = exact.DigestIndex(spark, f"file://{tmp_path}/part", 4)
    part.add(one.where("doc_id = 2"), batch="one")
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.kept) for r in part.add(one, batch="one").collect()) == first


def test_a_compacted_index_is_read_in_order(spark, tmp_path):
    index = exact.DigestIndex(spark, f"file://{tmp_path}/index", 4)
    for i in range(3):
        index.add(docs(spark, [(10 * i + j, f"t{i}-{j}", "s") for j in range(8)]))
    before = sorted(tuple(r) for r in index.table().collect())
    index.compact()
    assert sorted(tuple(r) for r in index.table().collect()) == before and len(list(tmp_path.glob("index/b4/*"))) == 1
    assert 1 <= len(list(tmp_path.glob("index/b4/g1/*.parquet"))) <= 4
    index = exact.DigestIndex(spark, f"file://{tmp_path}/index", 8)
    assert (index.buckets, index.generation) == (4, 1)
    new = docs(spark, [(7, "q", "s"), (8, "t0-0", "s")]).select(exact.digest_of(F.col("text")).alias("digest")).hint("merge")
    with index._registered() as name:
        plan = new.join(spark.table(name), "digest", "left_anti")
        assert plan.count() == 1
        text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and text.count("Sort [digest") == 1  # only the new digests are sorted


def test_batches(spark):
    a, b = docs(spark, [(5, "x", "s"), (6, "y", "s")]), docs(spark, [(1, "X", "s"), (2, "z", "s"), (None, "z", "s")])
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.dedup_batches([a, b]).collect()}
    assert got == {(5, 5, 2, True), (6, 6, 1, True), (1, 5, 2, False), (2, 2, 2, True), (None, 2, 2, False)}
    assert exact.dedup_batches([a.limit(0), b.limit(0)]).collect() == []


def test_keep_rows(spark, monkeypatch):
    rows = [(1, "A", "s"), (2, "a", "s"), (2, "a", "s"), (3, "b", "s"), (None, "n", "s"), (None, "m", "s"), (4, None, "s"), (5, "", "s")]
    d = docs(spark, rows).withColumn("m", F.lit("clash"))
    for most in (store.BROADCAST_ROWS, 0):  # the way without a broadcast too
        monkeypatch.setattr(store.small, "__defaults__", (None, most))
        kept = exact.keep_rows(d)
        assert kept.columns == d.columns and sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "m"), (-1, "n"), (2, "a"), (3, "b"), (5, "")]
    assert sorted(r.doc_id for r in exact.keep_rows(docs(spark, rows[3:4] + rows[6:])).collect()) == [3, 5]
    assert exact.keep_rows(d.limit(0)).collect() == []


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, n string, source string")


def test_chat_round_trip(spark):
    rnd = random.Random(5)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "&l;", "&a;", "&", "<", "[", "s>", "/INST]", "é", "\n", "日", " "]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "<s>", None]), "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8)))) for c in range(80) for t in range(rnd.randint(1, 5))]
    rows += [(500, 0, "user", None), (500, 0, "user", None), (None, 1, "assistant", "x"), (None, 1, "assistant", "x"), (None, 2, "user", "y"), (501, None, "assistant", "late"), (501, 0, "assistant", "x" * 200_000)]
    formatted = chat.format_chats(chats(spark, rows))
    every = chat.read_back(formatted).collect()
    assert sorted([(t.role, t.text) for t in r.turns] for r in every if r.conv_id is None) == [[("assistant", "x")], [("assistant", "x")], [("user", "y")]]
    back = {r.conv_id: r for r in every if r.conv_id is not None}
    by = {}
    for c, t, role, text in [r for r in rows if r[0] is not None]:
        by.setdefault(c, []).append((t is not None, t, role or "", text or ""))
    assert set(back) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert [(x.role, x.text) for x in back[c].turns] == [(r, t) for _, _, r, t in turns]
        assert back[c].loss_text == "".join(t for _, _, r, t in turns if r == "assistant")
        assert back[c].formatted.count("[/INST]</s>") == len(turns) == back[c].formatted.count("[INST]")
    assert chat.format_chats(chats(spark, [])).collect() == []


def test_license_scan(spark):
    rows = [
        (1, "code\nLicensed under the Apache License, Version 2.0.\nmore", "a/b/x.txt"), (2, "no notice, though a license is named", "a/b/c/y.txt"), (3, "Released under the MIT License.", "a/b/LICENSE"),
        (4, None, "a/z.txt"), (5, "", None), (6, "This work is licensed under the GNU General Public License, version 3.", "LICENSE"), (7, "plain", "other/deep/er/f"),
        (7, "plain", "other/deep/er/f"), (8, "LICENSED UNDER CC BY-NC 4.0", "c.txt"), (9, "License", None), (10, "the license of the work", None), (11, "word " * 200_000, None),
    ]
    d = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id bigint, text string, path string, score int, own string, term string")
    got = sorted((r.doc_id, r.license, r.origin, r.levels_up) for r in licenses.scan(d).collect())
    assert got == [
        (1, "Apache-2.0", "own", None), (2, "MIT", "inherited", 1), (3, "MIT", "own", None), (4, "GPL-3.0", "inherited", 1), (5, None, "none", None),
        (6, "GPL-3.0", "own", None), (7, "GPL-3.0", "inherited", 3), (7, "GPL-3.0", "inherited", 3), (8, "CC-BY-NC-4.0", "own", None),
        (9, None, "none", None), (10, None, "none", None), (11, None, "none", None),
    ]
    assert licenses.scan(d.limit(0)).collect() == []


def full(name):
    return (Path(licenses.__file__).parent / "license_texts" / f"{name}.txt").read_text()


def comment(text, mark):
    return "\n".join(f"{mark} {line}".rstrip() for line in text.strip().split("\n"))


def license_cases():
    apache_header = licenses.FORMS["Apache-2.0"][-1]
    bsd = full("BSD-3-Clause").replace("the copyright holder nor the names of its", "Acme Corp nor the names of its").replace("Copyright (c)", "Copyright (c) 2019, Acme Corp\nAll rights reserved.")
    gpl = "Copyright (C) 2024 Jane Roe\n\n" + "\n\n".join("\n".join(textwrap.wrap(x, 66)) for x in re.split(r"(?<=later version\.) |(?<=more details\.) ", licenses.FORMS["GPL-3.0"][-2]))
    code = "\npackage main\n\nimport os\nfunc main() { run(os.Args) }\n" * 20
    return [
        *[(name, full(name)) for name in ("MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "ISC", "CC0-1.0", "Unlicense", "BSD-2-Clause", "BSD-3-Clause")],
        ("MIT", full("MIT").replace("Copyright (c)", "Copyright (c) 2024 Jane Roe and contributors").replace("\n", "\r\n")),
        ("BSD-3-Clause", bsd), ("Apache-2.0", f"// Copyright 2020 The Authors\n//\n{comment(apache_header, '//')}\n{code}"),
        ("Apache-2.0", "/*\n" + comment("\n".join(textwrap.wrap(apache_header, 70)), " *") + "\n */" + code), ("GPL-3.0", comment("\n".join(textwrap.wrap(licenses.FORMS["GPL-3.0"][-1], 60)), "#") + "\nimport x" + code),
        ("MIT", "# SPDX-License-Identifier: MIT\nimport x" + code), ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0" + code), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"),
        ("MIT", "MIT License"), ("MIT", "The MIT License (MIT)"), ("Apache-2.0", "Apache License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("MPL-2.0", "Mozilla Public License Version 2.0"), ("MIT", "// Licensed under the MIT license."),
        *[("GPL-3.0", comment(gpl, mark) + "\nimport x" + code) for mark in ("#", "//", " *", ";;")], ("GPL-3.0", "# Copyright 2020 Jane Roe\n#\n" + comment("\n".join(textwrap.wrap(licenses.FORMS["GPL-3.0"][-2], 70)), "#") + code),
        ("LGPL-2.1", comment("\n".join(textwrap.wrap(licenses.FORMS["LGPL-2.1"][-1], 70)) + "\n\nThis library is distributed in the hope that it will be useful.", "#") + code),
        ("AGPL-3.0", comment("\n".join(textwrap.wrap(licenses.FORMS["AGPL-3.0"][-1], 70)), "//") + code), ("Zlib", full("Zlib")), ("BSL-1.0", full("BSL-1.0")), ("EPL-2.0", comment("\n".join(textwrap.wrap(licenses.FORMS["EPL-2.0"][-1], 70)), " *") + code),
        *[(name, f"# SPDX-License-Identifier: {name}{kind}" + code) for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0") for kind in ("-only", "-or-later", "")], ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
        ("MIT", "// Copyright (c) Foo Corporation. All rights reserved.\n// Licensed under the MIT license. See LICENSE file in the project root for full license information." + code),
        ("Apache-2.0", "// Use of this source code is governed by the Apache 2.0 license that can be found in the LICENSE file." + code), ("BSD-3-Clause", "// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file." + code),
        (None, "// Use of this source code is governed by the Acme license that can be found in the LICENSE file." + code), (None, "Licensed under the Acme License, Version 2.0"), (None, "SPDX-License-Identifier: Acme-1.0"),
        (None, code), (None, "the software is provided to any person"), (None, "All rights reserved. This license may not be used."),
    ]


def test_real_licence_texts_and_headers(spark):
    prose = ["the quick brown fox of the house is in and of the software world", "a person may use the copy of the work or not"] * 20
    rows = [(i, text, None) for i, (_, text) in enumerate(license_cases())] + [(1000 + i, f"{p} w{i}", None) for i, p in enumerate(prose)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, path string")
    got = {r.doc_id: r.license for r in licenses.scan(d).collect()}
    assert [got[i] for i in range(len(license_cases()))] == [name for name, _ in license_cases()]
    assert all(got[1000 + i] is None for i in range(len(prose)))


def test_parts_without_a_telling_term_can_not_reach_the_score():
    listed = licenses.templates()
    rnd = random.Random(2)
    for frequency, total in (({}, 10), ({"the": 900, "of": 800, "license": 700, "software": 90, "permission": 3}, 1000)):
        unit, idf, other = licenses.template_weights(listed, frequency, total)
        telling = set(licenses.telling_terms(unit, idf, licenses.MIN_SCORE))
        assert telling < set(idf) and abs(sum(w * w for w in unit[0].values()) - 1) < 1e-9
        for vector in unit:
            words = [t for t in vector if t not in telling]  # the part that is most like the template
            for _ in range(20):
                tf = {t: vector[t] / idf[t] * rnd.choice((1, 1, 1, 0.5)) for t in words}
                norm = sum((n * idf[t]) ** 2 for t, n in tf.items()) ** 0.5 or 1
                assert sum(n * idf[t] * vector[t] for t, n in tf.items()) / norm < licenses.MIN_SCORE
