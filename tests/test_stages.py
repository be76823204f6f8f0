"""Concurrent writers, intermediate tables, line numbers, drift, gaps and the dedup report."""

import gzip
import json
import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_chain import record
from tests.test_operators import posting_rows
from winnowkit import tables
from winnowkit.operators import dedup, postings, scrape, seen
from winnowkit.plans import stages
from winnowkit.sources import jsonl
from winnowkit.streaming import incremental


def screened(spark, path, *ids):
    rows = posting_rows(spark, [{"object_id": i, "alternate_object_ids": [], "cluster_key": None} for i in ids])
    rows.withColumns({"band": F.lit("strong"), "near_miss": F.lit(False), "reject_reasons": F.array().cast("array<string>"), "demote_reasons": F.array().cast("array<string>")}).write.parquet(path)
    return path


def test_two_runs_at_once_both_stay(spark, tmp_path, monkeypatch):
    a, b, store = screened(spark, str(tmp_path / "a"), "a1", "both"), screened(spark, str(tmp_path / "b"), "b1", "both"), str(tmp_path / "store")
    merge, calls = seen.merge, []

    def slow(*args):
        calls.append(args)
        if len(calls) == 1:  # another run reads, merges and commits while this one is at work
            stages.diff(spark, b, store, str(tmp_path / "out-b"), "2024-01-02")
        return merge(*args)

    monkeypatch.setattr(seen, "merge", slow)
    meta = stages.diff(spark, a, store, str(tmp_path / "out-a"), "2024-01-02")
    assert len(calls) == 3 and (meta["new"], meta["suppressed"], meta["store_entries_before"], meta["store_entries_after"]) == (1, 1, 2, 3)
    number, version = stages.head(spark, store)
    assert number == 2 and sorted(r.object_id for r in spark.read.parquet(f"{store}/{version}").collect()) == ["a1", "b1", "both"]
    assert sorted(p.name for p in (tmp_path / "store").iterdir() if p.name.startswith("v")).__len__() == 2  # what lost the race is gone
    assert not stages.commit(spark, store, 1, "late") and stages.commit(spark, store, 2, version) and stages.head(spark, store) == (3, version)
    monkeypatch.setattr(stages, "commit", lambda *args: False)
    with pytest.raises(RuntimeError, match="2 times"):
        stages.diff(spark, a, store, str(tmp_path / "out-c"), "2024-01-03", attempts=2)


def test_intermediate_tables_go_with_their_stage(spark, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(tables, "shared_dir", lambda spark: f"file://{shared}")
    (tmp_path / "raw.jsonl").write_text("\n".join(json.dumps(record(i)) for i in range(12)) + "\n")
    stages.normalize(spark, str(tmp_path / "raw.jsonl"), str(tmp_path / "n"))
    stages.screen(spark, str(tmp_path / "n" / "postings"), str(tmp_path / "s"))
    stages.diff(spark, str(tmp_path / "s" / "screened"), str(tmp_path / "store"), str(tmp_path / "d"), "2024-01-01")
    with pytest.raises(jsonl.BadRecord):
        (tmp_path / "bad.jsonl").write_text("[1]")
        stages.normalize(spark, str(tmp_path / "bad.jsonl"), str(tmp_path / "x"))
    assert not list(shared.glob("*"))
    with tables.scope(spark):
        kept = tables.settle(spark.range(3), "inside")
        with tables.scope(spark):
            tables.settle(kept, "deeper")
        assert [p.name.rpartition("-")[2] for p in shared.glob("winnow-*")] == ["inside"] and kept.count() == 3
    assert not list(shared.glob("winnow-*"))
    outside = tables.settle(spark.range(3), "outside")
    assert outside.count() == 3 and len(list(shared.glob("winnow-*"))) == 1


def test_errors_name_the_line(spark, tmp_path):
    rnd = random.Random(3)
    lines = [rnd.choice(["", "  ", json.dumps({"a": "x" * rnd.randint(0, 90)})]) for _ in range(400)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for at, compress in ((0, False), (211, False), (399, False), (399, True)):
        made = [*lines]
        made[at] = "[not an object]"
        data = ("\n".join(made) + "\n").encode()
        home = tmp_path / f"{at}{compress}"
        home.mkdir()
        (home / "a.jsonl").write_text("\n\n{}\n")
        (home / ("b.jsonl.gz" if compress else "b.jsonl")).write_bytes(gzip.compress(data) if compress else data)
        for size in ("700b", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            try:
                with pytest.raises(jsonl.BadRecord, match=f"/b.jsonl.*, line {at + 1}: not a JSON object"):
                    jsonl.read(spark, str(home))
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_fields_that_drift(spark):
    rows = [{"objectID": "a", "is_expired": "no", "extra": {"x": 1}, "job_information": {"title": 5, "more": [1]}}, {"objectID": None, "source": 2.5, "job_information": [], "extra": 1}, {"id": True}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "line string").select(F.parse_json("line").alias("record"))
    got = {(r.path, r.kind): (r.n, r.state) for r in postings.drift(df).collect()}
    found = {k: v for k, v in got.items() if v[1] != "lost"}
    assert found == {
        ("is_expired", "string"): (1, "retyped"), ("extra", "object"): (1, "new"), ("extra", "number"): (1, "new"), ("job_information.title", "number"): (1, "retyped"),
        ("job_information.more", "array"): (1, "new"), ("source", "number"): (1, "retyped"), ("job_information", "array"): (1, "retyped"), ("id", "boolean"): (1, "retyped"),
    }
    assert got["apply_url", "string"] == (0, "lost") and ("objectID", "string") not in got and len(got) == len(found) + len(postings.READ_FIELDS) - 6
    assert {r.state for r in postings.drift(df.limit(0)).collect()} == {"lost"}


def test_days_that_no_run_covers(spark):
    rnd = random.Random(4)
    start = date(2024, 1, 1)
    runs = [(rnd.choice("ab"), start + timedelta(days=rnd.randint(0, 120)), rnd.randint(0, 6)) for _ in range(25)] + [("c", start, 2), ("d", None, 3), ("e", start, -1), ("e", start, None)]
    got = sorted((r.search, r.day, r.closing_window) for r in scrape.uncovered(spark.createDataFrame(runs, "search string, finished date, window int")).collect())
    want = []
    for s in "abc":
        mine = [(f - timedelta(days=w), f) for x, f, w in runs if x == s]
        first, latest = min(b for b, _ in mine), max(e for _, e in mine)
        days = [first + timedelta(days=i) for i in range((latest - first).days + 1)]
        bare = [d for d in days if not any(b <= d <= e for b, e in mine)]
        for d in bare:
            begin = d
            while begin - timedelta(days=1) in bare:
                begin -= timedelta(days=1)
            want.append((s, d, (latest - begin).days))
    assert got == sorted(want) and len(got) > 20


def test_quantiles_and_the_report_tables(spark):
    rnd = random.Random(5)
    for n in (2, 3, 7, 300):
        xs = [round(rnd.random(), 2) for _ in range(n)]
        got, count = dedup.exclusive_quantiles(spark.createDataFrame([(x,) for x in xs], "v double"), "v", [25, 50, 75])
        assert count == n and (got == pytest.approx(statistics.quantiles(xs, n=4)) or n < 3)
    assert dedup.exclusive_quantiles(spark.createDataFrame([(0.5,)], "v double"), "v", [25, 75]) == ([0.5, 0.5], 1)
    rows = [{"cluster_key": f"c{i // 2}" if i < 20 else None, "company": f"f{i // 3}", "requirements": f"a b c d{i % 4}" if i % 5 else "other words here", "source": f"s{i % 3}", "cities": ["x"] * (i % 2)} for i in range(40)]
    df = posting_rows(spark, rows)
    t = dedup.truth(df)
    assert t["groups"] == t["scored"] == 10 and t["min"] <= t["quartiles"][0] <= t["quartiles"][1] <= t["max"]
    worst = sorted(dedup.worst_merges(df.where("cluster_key is null"), "company", "requirements", 0.9, 3, ["source", "cities"]).collect(), key=lambda r: (r.similarity, r.company))
    assert len(worst) == 3 and all(r.similarity < 0.9 and 1 < r.n <= 3 and 1 <= r.source <= 3 for r in worst)
    skew = {(r.keyed, r.field, r.nth): (r.value, r.n) for r in dedup.keyed_skew(df, ["source"], most=2).collect()}
    assert skew[True, "source", 1] == ("s0", 7) and len(skew) == 4


def test_the_first_of_repeated_rows_of_a_batch_stays(spark):
    rows = [("b.jsonl", 0, 9, record(1, apply_url="late")), ("a.jsonl", 700, 5, record(1, apply_url="first")), ("a.jsonl", 900, 1, record(1, apply_url="second")), ("a.jsonl", 0, 0, record(2, objectID=""))]
    df = spark.createDataFrame([(f, s, o, json.dumps(r)) for f, s, o, r in rows], "file string, start bigint, ord bigint, line string").repartition(3)
    got = incremental.screen_batch(df.withColumn("record", F.parse_json("line")), incremental.rules.Screen()).collect()
    assert sorted((r.object_id, r.apply_url) for r in got) == [("", "https://boards.example/firm2/jobs/2"), ("o1", "first")]
