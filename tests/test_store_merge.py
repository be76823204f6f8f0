"""The merge of a run into the store."""

import random
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from tests.test_operators import Store
from winnowkit.operators import graph, seen, timeline
from winnowkit.plans import queries

SF = "/root/testdata/sf0.001"


def test_every_posting_that_is_not_rejected_has_an_entry(spark):
    stored = {k for r in queries.store_merge(spark, SF).collect() for k in r["keys"].split(",")}
    now = queries._screened_table(spark, SF).where("band <> 'rejected'").select("object_id").collect()
    assert now and all("id:" + r.object_id in stored for r in now)


def test_latest_before_spreads_a_hot_key(spark):
    rnd = random.Random(1)
    keys = ["hot"] * 8 + ["a", "b", "c", "none"]
    asked = [(rnd.choice(keys), rnd.randint(0, 4000), i) for i in range(3000)]
    marks = [(rnd.choice(keys[:-1]), rnd.randint(0, 4000)) for _ in range(300)]
    a, m = spark.createDataFrame(asked, "k string, t bigint, i int"), spark.createDataFrame(marks, "k string, t bigint")
    for inclusive in (False, True):
        got = {r.i: r.mark for r in timeline.latest_before(a, m, inclusive).collect()}
        assert got == {i: max((u for n, u in marks if n == k and (u < t or inclusive and u == t)), default=None) for k, t, i in asked}
    assert timeline.latest_before(a.limit(0), m).collect() == [] and {r.mark for r in timeline.latest_before(a, m.limit(0)).collect()} == {None}


def entry(object_id, keys, seq, first="d0", company="X", band="possible"):
    return (object_id, keys, band, first, first, 1, False, False, False, "t", company, "", seq)


def run_model(entries, rows, day):
    """The sequential store: (entries in the order of the written store) after ``rows`` of (ord, object_id, keys, band, action)."""
    model, rank = Store(), {"strong": 2, "possible": 1}
    for e in sorted(entries, key=lambda e: (e[3], e[10], e[12])):
        model.put({"id": e[0], "keys": e[1], "band": e[2], "first": e[3], "last": e[4], "n": e[5], "company": e[10]})
    for late in (False, True):
        for _, object_id, keys, band, action in sorted(rows):
            if (action == "suppressed") != late:
                continue
            e = model.find(keys)
            if e is None:
                model.put({"id": object_id, "keys": keys, "band": band, "first": day, "last": day, "n": 1, "company": "X"})
            elif late:
                model.put(e | {"keys": sorted({*e["keys"], *keys})})
            else:
                model.put(e | {"keys": sorted({*e["keys"], *keys}), "band": max(e["band"], band, key=rank.get), "last": day, "n": e["n"] + 1})
    return [(e["id"], e["keys"], e["band"], e["first"], e["last"], e["n"]) for e in sorted(model.entries.values(), key=lambda e: (e["first"], e["company"]))]


def merged(spark, entries, rows, day="d9"):
    store = graph.durable(spark.createDataFrame(entries, seen.ENTRY_DDL))
    df = spark.createDataFrame(rows, "ord bigint, object_id string, keys array<string>, band string, action string")
    df = df.withColumns({"raw_title": F.lit("t"), "title": F.lit("t"), "company": F.lit("X"), "company_host": F.lit("")})
    return [(r.object_id, r["keys"], r.band, r.first_surfaced, r.last_surfaced, r.surfaced_count) for r in seen.in_order(seen.merge(store, graph.durable(df), day)).collect()]


@pytest.mark.parametrize("seed", range(2))
def test_keys_that_change_hands(spark, seed):
    """Few keys, so that nearly all are held by several entries, and object ids that repeat."""
    rnd = random.Random(seed)
    entries = [entry(f"e{i % 9}" if seed % 2 else f"e{i}", sorted({f"k{rnd.randint(0, 14)}" for _ in range(rnd.randint(1, 3))}), i, rnd.choice(["d0", "d1"]), rnd.choice("XY")) for i in range(12)]
    held = {k for e in entries for k in e[1]}
    rows = []
    for i in range(40):
        keys = sorted({f"k{rnd.randint(0, 34)}" for _ in range(rnd.randint(0, 3))})
        action = rnd.choice(["new", "suppressed"]) if held & set(keys) else "new"
        rows.append((i, rnd.choice(["", "e1", f"n{i}", f"n{i}"]), keys, rnd.choice(["strong", "possible"]), action))
    assert merged(spark, entries, rows) == run_model(entries, rows, "d9")


def test_places_beyond_any_bound(spark):
    wide = 2**41
    entries = [entry("old1", ["id:a"], 1), entry("old2", ["id:b"], 2)]
    rows = [(wide, "x", ["id:K", "id:a"], "strong", "promoted"), (wide + 2**42, "y", ["id:K", "id:b"], "possible", "suppressed"), (0, "z", ["id:b", "id:c"], "possible", "suppressed")]
    assert merged(spark, entries, rows) == run_model(entries, rows, "d9")  # in the order that tells the owner of id:K in the next run


def test_one_set_of_very_many_postings_is_spread(spark):
    """40,000 postings in one connected set: a common cluster, and chains of ids that reach back to it."""
    n = 40_000
    rows = spark.range(n).select(
        F.col("id").alias("ord"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("object_id"),
        F.when(F.col("id") % 4 == 0, F.array(F.lit("cluster:all"), F.concat(F.lit("id:p"), F.col("id").cast("string"))))
        .otherwise(F.array(F.concat(F.lit("id:p"), (F.col("id") - 1).cast("string")), F.concat(F.lit("id:p"), F.col("id").cast("string")))).alias("keys"),
        F.lit("possible").alias("band"), F.lit("new").alias("action"), *[F.lit("t").alias(c) for c in ("raw_title", "title", "company", "company_host")],
    )
    after = seen.merge(graph.durable(seen.empty_store(spark)), graph.durable(rows), "d1").collect()
    (e,) = after
    assert (e.object_id, len(e["keys"]), e.surfaced_count, e.put_seq) == ("p0", n + 1, n, n)


def test_a_long_chain_is_followed(spark):
    rows = [(i, f"p{i}", [f"k{i:04}", f"k{i + 1:04}"], "possible", "new") for i in range(300)]
    got = merged(spark, [], rows)
    assert got == run_model([], rows, "d9") and len(got) == 1
    assert all(a < b for a, b in pairwise(got[0][1]))


def test_nothing_to_merge(spark):
    entries = [entry("a", ["id:a"], 1)]
    assert merged(spark, entries, []) == run_model(entries, [], "d9")


def test_many_asks_of_a_key_that_many_hold_stay_in_proportion(spark, monkeypatch):
    """80 postings ask for a key that 80 entries hold: their timelines have some rows of either, not their product."""
    entries = [entry(f"s{i}", ["cluster:a", f"id:s{i}"], i) for i in range(80)]
    rows = [(i, f"n{i}", ["cluster:a", f"id:{'s' if i % 3 else 'n'}{i}"], "strong", "suppressed" if i % 5 == 0 else "promoted") for i in range(80)]
    sizes, write = [], timeline.settle
    monkeypatch.setattr(timeline, "settle", lambda df, name, *a: sizes.append(write(df, name, *a)) or sizes[-1])
    assert merged(spark, entries, rows) == run_model(entries, rows, "d9")
    assert max(t.count() for t in sizes) < 1000
