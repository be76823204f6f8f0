"""Landing in micro-batches lands what one batch run lands."""

import json
import random

import pytest
from pyspark.sql import functions as F

from winnowkit.functions.keys import record_key
from winnowkit.operators import scrape
from winnowkit.sources import pages as page_source
from winnowkit.streaming import landing


def made(seed):
    rnd = random.Random(seed)
    out = []
    for s in range(3):
        for p in range(7):
            ids = [rnd.choice([None, *"abcdefghij"]) for _ in range(rnd.choice([0, 1, 2, 4]) if p > 2 else 3)]
            items = [{"objectID": i} if i else {"x": 1} for i in ids]
            out.append({"search": s, "page": p, "payload": json.dumps({"pageProps": {"ssrHits": [*items, 5] if items else []}}), "at": f"2024-01-01T00:{s}{p}:00Z"})
    return out


def landed(spark, found, sizes, home, **kw):
    (home / "in").mkdir(parents=True)
    at = 0
    for n, size in enumerate(sizes):
        (home / "in" / f"{n:03}.json").write_text("\n".join(map(json.dumps, found[at : at + size])) + "\n")
        at += size
        q = landing.start(spark, str(home / "in"), str(home / "out"), str(home / "state"), **kw)
        q.awaitTermination()
    rows = spark.read.parquet(str(home / "out"))
    return sorted((r.search, r.page, r.pos, r.key, r.is_new, r.written) for r in rows.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_number_of_batches_lands_the_same(spark, tmp_path, seed):
    found = made(seed)
    df = spark.createDataFrame([(r["search"], r["page"], r["payload"]) for r in found], "search int, page bigint, payload string")
    rows = page_source.records(df).withColumn("key", record_key(F.col("record"))).drop("record")
    want = sorted((r.search, r.page, r.pos, r.key, r.is_new, r.written) for r in scrape.land(rows, df).collect())
    provider = spark.conf.get(landing._PROVIDER, None)
    for name, sizes in (("one", [21]), ("some", [2, 9, 1, 9])):
        assert landed(spark, found, sizes, tmp_path / name) == want
    assert spark.conf.get(landing._PROVIDER, None) == provider


def test_the_watermark_forgets(spark, tmp_path):
    one = {"search": 0, "page": 0, "payload": json.dumps({"ssrHits": [{"objectID": "a"}]}), "at": "2024-01-01T00:00:00Z"}
    later = [one | {"search": 9, "at": f"2024-01-0{d}T00:00:00Z", "payload": json.dumps({"ssrHits": [{"objectID": f"z{d}"}]}), "page": d} for d in (3, 4)]
    again = one | {"page": 1, "at": "2024-01-05T00:00:00Z"}
    got = landed(spark, [one, *later, again], [1, 1, 1, 1], tmp_path, delay="1 second")
    assert [(r[3], r[4], r[5]) for r in got if r[0] == 0] == [("a", True, True), ("a", True, True)]
