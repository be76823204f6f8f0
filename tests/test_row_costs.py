"""What a row costs: values are computed once, and no task has more than its share of rows."""

import math
import re

from pyspark.sql import functions as F

from winnowkit import tables
from winnowkit.functions import geo, keys, text
from winnowkit.operators import rollup

#: Unicode's white space, and signs that are none.
ENDS = ["", " ", "\t", " ", "　", "\x1f", "\x7f", "é", "."]


def filters(df) -> list[str]:
    """The conditions of the optimized plan's filters."""
    return re.findall(r"Filter (.*)", df._jdf.queryExecution().optimizedPlan().toString())


def company_rows(spark):
    ddl = "ord bigint, source string, is_expired boolean, homepage string, labels array<string>, points array<struct<lat:double,lon:double,lng:double>>, apply_url string, enriched_name string, posting_name string, profile string, category string, published string, title string"
    base = {"source": "lever", "is_expired": False, "labels": ["Reston, Virginia, US"], "points": [{"lat": 38.9, "lon": -77.3, "lng": None}]}
    rows = [
        {**base, "ord": 1, "homepage": "https://www.a.example.com/x", "apply_url": "https://b.example/acme/1"}, {**base, "ord": 2, "apply_url": "https://b.example/acme/2"},
        {**base, "ord": 3, "is_expired": True, "homepage": "c.example"}, {**base, "ord": 4}, {**base, "ord": 5, "homepage": "d.gov"}, {**base, "ord": 6, "homepage": "e.example", "points": [{"lat": 0.0, "lon": 1.0, "lng": None}]},
    ]
    return spark.createDataFrame(rows, ddl)


def test_a_filter_on_the_drop_reason_computes_nothing_anew(spark):
    d = rollup.judged(company_rows(spark), rollup.Rollup(38.95, -77.46, 150.0, ("Maryland",), (), ("gov",)))
    assert {r.ord: r.drop_reason for r in d.collect()} == {1: None, 2: None, 3: "expired", 4: "unidentifiable", 5: "excluded_website_tld", 6: "no_qualifying_location"}
    kept = d.where(F.col("drop_reason").isNull()).select("ord", "host", "places", "careers")
    assert not [c for c in filters(kept) if "regexp" in c or "transform" in c or "CASE" in c]
    assert [(r.ord, r.host, r.careers.url, len(r.places)) for r in kept.orderBy("ord").collect()] == [(1, "a.example.com", "https://b.example/acme/", 1), (2, None, "https://b.example/acme/", 1)]


def test_places_against_a_plain_model(spark):
    labels = [a + x + b for a in ENDS for b in ENDS for x in ("", "Reston", "Reston, Virginia, US", "A,, B ,C, ", ",,", "A,B")]
    points = [{"lat": 38.0 + i % 7 * 0.5 if i % 5 else None, "lon": -77.5 if i % 4 else 0.0, "lng": -77.0 if i % 3 else None} for i in range(len(labels))]
    d = spark.createDataFrame([(labels, points)], "labels array<string>, points array<struct<lat:double,lon:double,lng:double>>")
    got = d.select(geo.near(geo.places(F.col("labels"), F.col("points")), 38.95, -77.46, 100.0, ["Virginia"]).alias("p")).first().p
    space = text.SPACE

    def miles(lat, lon):
        a = math.sin(math.radians(lat - 38.95) / 2) ** 2 + math.cos(math.radians(38.95)) * math.cos(math.radians(lat)) * math.sin(math.radians(lon + 77.46) / 2) ** 2
        return 2 * 6_371_000 * math.asin(math.sqrt(a)) / 1609.344

    want = []
    for i, (label, p) in enumerate(zip(labels, points, strict=True)):
        label = label.strip(space)
        parts = [x.strip(space) for x in label.split(",") if x.strip(space)]
        state = parts[-2] if len(parts) >= 3 else None
        lon = p["lon"] or p["lng"]
        d = miles(p["lat"], lon) if p["lat"] is not None and lon is not None else None
        if label and (state or "").lower() != "virginia" and (d is None or d <= 100):
            want.append((d is None, d or 0.0, i, label, state))
    want.sort()
    assert len(want) > 100 and [(r.label, r.state, r.distance_miles is None) for r in got] == [(label, state, far) for far, _, _, label, state in want]
    assert all(abs(r.distance_miles - d) < 1e-6 for r, (far, d, *_) in zip(got, want, strict=True) if not far)


def test_newest_first_is_the_order_of_negated_code_points(spark):
    dates = ["", None, "2024-01-02", "2024-01-0", "2024-01-020", "2023", "é", "z", "￮", "\U0001f600", "a" * 30]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(dates)], "i int, d string")
    got = [r.i for r in d.orderBy(keys.newest_first(F.col("d")), "i").collect()]
    assert got == sorted(range(len(dates)), key=lambda i: ([-ord(c) for c in dates[i] or ""], i))
    plain = [r.i for r in d.where("d is not null").orderBy(rollup.newest_key_plain(F.col("d")), "i").collect()]
    assert plain == sorted((i for i, x in enumerate(dates) if x is not None), key=lambda i: (dates[i] == "", [-ord(c) for c in dates[i]] + [1], i))


def test_a_large_table_has_more_tasks_than_cores(spark):
    d = spark.range(1000).coalesce(1)
    assert tables.spread(d).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert tables.spread(d, 10).rdd.getNumPartitions() == 100 and tables.spread(d, 10).count() == 1000


def test_patterns_by_first_letter_are_found_in_the_same_texts():
    import random

    from winnowkit import fixed

    assert text.by_first_letter(r"(a|b)c|ad|\bae|\baf|a?g|ah*") == r"(a|b)c|a(?:d|h*)|\ba(?:e|f)|a?g"
    draw = random.Random(3)
    patterns = [v for v in vars(fixed).values() if isinstance(v, str) and "|" in v]
    words = [w for p in patterns for w in re.findall(r"[a-z+/&. 0-9]+", p)]
    texts = ["".join(draw.choice([draw.choice(words), draw.choice(words)[:-1], " ", "-", "b", "s"]) for _ in range(4)) for _ in range(3000)]
    for p in patterns:
        grouped = text.by_first_letter(p)
        found = [bool(re.search(p, t)) for t in texts]
        assert found == [bool(re.search(grouped, t)) for t in texts] and any(found)


def screened(spark):
    from winnowkit.operators import postings, rules

    rows = [
        {"ord": 1, "object_id": "a", "title": "Backend Engineer", "raw_title": "Senior Backend Engineer", "tools": ["Python"], "commitment": ["Full Time"], "comp_max": 200000, "comp_min": 150000},
        {"ord": 2, "object_id": "b", "title": "Data Analyst", "raw_title": "DATA ANALYST", "commitment": ["Full Time"], "role_type": "People Manager", "comp_max": 200000},
        {"ord": 3, "object_id": "c", "title": "Web Developer", "raw_title": "x", "commitment": ["Full Time"]}, {"ord": 4, "object_id": "d", "title": "Team Lead", "raw_title": "", "commitment": [], "role_type": "People Manager"},
        {"ord": 5, "object_id": "e", "title": "Clerk", "raw_title": "y", "tools": ["Solıdworks"], "requirements": "TOP ſecret", "commitment": ["Full Time"]},
    ]
    kinds = dict(c.strip().split(" ") for c in postings.POSTING_DDL.split(", "))
    names = ["object_id", "title", "raw_title", "tools", "commitment", "comp_max", "comp_min", "role_type", "requirements"]
    p = spark.createDataFrame([{c: r.get(c) for c in ["ord", *names]} for r in rows], "ord bigint, " + ", ".join(f"{c} {kinds[c]}" for c in names))
    return rules.screen(postings.conform(p))


def test_rules_run_once_a_posting(spark):
    from winnowkit.operators import rules

    s = screened(spark)
    got = {r.ord: (r.band, r.reject_reasons, r.demote_reasons) for r in s.collect()}
    assert got == {
        1: ("strong", [], []), 2: ("possible", [], ["uncorroborated people-manager flag", "analyst/research title"]), 3: ("rejected", ["full-stack/frontend title"], []),
        4: ("rejected", ["not full-time", "people manager"], []), 5: ("rejected", ["clearance in text", "non-software discipline"], []),
    }
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    sole, shown = rules.sole_reason_counts(s), rules.surfaced(s)
    assert {tuple(r) for r in sole.collect()} == {("full-stack/frontend title", 1)}
    assert sorted(r.ord for r in shown.collect()) == [1, 2]
    for d in (sole, shown):
        assert not [c for c in filters(d) if "RLIKE" in c or "CASE" in c or "expired" in c]
        assert plan(d).count("top secret") + plan(d).count("t(?:op secret") == 1


def test_a_member_meets_no_more_than_the_first_pairs_ask_for(spark):
    from itertools import combinations

    from winnowkit.operators import dedup

    members = {g: [(i, " ".join(f"w{(i * j + g) % 7}" for j in range(1, 4 + i % 3))) for i in range(n)] for g, n in enumerate((1, 2, 5, 6, 7, 9, 16, 17, 40))}
    d = spark.createDataFrame([(g, 100 * g + i, t) for g, m in members.items() for i, t in m], "g int, ord bigint, t string")
    for most in (15, 4, 1):
        got = {r.g: r.similarity for r in dedup.mean_similarity(d, "g", "t", max_pairs=most).collect()}
        for g, m in members.items():
            sets = [set(t.split()) for _, t in m]
            first = [len(a & b) / len(a | b) for a, b in list(combinations(sets, 2))[:most]]
            assert got[g] is None if not first else abs(got[g] - sum(first) / len(first)) < 1e-12, (most, g)
