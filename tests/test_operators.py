"""The operators on small tables: golden cases, odd values, and plain-Python models."""

import re
import random
import statistics

import pytest
from pyspark.sql import functions as F

from winnowkit.functions import careers, geo, guards, hosts, keys, text
from winnowkit.operators import capture, dedup, graph, postings, rollup, rules, scrape, seen, visited


def values(spark, column, rows, ddl="x string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], "i int, " + ddl)
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_hosts(spark):
    cases = {
        "ionq.com": "ionq.com", "https://www.IonQ.com/careers?x=1": "ionq.com", " http://user@a.b.co:8080/x ": "a.b.co", "www.Acme.com/": "acme.com", "localhost": None,
        "": None, None: None, "job:abc": None, ".example.org.": "example.org", "//x.y#z": "x.y", " a.b ": "a.b", "a b.com/x": "a b.com",
    }
    assert values(spark, hosts.normalize_host(F.col("x")), list(cases)) == list(cases.values())
    pairs = [("appian.com", "careers.appian.com"), ("appian.com", "notappian.com"), ("a.com", "a.com"), (None, "a.com"), ("b.a.com", "a.com")]
    assert values(spark, hosts.covers(F.col("x"), F.col("y")), pairs, "x string, y string") == [True, False, True, False, False]
    got = hosts.covered_by(spark.createDataFrame([("c.a.com",), ("a.com",), (None,)], "h string"), "h", spark.createDataFrame([("a.com",), (None,)], "o string"), "o")
    assert sorted(map(tuple, got.collect())) == [("a.com", "a.com"), ("c.a.com", "a.com")]
    assert "NestedLoop" not in got._jdf.queryExecution().toString()


def test_careers_links(spark):
    cases = [
        (("https://job-boards.vendor.example/firm/jobs/123?x=1", "grnhse"), ("https://job-boards.vendor.example/firm/", "host_and_segments")),
        (("https://v.example/Org/Site/9", " SilkRoad "), ("https://v.example/Org/Site/", "host_and_segments")),
        (("https://v.example/Org", "silkroad"), ("https://v.example/", "host")),
        (("https://t.example/careersection/requisition.jsp?org=A&cws=37&rid=5", "taleo_rss"), ("https://t.example/careersection/jobSearch.jsp?org=A&cws=37", "board")),
        (("https://p.example/r.html?cid=a%20b&ccId=&jobId=4", "adp"), ("https://p.example/r.html?cid=a+b", "board")),
        (("https://s.example/ta/x.careers?ShowJob=1", "saashr"), ("https://s.example/ta/x.careers", "board")),
        (("https://o.example/en/sites/CX_1/job/3", "oraclecloud"), ("https://o.example/en/sites/CX_1/requisitions", "host_and_segments")),
        (("https://o.example/en/job/3", "oraclecloud"), ("https://o.example/en/job/3", "posting")),
        ((" https://b.example/x?p=1", "brassring"), (" https://b.example/x?p=1", "posting")),
        (("https://g.example:99/a/b", "gusto"), ("https://g.example:99/", "host")),
        (("ftp://g.example/a", "gusto"), (None, "none")), (("", "x"), (None, "none")), ((None, None), (None, "none")),
    ]
    got = values(spark, careers.careers_link(F.col("x"), F.col("y")), [c for c, _ in cases], "x string, y string")
    assert [(g.url, g.tier) for g in got] == [w for _, w in cases]
    pairs = [("https://jobs.firm.com/a", "www.firm.com"), ("https://boards.vendor.example/firm", "firm.com"), (None, "firm.com"), ("https://x.com", None)]
    assert values(spark, careers.entry_url(F.col("x"), F.col("y")), pairs, "x string, y string") == ["https://jobs.firm.com/a", "https://firm.com", "https://firm.com", None]


def test_text_functions(spark):
    titles = {"Senior Engineer II": "ii+sr", "Engineer L4": "4", "Sr. Dev (Jr)": "jr+sr", "Engineer 1.5, Staff": "1.5+staff", "Engineer": "", None: "", "Tier 1-3 Eng 2_5": "1+2.5+3"}
    got = values(spark, text.level_signature(F.col("x")), list(titles))
    assert got[:6] == list(titles.values())[:6]
    pairs = [("a b c", "b c d"), ("", "a"), ("A+ b#", "a+ B#"), (None, "x")]
    assert values(spark, text.jaccard(text.tokens(F.col("x")), text.tokens(F.col("y"))), pairs, "x string, y string") == [0.5, 0.0, 1.0, 0.0]
    assert values(spark, text.html_escape(F.col("x")), ["<a & 'b'>\"", None]) == ["&lt;a &amp; &#x27;b&#x27;&gt;&quot;", ""]
    assert values(spark, text.url_quote(F.col("x")), ["a b*~/"]) == ["a+b%2A~%2F"]
    dates = ["2024-01-02", "", "2024-01-01", "2024", None]
    order = spark.createDataFrame([(d,) for d in dates], "d string").orderBy(keys.newest_first(F.col("d")), "d").collect()
    assert [r.d for r in order][2:] == ["2024", "2024-01-02", "2024-01-01"]  # undated first, a prefix before what it begins


def test_places(spark):
    points = "array<struct<lat:double,lon:double,lng:double>>"
    df = spark.createDataFrame([(["Reston, Virginia, US", " ", "College Park, Maryland, US", "Nowhere"], [(38.9586, 0.0, -77.3570), (1.0, 1.0, None), (38.9897, -76.9378, None)])], f"l array<string>, p {points}")
    found = geo.near(geo.places(F.col("l"), F.col("p")), 38.9531, -77.4565, 30, ["maryland"])
    got = df.select(found.alias("v")).first().v
    assert [(p.label, p.state) for p in got] == [("Reston, Virginia, US", "Virginia"), ("Nowhere", None)] and 5 < got[0].distance_miles < 6 and got[1].distance_miles is None


def test_type_guards(spark):
    docs = ['{"a": 5}', '{"a": "5"}', '{"a": true}', '{"a": null}', "{}", '{"a": 2.9}', '{"a": [" x ", 3, "", "y"]}']
    v = F.parse_json("x")
    assert values(spark, guards.text_at(v, "$.a"), docs) == [None, "5", None, None, None, None, None]
    assert values(spark, guards.int_at(v, "$.a"), docs) == [5, None, None, None, None, 2, None]
    assert values(spark, guards.true_at(v, "$.a"), docs) == [False, False, True, False, False, False, False]
    assert values(spark, guards.strings_at(v, "$.a"), docs)[-2:] == [[], ["x", "y"]]


RAW = '{"objectID": "%s", "source": "grnhse", "apply_url": "https://x.example/firm/1", "job_information": {"title": "Senior Engineer"}, "v5_processed_job_data": {"core_job_title": "Engineer", "company_name": "P", "workplace_cities": ["Reston, Virginia, US"], "yearly_max_compensation": %s, "commitment": ["Full Time"], "technical_tools": ["Python"], "estimated_publish_date": "2024-01-01"}, "enriched_company_data": {"name": "Acme", "homepage_uri": "www.Acme.com/", "nb_employees": 5}, "_geoloc": [{"lat": 38.9586, "lon": -77.357}]}'


def test_projection_and_rollup(spark):
    lines = [(0, RAW % ("a", "190000")), (1, RAW % ("b", '"190000"')), (2, RAW % ("c", "900000")), (3, "{}"), (4, '{"objectID": 7, "v5_processed_job_data": []}')]
    records = spark.createDataFrame(lines, "ord bigint, line string").select("ord", F.parse_json("line").alias("record"))
    flat = {r.ord: r for r in postings.project(records).collect()}
    assert [flat[i].comp_max for i in range(3)] == [190000, None, None] and [flat[i].comp_implausible for i in range(3)] == [False, False, True]
    assert flat[0].company_host == "acme.com" and flat[0].raw_title == "Senior Engineer" and flat[3].company == "(unknown)" and flat[4].object_id == ""
    assert flat[0].fallback_key == "Acme|engineer|Reston, Virginia, US"
    with pytest.raises(postings.SchemaDrift):
        postings.conform(spark.range(1).withColumn("new_field", F.lit(1)).drop("id"))
    judged = rollup.judged(rollup.company_inputs(records), rollup.Rollup(38.9531, -77.4565, 30))
    assert {r.drop_reason: r.n for r in rollup.drop_counts(judged).collect()} == {"kept": 3, "unidentifiable": 2}
    (c,) = rollup.companies(judged).collect()
    assert (c.key, c.name, c.posting_count, c.careers_url, c.locations, c.sample_titles, c.profile) == ("acme.com", "Acme", 3, "https://x.example/firm/", ["Reston, Virginia, US"], ["Engineer"], '{"nb_employees":5}')


def posting_rows(spark, changes):
    base = {"title": "Backend Engineer", "raw_title": "Senior Backend Engineer", "company": "Acme", "company_host": "acme.com", "comp_min": 190000, "comp_max": 220000, "tools": ["Java", "AWS"], "commitment": ["Full Time"], "security_clearance": "None", "source": "lever", "requirements": "", "certifications": []}
    fields = {p.strip().split(" ")[0]: p.strip().split(" ")[1] for p in postings.POSTING_DDL.split(", ")}
    used = sorted(set(base) | {k for c in changes for k in c})
    ddl = "ord bigint, " + ", ".join(f"{k} {fields[k]}" for k in used)
    rows = [(i, *[(base | c).get(k) for k in used]) for i, c in enumerate(changes)]
    return postings.conform(spark.createDataFrame(rows, ddl))


def test_screening(spark):
    changes = [
        {}, {"comp_max": 100_000}, {"is_expired": True, "source": "USAgov"}, {"tools": ["JavaScript"]}, {"title": "Data Scientist"}, {"title": "Data Scientist Engineer"}, {"role_type": "People Manager"},
        {"role_type": "People Manager", "requirements": "has direct reports"}, {"security_clearance": None, "requirements": "TS/SCI needed"}, {"comp_min": 1, "city_count": 5}, {"company_host": "x.gov", "commitment": []},
    ]
    got = {r.ord: (r.band, r.reject_reasons, r.demote_reasons, r.near_miss) for r in rules.screen(posting_rows(spark, changes)).collect()}
    assert got[0] == ("strong", [], [], False) and got[1] == ("rejected", ["comp below floor"], [], True)
    assert got[2][1] == ["expired", "public-sector source"] and got[3][0] == "possible" and got[4][2] == ["analyst/research title"] and got[5][0] == "strong"
    assert got[6][2] == ["uncorroborated people-manager flag"] and got[7][1] == ["people manager"] and got[8][1] == ["clearance in text"]
    assert got[9][2] == ["band bottom below floor", "geo-tiered pay band"] and got[10][1] == ["gov/mil/edu domain", "not full-time"]


def test_exclusive_percentile(spark):
    rnd = random.Random(1)
    for n in (2, 10, 12, 57, 400):
        xs = [round(rnd.random(), 2) for _ in range(n)]
        got, count = dedup.exclusive_percentile(spark.createDataFrame([(x,) for x in xs], "v double"), "v")
        assert count == n and got == pytest.approx(statistics.quantiles(xs, n=100)[9])
    assert dedup.exclusive_percentile(spark.createDataFrame([(None,)], "v double"), "v") == (None, 0)


@pytest.mark.parametrize(("most", "heads"), [(1024, 32), (6, 3)])
def test_greedy_groups(spark, most, heads):
    rnd = random.Random(2)
    rows = [(i, rnd.choice("xy"), " ".join(rnd.sample("abcdefgh", rnd.randint(0, 5))), rnd.choice(["sr", ""])) for i in range(160)]
    df = spark.createDataFrame(rows, "ord bigint, g string, t string, l string").repartition(3)
    got = {r.ord: r.anchor for r in dedup.greedy_groups(df, ["g"], "t", F.col("l"), 0.5, most=most, heads=heads).collect()}
    anchors, want = {}, {}
    for i, g, t, level in rows:
        w = set(t.split())
        hit = next((a for a, la, wa in anchors.get(g, []) if la == level and w and wa and len(w & wa) / len(w | wa) >= 0.5), None)
        if hit is None:
            anchors.setdefault(g, []).append((i, level, w))
        want[i] = i if hit is None else hit
    assert got == want


def test_a_hundred_thousand_unlike_sets_of_one_key(spark):
    """Families of five sets of ten tokens; a family's first is like the next three of it, and its fifth like none."""
    n = 100_000
    own = lambda family, changed: F.concat_ws(" ", *[F.concat(F.lit(f"t{j}x" if j >= 2 * changed else f"c{changed}y{j}x"), family.cast("string")) for j in range(10)])
    family, nth = F.floor(F.col("id") / 5), F.col("id") % 5
    text = F.when(nth == 0, own(family, 0)).when(nth == 4, own(family, 4)).otherwise(own(family, 1))
    rows = spark.range(n).select(F.col("id").alias("ord"), F.lit("k").alias("g"), F.concat_ws(" ", text, F.concat(F.lit("u"), (F.col("id") % 7).cast("string"))).alias("t"))
    got = dedup.greedy_groups(rows, ["g"], "t", F.lit(""), 0.5)
    want = F.when((F.col("ord") % 5).between(1, 3), F.floor(F.col("ord") / 5) * 5).otherwise(F.col("ord"))
    assert got.count() == n and got.where(F.col("anchor") != want).count() == 0


def alike_and_unlike(n, seed):
    """(id, tokens) of sets of 1 to some 400 tokens, frequent ones and rare ones, with near copies of earlier sets at all distances."""
    rnd, sets = random.Random(seed), []
    for i in range(n):
        if sets and rnd.random() < 0.4:
            w = set(rnd.choice(sets)[1])
            w = {t for t in w if rnd.random() > rnd.choice([0, 0.1, 0.35])} | {rnd.randrange(50) for _ in range(rnd.randint(0, 1 + len(w) // 3))}
        else:
            w = {int(rnd.paretovariate(0.35)) % 4001 for _ in range(rnd.choice([1, 3, 20, 60, 120, 500]))}
        sets.append((i, sorted(w or {7})))
    return sets


def greedily(sets, threshold):
    anchors, out = [], {}
    for i, w in sets:
        w = set(w)
        out[i] = next((a for a, x in anchors if len(w & x) / (len(w) + len(x) - len(w & x)) >= threshold), i)
        if out[i] == i:
            anchors.append((i, w))
    return out


@pytest.mark.parametrize(("threshold", "block", "room"), [(0.44, 1 << 15, 1 << 23), (0.44, 90, 1 << 23), (0.6, 1 << 15, 4000), (1.0, 150, 1 << 23), (0.05, 70, 1 << 23)])
def test_anchors_of_long_and_short_sets(spark, threshold, block, room):
    sets = {g: alike_and_unlike(400, seed) for g, seed in (("x", 1), ("y", 2))}
    rows = [(g, 2 * i + (g == "y"), w) for g, s in sets.items() for i, w in s]
    got = {r.id: r.anchor for r in dedup.anchors_by_rounds(spark.createDataFrame(rows, "g string, id bigint, w array<bigint>").repartition(3), threshold, block, room).collect()}
    want = {2 * i + (g == "y"): 2 * a + (g == "y") for g, s in sets.items() for i, a in greedily(s, threshold).items()}
    assert got == want


def test_token_sets_are_written_once(spark, monkeypatch):
    """A group that a task can hold is folded from the one table of token sets, whatever else has the same tokens."""
    sets, written = alike_and_unlike(1500, 3), []
    write = dedup.settle
    monkeypatch.setattr(dedup, "settle", lambda df, name, *more: (written.append((name, [c for c, t in df.dtypes if t == "array<bigint>"])), write(df, name, *more))[1])
    rows = spark.createDataFrame([(i, "k", " ".join(f"t{t}" for t in w)) for i, w in sets], "ord bigint, g string, t string")
    got = {r.ord: r.anchor for r in dedup.greedy_groups(rows, ["g"], "t", F.lit(""), 0.44).collect()}
    assert got == greedily(sets, 0.44) and [name for name, columns in written if columns] == ["token-sets"]


def test_thresholds_at_the_ends(spark):
    sets = spark.createDataFrame([("g", 3, [1, 2]), ("g", 1, [5]), ("h", 7, [9])], "g string, id bigint, w array<bigint>")
    assert {tuple(r) for r in dedup.anchors_by_rounds(sets, 0.0).collect()} == {(3, 1), (1, 1), (7, 7)}
    assert {tuple(r) for r in dedup.anchors_by_rounds(sets, 1.5).collect()} == {(3, 3), (1, 1), (7, 7)}


def test_merge_keeps_the_best_listing(spark):
    rows = posting_rows(spark, [{"object_id": "a", "source": "adhoc", "published_at": "2024-03-01", "apply_url": "u1"}, {"object_id": "b", "published_at": "2024-01-01", "apply_url": "u2"}, {"object_id": "c", "published_at": "2024-02-01", "apply_url": "u1"}])
    (r,) = dedup.merge(rows.withColumn("cluster_key", F.lit("k")), "cluster_key").collect()
    assert (r.object_id, r.duplicate_count, r.alternate_object_ids, r.alternate_apply_urls) == ("c", 3, ["a", "b"], ["u1", "u2"])


def test_landing_follows_the_stop_rule(spark):
    rnd = random.Random(4)
    for _ in range(3):
        rows = [(s, p, i, rnd.choice([None, *"abcdefg"])) for s in range(2) for p in range(8) for i in range(rnd.randint(0, 3))]
        pages = [(s, p) for s in range(2) for p in range(8)]
        got = scrape.land(spark.createDataFrame(rows, "search int, page int, pos int, key string"), spark.createDataFrame(pages, "search int, page int"))
        got = {(r.search, r.page, r.pos): (r.is_new, r.written) for r in got.collect()}
        want, written = {}, set()
        for s in range(2):
            own, empty = set(), 0
            for p in range(8):
                here = [r for r in rows if r[0] == s and r[1] == p]
                fresh = 0
                for _, _, i, k in here:
                    new = k is None or k not in own
                    own.add(k)
                    want[(s, p, i)] = (new, new and (k is None or k not in written))
                    written.add(k)
                    fresh += new
                empty = 0 if fresh else empty + 1
                if not here or empty == 2:
                    break
        assert got == want


def test_captures(spark):
    pages = spark.createDataFrame([("s", 0, "2024-01-01T00:00:00Z", 0, "old"), ("s", 0, "2024-01-01T06:00:00Z", 1, "new"), ("s", 3, "2024-01-01T12:00:00Z", 2, "x"), ("s", 3, "2024-01-01T12:00:00Z", 3, "tie")], "state string, page bigint, captured_at string, pos int, v string")
    latest = capture.latest_pages(pages)
    assert {r.page: r.v for r in latest.collect()} == {0: "new", 3: "tie"}
    (s,) = capture.summary(latest).collect()
    assert (s.pages, s.last_page, s.missing, s.span_hours) == (2, 3, [1, 2], 6.0)


def test_visit_log(spark):
    log = spark.createDataFrame([("https://www.a.com/x", True), ("a.com", False), ("job:1", True), ("nohost", None)], "key string, applied boolean")
    firms = spark.createDataFrame([("A", "a.com"), ("B", "b.com"), ("C", None)], "name string, website_host string")
    assert sorted(r.name for r in visited.remaining(firms, log).collect()) == ["B", "C"]
    assert [(r.name, r.applied) for r in visited.excluded(firms, log).collect()] == [("A", True)]
    assert visited.filter_counters(firms, log).first().asDict() == {"companies": 3, "kept": 2, "excluded": 1, "excluded_applied": 1, "kept_unmatchable": 1}
    rows = spark.createDataFrame([("a.com",), ("b.com",), (None,)], "company_host string")
    hosts_ = spark.createDataFrame([("careers.a.com",)], "host string")
    assert {r.company_host: r.company_applied for r in visited.applied_companies(rows, hosts_).collect()} == {"a.com": True, "b.com": False, None: False}


class Store:
    """The sequential store, as a model."""

    def __init__(self):
        self.entries, self.index = {}, {}

    def put(self, e):
        self.entries.pop(e["id"], None)
        self.entries[e["id"]] = e
        for k in e["keys"]:
            self.index[k] = e["id"]

    def find(self, ks):
        return next((self.entries[self.index[k]] for k in ks if k in self.index), None)


def test_seen_store_against_the_model(spark):
    rnd = random.Random(7)
    rank = {"strong": 2, "possible": 1}
    for _ in range(3):
        model, store = Store(), graph.durable(seen.empty_store(spark))
        for run in range(3):
            made = Store()  # a run reads the store as it was written: by first surfacing and company, then as they were put
            for e in sorted(model.entries.values(), key=lambda e: (e["first"], e["company"])):
                made.put(e)
            model = made
            rows = [
                {"object_id": f"o{run}-{i}", "alternate_object_ids": [f"o{rnd.randint(0, 2)}-{rnd.randint(0, 14)}" for _ in range(rnd.randint(0, 2))], "cluster_key": f"c{rnd.randint(0, 12)}" if rnd.random() < 0.5 else None, "company": rnd.choice("XYZ")}
                for i in range(14)
            ]
            rows.append({"object_id": "", "alternate_object_ids": [], "cluster_key": None, "company": "X"})  # known under nothing
            bands = [rnd.choice(["strong", "possible", "possible", "rejected"]) for _ in rows]
            df = posting_rows(spark, rows)
            df = df.join(spark.createDataFrame(list(enumerate(bands)), "ord bigint, band string"), "ord")
            judged = graph.durable(seen.classify(df, store))
            actions = {r.ord: r.action for r in judged.collect()}
            shown, hidden, want = [], [], {}
            for i, (r, b) in enumerate(zip(rows, bands, strict=True)):
                if b == "rejected":
                    continue
                ks = sorted({f"id:{x}" for x in [r["object_id"], *r["alternate_object_ids"]] if x} | ({f"cluster:{r['cluster_key']}"} if r["cluster_key"] else set()))
                known = model.find(ks)
                want[i] = "new" if known is None else "promoted" if rank[b] > rank[known["band"]] else "suppressed"
                (hidden if want[i] == "suppressed" else shown).append((r, b, ks))
            assert actions == want
            day = f"d{run}"
            for r, b, ks in shown:
                e = model.find(ks)
                if e is None:
                    model.put({"id": r["object_id"], "keys": ks, "band": b, "first": day, "last": day, "n": 1, "company": r["company"]})
                else:
                    model.put(e | {"keys": sorted({*e["keys"], *ks}), "band": max(e["band"], b, key=rank.get), "last": day, "n": e["n"] + 1})
            for _, _, ks in hidden:
                e = model.find(ks)
                if e is not None:
                    model.put(e | {"keys": sorted({*e["keys"], *ks})})
            store = graph.durable(seen.merge(store, judged, day))
            got = [(r.object_id, (r["keys"], r.band, r.first_surfaced, r.last_surfaced, r.surfaced_count, r.company)) for r in seen.in_order(store).collect()]
            assert [k for k, _ in got] == [e["id"] for e in sorted(model.entries.values(), key=lambda e: (e["first"], e["company"]))]
            assert dict(got) == {k: (e["keys"], e["band"], e["first"], e["last"], e["n"], e["company"]) for k, e in model.entries.items()}


def test_sequences_of_links_are_followed_to_their_end(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (700, 700)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_white_space_is_trimmed_without_a_pattern(spark):
    """All of Unicode's white space, at both ends alone; a pattern that tries every place of a text took most of a record's time."""
    from winnowkit.functions import text

    spaces = [chr(i) for i in range(0x3100) if re.fullmatch(r"\s", chr(i)) and not 0x1C <= i <= 0x1F]
    d = spark.createDataFrame([(c + "a" + c + c + "B" + c + "\n",) for c in spaces] + [("a b",), ("".join(spaces),), (None,)], "t string")
    got = d.select("t", text.strip(F.col("t")).alias("s"), text.squeeze(F.col("t")).alias("q"))
    rows = got.collect()
    assert len(spaces) == 25 and [(r.s, r.q) for r in rows] == [(f"a{c}{c}B", "a b") for c in spaces] + [("a b", "a b"), ("", ""), (None, None)]
    assert "regexp" not in d.select(text.strip(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_lines_that_begin_with_a_brace_are_known_by_it(spark):
    from winnowkit.sources import jsonl

    lines = [' {"a":1}', "[1]", '"x"', "null", "{", "{} x", "x {}", "\t{}", "\x0b{}", "{a:1}", "﻿[]"]
    d = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, ord int, line string").withColumn("record", F.try_parse_json("line"))
    whole = d.where(F.col("record").isNull() | ~F.startswith(F.schema_of_variant("record"), F.lit("OBJECT")))
    bad = jsonl.malformed(d)
    assert sorted(r.ord for r in bad.collect()) == sorted(r.ord for r in whole.collect())
    assert "RLIKE" in bad._jdf.queryExecution().analyzed().toString().upper()


def test_large_groups_write_no_pairs(spark, monkeypatch):
    """What the rounds write is the sets that are left, however many share their tokens."""
    rnd, n = random.Random(3), 120
    sets = [("g", i, sorted(rnd.sample(range(40), 20))) for i in range(n)]
    sizes, write = [], dedup.settle
    monkeypatch.setattr(dedup, "settle", lambda df, name, *a: (out := write(df, name, *a), sizes.append((name, out.count())))[0])
    got = {r.id: r.anchor for r in dedup.anchors_by_rounds(spark.createDataFrame(sets, "g string, id bigint, w array<bigint>"), 0.44, 40).collect()}
    anchors, want = [], {}
    for _, i, w in sets:
        found = next((a for a, t in anchors if len(t & {*w}) / len(t | {*w}) >= 0.44), None)
        want[i] = i if found is None else found
        if found is None:
            anchors.append((i, {*w}))
    assert got == want and len(anchors) > 3 and max(size for _, size in sizes) <= n
