"""The stages through the command line, from landed pages and captures to both pages, and what can go wrong."""

import json
import re

import pytest
from pyspark.sql import functions as F

from winnowkit import cli
from winnowkit.operators import capture, scrape
from winnowkit.plans import diagnostics, stages, summaries
from winnowkit.sources import captures, config, jsonl, pages, visitlog

TOML = """
[search]
searchstate_paths = ["a.json", "b.json"]
[home]
latitude = 38.9531
longitude = -77.4565
[location]
radius_miles = 30
excluded_states = ["Maryland"]
[filters]
excluded_sources = ["usagov"]
excluded_website_tlds = [".gov"]
[screen]
comp_floor = 100000
comp_min_floor = 50000
company_blocklist = [" Blocked Inc "]
[visit_logger]
export_path = "visits.json"
"""


def record(i, **over):
    job = {
        "core_job_title": "Backend Engineer", "company_name": f"Firm {i % 7}", "yearly_min_compensation": 90000, "yearly_max_compensation": 150000 + 1000 * i, "workplace_cities": ["Reston, Virginia, US"],
        "job_category": "Software Development", "commitment": ["Full Time"], "technical_tools": ["Python", "AWS"], "requirements_summary": " ".join(f"{w}{i}" for w in ("build", "run", "own", "ship")), "estimated_publish_date": f"2024-01-{i % 28 + 1:02d}", "seniority_level": "Senior Level",
    } | over.pop("job", {})
    return {
        "objectID": f"o{i}", "source": "grnhse", "apply_url": f"https://boards.example/firm{i % 7}/jobs/{i}", "is_expired": False, "job_information": {"title": "Senior Backend Engineer"},
        "enriched_company_data": {"name": f"Firm {i % 7}", "homepage_uri": f"https://www.firm{i % 7}.com/"}, "v5_processed_job_data": job, "_geoloc": [{"lat": 38.9586, "lon": -77.357}],
    } | over


@pytest.fixture
def home(tmp_path):
    (tmp_path / "c.toml").write_text(TOML)
    (tmp_path / "a.json").write_text('{"q": "x", "dateFetchedPastNDays": 21}')
    (tmp_path / "b.json").write_text('{"z": [1], "dateFetchedPastNDays": 21}')
    (tmp_path / "visits.json").write_text(json.dumps({"https://careers.firm1.com/x": {"date": "d", "r": True}, "firm1.com": {"date": "d", "r": True}, "job:o2": {"r": False}, "nohost": None}))
    return tmp_path


def run(capsys, *argv):
    code = cli.main([str(a) for a in argv])
    out, err = capsys.readouterr()
    told = json.loads(out) if code == 0 and out[:1] in "{[" else out
    if code == 0 and argv[0] != "urls":  # each command's result has a summary too
        said = summaries.lines(argv[0], told if isinstance(told, (dict, list)) else int(told))
        assert said and all(isinstance(line, str) and line.strip() for line in said)
    return code, told, err


def landed(records, search=0, page=0, **more):
    return {"search": search, "page": page, "build_id": "b1", "payload": {"pageProps": {"ssrHits": records, "ssrTotalCount": 40, "ssrCompanyCount": 7}}} | more


def write_lines(path, rows):
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\n\n")
    return path


def test_from_landed_pages_to_the_pages(spark, home, capsys):
    rows = [record(i) for i in range(20)] + [record(30, objectID="", id=None), record(31, is_expired=True), record(32, job={"yearly_max_compensation": 90000}), record(33, enriched_company_data={"name": "blocked inc"})]
    found = [landed(rows[:12]), landed(rows[10:], 0, 1), landed([], 0, 2), landed(rows[5:9], 1, 0), landed(rows[5:9], 1, 1), landed(rows[5:9], 1, 2), landed(rows[:1], 1, 3)]
    code, meta, _ = run(capsys, "land", write_lines(home / "pages.jsonl", found), home / "raw", "--config", home / "c.toml")
    assert code == 0 and meta["records"] == 24 and meta["unique_records"] == 23 and meta["keyless_records"] == 1
    assert [(s["pages_fetched"], s["stop_reason"], s["overlap"]) for s in meta["searches"]] == [(3, "empty page", 0), (3, "2 consecutive pages with no new records", 4)]
    assert meta["stop_reason"] == "0: empty page; 1: 2 consecutive pages with no new records" and meta["searches"][0]["reported_totals"]["ssrTotalCount"] == 40 and meta["searches"][1]["build_ids"] == ["b1"]
    raw = home / "raw" / "records"
    code, report, _ = run(capsys, "scrape-report", raw, home / "raw" / "meta.json")
    assert code == 0 and report["reported"] == {"records": 80, "companies": 14} and report["verdict"] == "thin" and report["records"] == 24 and report["days"][0]["bar"].startswith("#")

    (home / "raw-none").mkdir()
    code, meta, _ = run(capsys, "normalize", home / "r*" / "records", home / "n")
    assert code == 0 and meta["postings"] == 24 and not meta["overridden"]
    flat = spark.read.parquet(str(home / "n" / "postings")).orderBy("ord").collect()
    assert [(r.published_at, r.company) for r in flat] == sorted(((r.published_at, r.company) for r in flat), key=lambda x: ([-ord(c) for c in x[0]], x[1]))
    code, meta, _ = run(capsys, "screen", home / "n" / "postings", home / "s", "--config", home / "c.toml")
    assert code == 0 and meta["reject_reasons"]["blocked company"] == 1 and meta["reject_reasons"]["expired"] == 1 and meta["near_misses"] == 1
    screened = spark.read.parquet(str(home / "s" / "screened")).orderBy("ord").collect()
    assert [r.band for r in screened] == sorted((r.band for r in screened), key=["strong", "possible", "rejected"].index)
    strong = [r.comp_max for r in screened if r.band == "strong"]
    assert strong == sorted(strong, reverse=True) and strong

    code, dry, _ = run(capsys, "diff", home / "s" / "screened", home / "store", home / "d0", "--config", home / "c.toml", "--dry-run")
    assert code == 0 and dry["store_entries_after"] == 0 and stages.current_version(spark, str(home / "store")) is None
    code, one, _ = run(capsys, "diff", home / "s" / "screened", home / "store", home / "d1", "--config", home / "c.toml")
    assert code == 0 and one["new"] == len([r for r in screened if r.band != "rejected"]) == one["store_entries_after"] and one["suppressed"] == 0
    version = stages.current_version(spark, str(home / "store"))
    code, two, _ = run(capsys, "diff", home / "s" / "screened", home / "store", home / "d2", "--config", home / "c.toml")
    assert code == 0 and two["new"] == 1 and two["suppressed"] == one["new"] - 1 and two["opened"] == 1 and two["company_applied"] > 0
    assert stages.current_version(spark, str(home / "store")) > version
    code, rows_, _ = run(capsys, "render-shortlist", home / "d1" / "shortlist", home / "s.html", "--config", home / "c.toml", "--band", "strong")
    page = (home / "s.html").read_text()
    assert code == 0 and page.count("<tr class=") == int(rows_) and "strongest first" in page and page.count("resume sent") > 0 and "<th>Compensation</th>" in page

    code, meta, _ = run(capsys, "rollup", raw, home / "r", "--config", home / "c.toml")
    assert code == 0 and meta["companies"] == 7 and meta["dropped"]["expired"] == 1 and meta["tail_companies"] == 1
    code, meta, _ = run(capsys, "filter", home / "r" / "companies", home / "f", "--config", home / "c.toml")
    assert code == 0 and meta["excluded"] == 1 and meta["excluded_applied"] == 1 and meta["passthrough_no_website"] == 1 and meta["log"] == {"company": 2, "posting": 1, "unusable": 1}
    code, n, _ = run(capsys, "render-companies", home / "f" / "remaining", home / "c.html")
    page = (home / "c.html").read_text()
    assert code == 0 and int(n) == 6 == len(re.findall(r"<tr><td>\d", page)) and "nearest first" in page
    code, report, _ = run(capsys, "funnel", raw, "--config", home / "c.toml")
    assert code == 0 and report["records"] == 24 and report["rejected"] == 3 and report["near_misses"] == 1
    code, report, _ = run(capsys, "key-report", raw)
    assert code == 0 and (report["records"], report["with_key"], report["truth"]["groups"]) == (24, 0, 0) and report["threshold"] == 0.44
    assert [c["key"] for c in report["candidates"]][:2] == ["company, title", "company, title, cities"] and {s["keyed"] for s in report["skew"]} == {False}
    assert 0 < len(report["worst"]) <= 6 and all(w["similarity"] < 0.44 and w["n"] > 1 for w in report["worst"])


def test_summaries_say_what_a_stage_did(spark, home, capsys):
    code = cli.main(["--format", "text", "land", str(write_lines(home / "p.jsonl", [landed([record(1)]), landed([record(2)], 0, 1)])), str(home / "raw"), "--config", str(home / "c.toml"), "--max-pages", "1"])
    out = capsys.readouterr().out.splitlines()
    assert code == 0 and out[0] == "2 records over 2 pages, 2 with a key" and "  reported ssrTotalCount = 40" in out and any("page limit" in line for line in out)
    bands = {"screened": 8, "strong": 1, "possible": 3, "rejected": 4, "near_misses": 1, "reject_reasons": {"b": 1, "a": 1, "c": 4}, "demote_reasons": {}, "sole_reasons": {}}
    said = summaries.lines("screen", bands)
    assert said[1].split() == ["strong", "1", "12.5", "%"] and [line.split()[0] for line in said[-3:]] == ["c", "a", "b"] and "demoted for:" not in said
    assert summaries.lines("screen", bands | {"strong": 0, "possible": 0})[-1] == "warning: every posting was rejected"
    none = {"screened": 0, "strong": 0, "possible": 0, "rejected": 0, "near_misses": 0, "reject_reasons": {}, "demote_reasons": {}, "sole_reasons": {}}
    assert "warning" not in " ".join(summaries.lines("screen", none))
    assert summaries.lines("render-companies", 1200) == ["1,200 rows"]


def test_suffix_and_codec_agree(spark, tmp_path):
    d = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [jsonl.agreed(p, c) for p in ("x.jsonl", "x.jsonl.gz", "x.jsonl.gz/") for c in (True, False)] == ["x.jsonl.gz", "x.jsonl"] * 3
    for name, compress, made in (("a.jsonl", None, "a.jsonl"), ("b.jsonl.gz", None, "b.jsonl.gz"), ("c.jsonl", True, "c.jsonl.gz"), ("d.jsonl.gz", False, "d.jsonl")):
        path = jsonl.write(d, str(tmp_path / name), compress)
        parts = [p.name for p in (tmp_path / made).iterdir() if p.name.startswith("part-")]
        assert path == str(tmp_path / made) and parts and all(p.endswith(".json.gz" if made.endswith(".gz") else ".json") for p in parts)
        assert [r.line for r in jsonl.read(spark, path).orderBy("ord").collect()] == ['{"a":1,"b":null}', '{"a":2,"b":"x"}']


def capture_file(home, **over):
    state = {"dateFetchedPastNDays": 2, "q": "x"}
    entry = lambda state, page, at, records: {"searchState": state, "page": page, "captured_at": at, "payload": {"pageProps": {"ssrHits": records}}}
    entries = [entry(state, 0, "2024-03-01T10:00:00Z", [record(1)]), entry(state, 0, "2024-03-01T11:00:00Z", [record(2)]), entry(state, 2, "2024-03-01T19:30:00Z", [record(3)]), entry({"z": [1]}, 0, "no time", []), entry({"other": 1}, 0, "", [record(9)])]
    whole = {"format": "x-capture/1", "pages": entries, "ends": [{"searchState": state, "page": 2, "reason": "no next"}]} | over
    path = home / "capture.json"
    path.write_text(json.dumps(whole))
    return path


def test_import_of_a_capture(spark, home, capsys):
    (home / "old").mkdir()
    (home / "old" / "meta.json").write_text(json.dumps({"records": 5, "finished_at": "2024-02-20T10:00:00+00:00"}))
    (home / "bad").mkdir()
    (home / "bad" / "meta.json").write_text(json.dumps({"records": 5, "error": "x", "finished_at": "2024-02-29T10:00:00+00:00"}))
    code, meta, _ = run(capsys, "import", capture_file(home), home / "raw", "--config", home / "c.toml", "--previous-runs", f"{home}/*/meta.json")
    assert code == 0 and meta["records"] == 2 and [s["name"] for s in meta["searches"]] == ["a", "b"] and meta["searches"][1]["stop_reason"] == "empty page"
    a, b = meta["captures"]["a"], meta["captures"]["b"]
    assert a["complete"] and a["missing"] == [1] and a["window"] == 2 and a["span_hours"] == 8.5 and b["complete"] and b["span_hours"] == 0 and meta["skipped"] == ['{"other":1}']
    assert len(meta["warnings"]) == 3 and "10.0 days before" in " ".join(meta["warnings"]) and "missing pages [1]" in " ".join(meta["warnings"])
    got = sorted(json.loads(r.value)["objectID"] for r in spark.read.text(str(home / "raw" / "records")).collect())
    assert got == ["o2", "o3"]
    for over, said in (({"format": "other"}, "not a capture"), ({"pages": 1}, "isn't a list"), ({"pages": [{"searchState": {}, "page": 0}]}, "no search state"), ({"pages": [{"searchState": {"q": 1}, "page": True}]}, "valid number"), ({"pages": [{"searchState": {"q": 1}, "page": 1, "payload": {"pageProps": {"__N_REDIRECT": "/x"}}}]}, "redirect"), ({"ends": [{"page": 1}]}, "an end needs"), ({"pages": []}, "no captured pages")):
        code, _, err = run(capsys, "import", capture_file(home, **over), home / "raw2", "--config", home / "c.toml")
        assert code == 2 and said in err


def test_exit_codes(spark, home, capsys):
    bad = lambda *rows: write_lines(home / "bad.jsonl", rows)
    code, _, err = run(capsys, "land", bad(landed([record(1)]), {"search": 0, "page": 1, "status": 403, "mitigated": "challenge"}), home / "x")
    assert code == 3 and "challenge" in err
    meta = json.loads((home / "x" / "meta.json").read_text())
    assert meta["error"] and meta["records"] == 1 and (home / "x" / "records").exists()  # what came before the bad page
    for row, said in (({"status": 404}, "refused"), ({"status": 500}, "HTTP 500"), ({"payload": {"pageProps": {"__N_REDIRECT": "/"}}}, "redirected"), ({"payload": [1]}, "isn't an object"), ({"payload": {"pageProps": 3}}, "no usable pageProps"), ({"payload": None}, "isn't JSON")):
        code, _, err = run(capsys, "land", bad({"search": 0, "page": 0, "payload": {}} | row), home / "y")
        assert code == 1 and said in err, row
    (home / "broken.jsonl").write_text('{"a": 1}\n[2]\n')
    assert run(capsys, "normalize", home / "broken.jsonl", home / "z")[0] == 1
    assert run(capsys, "normalize", home / "none.jsonl", home / "z")[0] == 2 == run(capsys, "normalize", home / "none*.jsonl", home / "z")[0]
    assert run(capsys, "rollup", home / "broken.jsonl", home / "z", "--config", home / "none.toml")[0] == 2
    (home / "c2.toml").write_text(TOML.split("[visit_logger]")[0])
    assert run(capsys, "filter", home, home / "z", "--config", home / "c2.toml")[0] == 2
    code, out, _ = run(capsys, "urls", "https://site.example/", "--config", home / "c.toml")
    assert code == 0 and len(out.splitlines()) == 4 and out.startswith("daily a: https://site.example/classic?searchState=%7B%22q%22%3A%22x%22%2C%22dateFetchedPastNDays%22%3A2%7D")


@pytest.mark.parametrize(
    "text, said",
    [
        ("x = [", "c.toml"), ("[home]\nlatitude = 1", "lacks [search]"), ("[search]\nsearchstate_path = 1", "searchstate_path"), ("[search]\nsearchstate_paths = []", "searchstate_paths"),
        ('[search]\nsearchstate_path = "a"\nsearchstate_paths = ["b"]', "together"), ('[search]\nsearchstate_paths = ["a", "./a"]', "twice"), ('[search]\nsearchstate_path = "a"\n[screen]\ncomp_floor = 1.5', "whole"),
        ('[search]\nsearchstate_path = "a"\n[screen]\ncomp_floor = 10\ncomp_min_floor = 20', "above"), ('[search]\nsearchstate_path = "a"\n[screen]\ncompany_blocklist = [1]', "list of strings"), ('[search]\nsearchstate_path = "a"\n[home]\nlatitude = 91', "between"),
        ('[search]\nsearchstate_path = "a"\n[scrape]\nmax_pages = true', "whole"), ('[search]\nsearchstate_path = "a"\n[scrape]\ncompress = 1', "true or false"), ('[search]\nsearchstate_path = "a"\nstate = "b"', "no setting state"),
        ('[search]\nsearchstate_path = "a"\n[screens]\n', "no table"), ('[search]\nsearchstate_path = "a"\n[capture]\ndir = " "', "isn't empty"), ('[search]\nsearchstate_path = "a"\n[visit_logger]\nexport_path = 3', "must be a string"), ('search = 1', "must be a table"),
    ],
)
def test_configuration_errors(tmp_path, text, said):
    (tmp_path / "c.toml").write_text(text)
    with pytest.raises(config.ConfigError, match=re.escape(said)):
        config.load(tmp_path / "c.toml")


def test_configuration(home):
    c = config.load(home / "c.toml", ("search", "home"))
    assert [(s.name, s.window) for s in c.searches()] == [("a", 21), ("b", 21)] and c.blocked_companies == ("blocked inc",) and c.visit_log == home / "visits.json" and (c.comp_floor, c.max_pages, c.radius_miles) == (100000, 500, 30)
    for text in ("", "[]", "{}", "{"):
        (home / "a.json").write_text(text)
        with pytest.raises(config.ConfigError):
            c.searches()


def test_lines_keep_their_order(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        want = []
        for name, n in (("b", 300), ("a", 5), ("c", 120)):
            (tmp_path / f"{name}.jsonl").write_text("\n\n".join(json.dumps({"objectID": f"{name}{i}", "pad": "x" * (i * 7 % 50)}) for i in range(n)))
            want += [(name, i) for i in range(n)]
        found = jsonl.read(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 3
        got = [r.id for r in found.orderBy("ord").select(F.try_variant_get("record", "$.objectID", "string").alias("id")).collect()]
        assert got == [f"{name}{i}" for name, i in sorted(want)] and found.select("ord").distinct().count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "d.jsonl").write_text('{"a": 1}\n"x"\n')
    with pytest.raises(jsonl.BadRecord, match="d.jsonl"):
        jsonl.read(spark, str(tmp_path))
    assert jsonl.newest(spark, f"{tmp_path}/none*", missing_ok=True) is None
    assert jsonl.unique_path(spark, str(tmp_path / "a.jsonl")).endswith("a-2.jsonl")


def test_records_of_a_payload(spark):
    rows = [
        (0, '{"pageProps": {"zeta": [{"objectID": "Z"}], "alpha": [{"objectID": "A"}]}}'), (1, '{"zeta": [{"id": null}, 3], "alpha": [{"objectID": "A"}]}'), (2, '{"pageProps": {"ssrHits": [], "alpha": [{"objectID": "A"}]}}'),
        (3, '{"pageProps": {"ssrHits": [1, {"x": 2}], "nbA": 1, "Total": 2.5, "count": "3", "jobCount": true}}'), (4, '{"nbHits": 7}'),
    ]
    d = spark.createDataFrame(rows, "page int, payload string")
    got = sorted((r.page, r.j) for r in pages.records(d).select("page", F.to_json("record").alias("j")).collect())
    assert got == [(0, '{"objectID":"Z"}'), (1, '{"id":null}'), (3, '{"x":2}')]
    totals = {r.page: r.t for r in d.select("page", pages.reported_totals(F.col("payload")).alias("t")).collect()}
    assert totals[3] == {"nbA": 1.0, "Total": 2.5} and totals[4] == {"nbHits": 7.0} and totals[0] == {}
    with pytest.raises(Exception, match="no usable pageProps"):
        pages.records(spark.createDataFrame([(0, '{"pageProps": []}')], "page int, payload string")).collect()
    html = '<html><script id="__NEXT_DATA__" type="application/json">{"buildId": "b9", "props": {"pageProps": {"ssrHits": []}}, "page": "/classic"}</script>'
    assert spark.createDataFrame([(html,)], "h string").select(pages.next_data(F.col("h")).alias("d")).first().d.startswith('{"buildId"')
    with pytest.raises(Exception, match="carries no data"):
        spark.createDataFrame([("<html>",)], "h string").select(pages.next_data(F.col("h"))).collect()


def test_stop_reasons_and_totals(spark):
    landed_rows = spark.createDataFrame([(0, p, 0, f"k{p}") for p in range(4)], "search int, page int, pos int, key string")
    all_pages = spark.createDataFrame([(0, p) for p in range(4)], "search int, page int")
    reason = lambda ceiling: scrape.search_results(scrape.land(landed_rows, all_pages, max_pages=ceiling), all_pages, ceiling).first().asDict()
    assert reason(2) == {"search": 0, "pages_fetched": 3, "stop_reason": "reached max_pages=2"} and reason(9)["stop_reason"] == "no more pages"
    assert scrape.stop_reason([("a", "x")]) == "x" and scrape.stop_reason([]) == "unknown"
    told = spark.createDataFrame([(0, 0, {"t": 1.0}), (0, 1, {"t": 5.0}), (1, 0, {"t": 2.0, "u": 3.0})], "search int, page int, totals map<string,double>")
    found = scrape.totals(told)
    assert scrape.total_of(found, "t").first().total == 7 and scrape.total_of(found, "none").first().total is None
    assert diagnostics.sum_total(diagnostics.searches_of({"reported_totals": {"t": 3}}), "t") == 3 and diagnostics.searches_of({}) == []


def test_capture_states_and_visit_logs(spark, tmp_path):
    d = spark.createDataFrame([('{"dateFetchedPastNDays":2,"q":"x"}', 0), ('{"dateFetchedPastNDays":30,"q":"x"}', 1), ('{"q":"x","dateFetchedPastNDays":true}', 2)], "state string, pos int")
    known = captures.states(d)
    wanted = spark.createDataFrame([("a", captures.state_key({"q": "x", "dateFetchedPastNDays": 21}, "dateFetchedPastNDays")), ("b", "{}")], "name string, base string")
    got = {r["name"]: r["window"] for r in capture.match(wanted, known).collect()}
    assert got == {"a": 30, "b": None} and capture.unmatched(wanted, known).count() == 2
    (tmp_path / "v.json").write_text('{"A.com": {"date": "d", "r": true}, "b.com": {"r": "true"}, "job:X1": "text", "c.com": null}')
    log = visitlog.read(spark, str(tmp_path / "v.json"))
    assert {(r.key, r.applied) for r in log.collect()} == {("A.com", True), ("b.com", False), ("job:X1", False), ("c.com", False)} and visitlog.opened_postings(log).first().key == "job:X1"
    (tmp_path / "w.json").write_text("[1]")
    with pytest.raises(visitlog.BadVisitLog):
        visitlog.read(spark, str(tmp_path / "w.json"))


def test_a_store_as_json_lines(spark, tmp_path):
    from winnowkit.operators import seen

    rows = [{"object_id": "b", "keys": ["id:b"], "band": "strong", "first_surfaced": "d2", "company": "B", "surfaced_count": 3, "opened": True}, {"object_id": "a", "first_surfaced": "d1"}]
    found = seen.from_records(jsonl.read(spark, str(write_lines(tmp_path / "store.jsonl", rows))))
    by = {r.object_id: r for r in found.collect()}
    assert (by["a"]["keys"], by["a"].band, by["a"].surfaced_count, by["a"].opened, by["a"].company) == ([], "possible", 1, False, "") and by["b"].opened
    lines = [json.loads(r.value) for r in seen.to_lines(found).collect()]
    assert [x["object_id"] for x in lines] == ["a", "b"] and lines[1]["keys"] == ["id:b"] and "put_seq" not in lines[0]
    assert sorted(seen.from_records(jsonl.read(spark, str(write_lines(tmp_path / "again.jsonl", lines)))).drop("put_seq").collect()) == sorted(found.drop("put_seq").collect())
