"""The page source: what it reads, when it stops, and what it does when pages don't come."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from winnowkit import fixed
from winnowkit.plans import stages
from winnowkit.sources import fetch, pages

HERE = f"{__name__}:scripted"


def page(*ids):
    return json.dumps({"pageProps": {"ssrHits": [{"objectID": i} for i in ids], "ssrTotalCount": 9}})


def rendered(text, build="b1", name="/jobs/"):
    return f"<html>{fixed.PAGE_DATA_OPEN}{json.dumps({'buildId': build, 'page': name, 'props': json.loads(text)})}{fixed.PAGE_DATA_CLOSE}"


def scripted(options):
    """A transport that plays a search's script: (path or None, reply or error) one after the other."""
    at = {}

    def ask(path, params):
        state = json.loads(params["searchState"])
        n = at[state["name"]] = at.get(state["name"], -1) + 1
        want, got = state["script"][n]
        assert want in (None, f"{path} {params.get('page', '')}".strip()), (want, path, params)
        if isinstance(got, str) and got.startswith("error"):
            raise ConnectionError(got)
        status, text, *more = got
        return fetch.Reply(status, text, *more)

    return ask


def read(spark, *scripts, **options):
    searches = [{"name": i, "script": s} for i, s in enumerate(scripts)]
    return fetch.fetch(spark, searches, HERE, **{"backoff": 0, "max_pages": 9} | options)


def rows(df):
    return [(r.search, r.page, r.build_id, r.status, r.problem) for r in df.orderBy("search", "page").collect()]


def ok(*ids):
    return (200, page(*ids))


def test_pages_are_read_until_the_search_ends(spark):
    data = "/_next/data/b1/jobs.json"
    a = [("/", (200, rendered(page("a", "b")))), (f"{data} 1", ok("c")), (f"{data} 2", ok("a")), (f"{data} 3", ok("b", "c"))]  # twice nothing new
    b = [("/", (200, rendered(page("x")))), (f"{data} 1", ok())]  # an empty page
    c = [("/", (200, rendered(page("x")))), (f"{data} 1", ok("y")), (f"{data} 2", ok("z"))]
    got = rows(read(spark, a, b, c, max_pages=2))
    assert got == [(0, 0, "b1", 200, None), (0, 1, "b1", 200, None), (0, 2, "b1", 200, None), (1, 0, "b1", 200, None), (1, 1, "b1", 200, None), *[(2, i, "b1", 200, None) for i in range(3)]]
    assert len(rows(read(spark, a))) == 4 and rows(read(spark)) == []


def test_replies_that_fail_for_now_and_builds_that_go_stale(spark):
    again = [("/", "error 1"), ("/", (503, "")), ("/", (200, rendered(page("a")))), (None, (500, "")), (None, ok("b")), (None, ok())]
    stale = [
        ("/", (200, rendered(page("a")))), ("/_next/data/b1/jobs.json 1", (404, "")), ("/", (200, rendered(page("a"), "b2", "/"))), ("/_next/data/b2/index.json 1", (200, "<html>")),
        ("/", (200, rendered(page("a"), ""))), ("/_next/data/b2/jobs.json 1", ok("b")), ("/_next/data/b2/jobs.json 2", ok()),
    ]
    assert rows(read(spark, again, stale)) == [*[(0, i, "b1", 200, None) for i in range(3)], (1, 0, "b1", 200, None), (1, 1, "b2", 200, None), (1, 2, "b2", 200, None)]
    moved = [("/", (200, rendered(page("a")))), *[x for _ in range(2) for x in ((None, (200, json.dumps({"pageProps": {fixed.REDIRECT_FIELD: "/"}}))), ("/", (200, rendered(page("a")))))], (None, (404, "gone"))]
    dead = [("/", "error 1"), ("/", "error 2"), ("/", "error 3")]
    assert rows(read(spark, moved, dead)) == [(0, 0, "b1", 200, None), (0, 1, "b1", 404, None), (1, 0, None, None, "no reply: error 3")]


def test_what_came_before_a_bad_page_is_landed(spark, tmp_path):
    first = ("/", (200, rendered(page("a", "b"))))
    searches = [[first, (None, ok("c")), (None, (403, "", "challenge"))], [("/", (200, rendered(page("b", "d")))), (None, ok())], [("/", (500, ""))] * 3]
    with pytest.raises(pages.Blocked, match="search 0, page 2"):
        stages.land(spark, read(spark, *searches), str(tmp_path / "run"), False, 9, ["one", "two", "three"])
    meta = json.loads((tmp_path / "run" / "meta.json").read_text())
    assert meta["records"] == 4 and meta["jobs_file"] == "records" and "challenge" in meta["error"] and meta["stop_reason"].startswith("one: error; two: empty page; three: error")
    assert [(s["pages_fetched"], "error" in s) for s in meta["searches"]] == [(2, True), (2, False), (0, True)]
    assert sorted(json.loads(r.value)["objectID"] for r in spark.read.text(str(tmp_path / "run" / "records")).collect()) == ["a", "b", "c", "d"]
    with pytest.raises(pages.BadPage, match="HTTP 500, 3 times"):
        stages.land(spark, read(spark, [("/", (500, ""))] * 3), str(tmp_path / "none"), False, 9)
    meta = json.loads((tmp_path / "none" / "meta.json").read_text())
    assert meta["records"] == 0 and meta["jobs_file"] is None and not (tmp_path / "none" / "records").exists()


class Site(BaseHTTPRequestHandler):
    asked = []

    def do_GET(self):
        url = urlparse(self.path)
        q = parse_qs(url.query)
        Site.asked.append((url.path, q.get("page"), self.headers["User-Agent"]))
        n = int(q.get("page", ["0"])[0])
        text = rendered(page("p0")) if url.path == "/" else page(f"p{n}") if n < 3 else page()
        self.send_response(200 if n < 9 else 418)
        self.end_headers()
        self.wfile.write(text.encode())

    def log_message(self, *args):
        pass


def test_over_http(spark, tmp_path):
    server = HTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        df = fetch.fetch(spark, [{"q": "ä"}], base_url=f"http://127.0.0.1:{server.server_port}/", user_agent="test", max_pages=9)
        meta = stages.land(spark, df, str(tmp_path / "run"), True, 9)
    finally:
        server.shutdown()
    assert (meta["records"], meta["pages_fetched"], meta["stop_reason"]) == (3, 4, "empty page")
    assert Site.asked[0] == ("/", None, "test") and Site.asked[1] == ("/_next/data/b1/jobs.json", ["1"], "test")
