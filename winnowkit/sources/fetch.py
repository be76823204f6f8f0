"""Result pages as a Spark data source: a partition a search, its pages read one after the other.

``spark.read.format("result_pages")`` gives (search, page, payload, build_id, status, mitigated, problem), the rows that
the landing stage takes. Options: ``searches`` (JSON list of search states), ``max_pages``, ``transport`` (``module:function``
of what makes a transport from the options), ``retries``, ``backoff`` and ``pause`` in seconds, ``refreshes``; further ones are the transport's.

A transport is a callable ``(path, params) -> Reply`` that raises OSError where no reply comes. Page 0
is the rendered page, which names the build and the data route; later pages come from the route. What fails for now (no reply, 5xx)
is asked for again, waiting longer each time. A build that is refused is looked up anew and the same page asked for again, up to
``refreshes`` times in a search. A page that can't be had is a last row with what came (status and text) or
with ``problem``, so a run can land what came before it.

Pages end with an empty one, with the second in a row that brings no new key, or behind page ``max_pages``. A task
holds one page and the keys of its search. A task that is lost reads its search again.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import fixed
from ..tables import file_system, on_workers

SCHEMA = "search int, page bigint, payload string, build_id string, status int, mitigated string, problem string"


@dataclass(frozen=True)
class Reply:
    status: int
    text: str
    mitigated: str | None = None


Transport = Callable[[str, dict], Reply]


def over_http(options: dict) -> Transport:
    """Pages of the site at ``base_url``, with a ``user_agent`` and a ``timeout`` in seconds."""
    base, agent, wait = options["base_url"].rstrip("/"), options.get("user_agent", "winnowkit"), float(options.get("timeout", 30))

    def ask(path: str, params: dict) -> Reply:
        headers = {"User-Agent": agent} | ({"x-nextjs-data": "1"} if path != "/" else {})
        url = f"{base}{path}?{urllib.parse.urlencode(params)}"
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=wait) as r:
                return Reply(r.status, r.read().decode("utf-8", "replace"), r.headers.get("cf-mitigated"))
        except urllib.error.HTTPError as e:
            return Reply(e.code, e.read().decode("utf-8", "replace"), e.headers.get("cf-mitigated"))

    return ask


def from_files(options: dict) -> Transport:
    """Pages that were landed before: ``folder``/search=n/block=m/*.json has lines of page and payload, ``block_pages`` pages a block."""
    folder, size = options["folder"], int(options["block_pages"])

    @lru_cache(maxsize=1)
    def block(search: int, n: int) -> dict[int, str]:
        from pyarrow import fs as afs

        fs, base = file_system(f"{folder}/search={search}/block={n}")
        found = {}
        for f in fs.get_file_info(afs.FileSelector(base, allow_not_found=True)):
            if f.base_name.endswith(".json"):
                with fs.open_input_stream(f.path) as lines:
                    found |= {r["page"]: r["payload"] for r in map(json.loads, lines.read().splitlines())}
        return found

    def ask(path: str, params: dict) -> Reply:
        search, page = json.loads(params["searchState"])["search"], int(params.get("page", 0))
        text = block(search, page // size).get(page, '{"pageProps":{"ssrHits":[]}}')
        if path == "/":
            text = f'{fixed.PAGE_DATA_OPEN}{{"buildId":"files","page":"/","props":{text}}}{fixed.PAGE_DATA_CLOSE}'
        return Reply(200, text)

    return ask


class _Bad(Exception):
    """A page can't be had; the row that says so."""

    def __init__(self, reply: Reply | None, problem: str | None = None):
        self.row = (None if problem else reply.text, None if reply is None else reply.status, None if reply is None else reply.mitigated, problem)


def records_in(payload: dict) -> list[tuple[int, str | None]]:
    """(place, key) of the records of a page, the key None for records without one; where they stand is told in ``pages.records``."""
    props = payload.get("pageProps") if payload.get("pageProps") is not None else payload
    own = lambda x: isinstance(x, list) and bool(x) and isinstance(x[0], dict) and not x[0].keys().isdisjoint(("objectID", "id"))
    hits = props.get("ssrHits")
    listed = hits if isinstance(hits, list) else next(filter(own, props.values()), [])
    ids = [(i, r.get("objectID") or r.get("id")) for i, r in enumerate(listed) if isinstance(r, dict)]
    return [(i, k if k is None or isinstance(k, str) else json.dumps(k)) for i, k in ids]


class _Pages:
    """One search while its pages are read."""

    def __init__(self, ask: Transport, state: object, options: dict):
        self.ask, self.state = ask, json.dumps(state, separators=(",", ":"), ensure_ascii=False)
        number = lambda name, kind, other: kind(options.get(name, other))
        self.last, self.tries, self.left = number("max_pages", int, 500), number("retries", int, 3), number("refreshes", int, 2)
        self.backoff, self.pause = number("backoff", float, 2.0), number("pause", float, 0.0)
        self.build, self.route = None, "index"

    def reply(self, path: str, params: dict) -> Reply:
        for attempt in range(1, self.tries + 1):
            found, problem = None, None
            try:
                found = self.ask(path, {"searchState": self.state} | params)
            except OSError as e:
                problem = f"no reply: {e}"
            if found is not None and found.status < 500:
                return found
            if attempt < self.tries:
                time.sleep(self.backoff * attempt)
        raise _Bad(found, problem or f"HTTP {found.status}, {self.tries} times")

    def rendered(self) -> dict:
        """The data of the rendered page, with the build and the route of the others."""
        found = self.reply("/", {})
        if found.status != 200:
            raise _Bad(found)
        _, at, rest = found.text.partition(fixed.PAGE_DATA_OPEN)
        text, end, _ = rest.partition(fixed.PAGE_DATA_CLOSE)
        try:
            data = json.loads(text) if at and end else None
        except ValueError:
            data = None
        if not isinstance(data, dict) or not isinstance(data.get("props", {}), dict):
            raise _Bad(found, "the rendered page carries no data")
        if isinstance(data.get("buildId"), str) and data["buildId"]:
            self.build = data["buildId"]
        elif self.build is None:
            raise _Bad(found, "the rendered page names no build")
        page = data.get("page")
        self.route = (page.strip("/") if isinstance(page, str) else "") or "index"
        return data.get("props", {})

    def data(self, page: int) -> tuple[str, dict]:
        while True:
            found = self.reply(f"/_next/data/{self.build}/{self.route}.json", {"page": page})
            payload = None
            if found.status == 200:
                try:
                    payload = json.loads(found.text)
                except ValueError:
                    payload = None
                props = payload.get("pageProps") if isinstance(payload, dict) else None
                if payload is not None and not (isinstance(props, dict) and fixed.REDIRECT_FIELD in props):
                    if not isinstance(payload, dict) or props is not None and not isinstance(props, dict):
                        raise _Bad(found)
                    return found.text, payload
            elif found.status != 404:
                raise _Bad(found)
            if self.left == 0:
                raise _Bad(found)
            self.left -= 1  # the site was deployed anew
            self.rendered()

    def rows(self) -> Iterator[tuple]:
        seen: set[str] = set()
        stale = 0
        for page in range(self.last + 1):
            try:
                if page == 0:
                    payload = self.rendered()
                    text = json.dumps(payload, ensure_ascii=False)
                else:
                    time.sleep(self.pause)
                    text, payload = self.data(page)
            except _Bad as e:
                text, status, mitigated, problem = e.row
                yield page, text, self.build, status, mitigated, problem
                return
            yield page, text, self.build, 200, None, None
            keys = [k for _, k in records_in(payload)]
            fresh = [k for k in keys if k is None or k not in seen]
            seen.update(k for k in keys if k is not None)
            stale = 0 if fresh else stale + 1
            if not keys or stale == fixed.EMPTY_PAGES_TO_STOP:
                return


class _Search(InputPartition):
    def __init__(self, number: int, state: object):
        self.number, self.state = number, state


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[_Search]:
        return [_Search(i, s) for i, s in enumerate(json.loads(self.options["searches"]))]

    def read(self, partition: _Search | None) -> Iterator[tuple]:
        if partition is None:  # no search at all
            return
        module, _, name = self.options["transport"].partition(":")
        ask = getattr(importlib.import_module(module), name)(self.options)
        for row in _Pages(ask, partition.state, self.options).rows():
            yield partition.number, *row


class ResultPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "result_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def fetch(spark: SparkSession, searches: list, transport: str = f"{__name__}:over_http", **options: object) -> DataFrame:
    """The pages of the searches. Settle them before more than one reader: each scan asks for them again."""
    on_workers(spark)
    spark.dataSource.register(ResultPages)
    given = {k: str(v) for k, v in options.items()} | {"searches": json.dumps(searches), "transport": transport}
    return spark.read.format(ResultPages.name()).options(**given).load()
