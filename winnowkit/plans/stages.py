"""The stages of both chains, each from files to files, with a sidecar of counts.

Companies: land, rollup, filter, render. Postings: land or import, normalize, screen, diff, render.
Each stage writes its table into a folder of its run and returns the counts it also writes beside it.
Tables are written in the order that the next stage takes as its input order (``ord``).
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import UTC, datetime
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import newest_first, record_key
from ..operators import capture, dedup, postings, rollup, rules, scrape, seen, visited
from ..operators.graph import durable
from ..sources import captures, jsonl, pages, visitlog
from ..sources.config import Config, ConfigError, Search
from ..tables import delete, hadoop, scoped
from . import reports


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = hadoop(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop(spark, path)
    return "\n".join(r["value"] for r in spark.read.text(path).collect()) if fs.exists(p) else None


def _sidecar(spark: SparkSession, path: str, counts: dict) -> dict:
    meta = {"generated_at": datetime.now(UTC).isoformat(), **counts}
    _write_text(spark, path, json.dumps(meta, indent=2, ensure_ascii=False, default=str))
    return meta


def _one(df: DataFrame) -> dict:
    return df.first().asDict()


def _by(df: DataFrame, name: str, n: str = "n") -> dict:
    return {r[name]: r[n] for r in df.collect()}


def in_order(df: DataFrame, *by: Column) -> DataFrame:
    """``df`` sorted, with ord as numbers that rise with the rows; sorting deals ranges out to tasks, so none holds all."""
    return df.orderBy(*by).withColumn("ord", F.monotonically_increasing_id())


@scoped
def land(spark: SparkSession, result_pages: DataFrame, out: str, compress: bool = True, max_pages: int = 500, searches: list[str] | None = None, extra: dict | None = None) -> dict:
    """Landed pages (search, page, payload, build_id; payload is JSON text) to records, one for each key.

    ``searches`` names the numbers in ``search``. A run without records keeps only its sidecar, so that
    later stages don't take it for a day without postings. A search ends before a page that the site turned
    away or that breaks its format. What came before it and what the other searches have is landed; then
    the run ends with the error of the first such page, which the sidecar has too.
    """
    meta = {"started_at": datetime.now(UTC).isoformat(), "max_pages": max_pages, "compressed": compress, **(extra or {})}
    received = durable(result_pages.where(F.col("page") <= max_pages))
    wrong = durable(pages.problems(received).groupBy("search").agg(F.min(F.struct("page", "wrong")).alias("w")).select("search", "w.*"))  # a row a search
    broken = {r["search"]: pages.error_of(*r) for r in wrong.orderBy("search").collect()}
    cut = wrong.select(F.col("search").alias("_s"), F.col("page").alias("_p"))
    read = received.select("search", "page", "payload", "build_id").join(F.broadcast(cut), F.col("search") == F.col("_s"), "left")
    read = durable(read.where("_p is null or page < _p").drop("_s", "_p"))
    found = pages.records(read).withColumn("key", record_key(F.col("record")))
    landed = durable(scrape.land(found.drop("build_id"), read, max_pages=max_pages))
    name = lambda i: searches[i] if searches else str(i)
    results = {r["search"]: r.asDict() for r in scrape.search_results(landed, read, max_pages).collect()}  # a row a search
    for r in scrape.search_counts(landed).collect():
        results[r["search"]] |= r.asDict()
    totals = scrape.totals(read.select("search", "page", pages.reported_totals(F.col("payload")).alias("totals")))
    for r in totals.collect():
        results[r["search"]].setdefault("reported_totals", {})[r["name"]] = r["value"]
    builds = read.where(F.coalesce("build_id", F.lit("")) != "").groupBy("search").agg(F.collect_set("build_id").alias("b"))
    for r in builds.collect():
        results[r["search"]]["build_ids"] = sorted(r["b"])
    for i, e in broken.items():
        results[i] = results.get(i, {"search": i, "pages_fetched": 0}) | {"stop_reason": "error", "error": str(e)}
    listed = [{"name": name(i), **results[i]} for i in sorted(results)]
    meta |= {
        "searches": listed, "stop_reason": scrape.stop_reason([(s["name"], s["stop_reason"]) for s in listed]),
        "pages_fetched": sum(s["pages_fetched"] for s in listed), "truncated": any(s["stop_reason"].startswith("reached max_pages") for s in listed),
        "pages": [r.asDict() for r in scrape.page_counts(landed).orderBy("search", "page").collect()],
    }
    written = landed.where("written")
    n = written.count()
    if n:
        lines = written.orderBy("search", "page", "pos").select(F.to_json("record").alias("value"))
        (lines.write.option("compression", "gzip") if compress else lines.write).text(f"{out}/records")
    keyless = written.where("key is null").count()
    first = next(iter(broken.values()), None)
    meta |= {"finished_at": datetime.now(UTC).isoformat(), "records": n, "unique_records": n - keyless, "keyless_records": keyless, "jobs_file": "records" if n else None}
    meta = _sidecar(spark, f"{out}/meta.json", meta | ({"error": str(first)} if first else {}))
    if first:
        raise first
    return meta


@scoped
def import_capture(spark: SparkSession, path: str, searches: list[Search], out: str, compress: bool = True, previous_runs: str | None = None) -> dict:
    """A raw run from pages that a browser captured, in place of fetched ones.

    Every configured search must have been captured; a capture of another one is left out and
    listed. ``previous_runs`` is a pattern of the sidecars of earlier runs: a gap to the last good
    one that is longer than a capture's window is a warning.
    """
    found, ends = captures.read(spark, path)
    found = durable(found)
    known = durable(captures.states(found))
    wanted = spark.createDataFrame([(i, s.name, captures.state_key(s.state, fixed.WINDOW_FIELD)) for i, s in enumerate(searches)], "search int, name string, base string")
    matched = durable(wanted.select("search", "base").join(capture.match(wanted, known), "base"))
    if missing := [r["name"] for r in matched.where("state is null").orderBy("search").collect()]:
        raise captures.BadCapture(f"{path}: no captured pages for {', '.join(missing)}")
    latest = durable(capture.latest_pages(found).join(matched.select("search", "state"), "state"))
    records = pages.records(latest.select("state", "page", "payload"))
    facts = capture.summary(latest).join(capture.complete(latest, records, capture.end_markers(ends)), "state").join(matched, "state")
    told, warnings = {}, []
    previous = last_run(spark, previous_runs) if previous_runs else None
    gaps = facts.withColumn("gap_days", capture.gap_days(F.lit(previous).cast("timestamp"), F.try_to_timestamp("first_at")))
    for r in gaps.orderBy("search").collect():  # a row a search
        told[r["name"]] = {k: r[k] for k in ("window", "complete", "pages", "missing", "last_page_records", "first_at", "last_at", "span_hours")}
        if not r["complete"]:
            warnings.append(f"{r['name']}: last page not reached")
        if r["missing"]:
            warnings.append(f"{r['name']}: missing pages {r['missing']}")
        if r["span_hours"] > fixed.SPAN_WARNING_HOURS:
            warnings.append(f"{r['name']}: pages were captured over {r['span_hours']:.0f} hours")
        if r["window"] is not None and r["gap_days"] is not None and r["gap_days"] > r["window"]:
            warnings.append(f"{r['name']}: the run before ended {r['gap_days']:.1f} days before this capture, longer than its {r['window']}-day window")
    skipped = [r["state"][:160] for r in capture.unmatched(wanted, known).orderBy("pos").collect()]
    extra = {"source": "browser capture", "capture_file": path, "captures": told, "skipped": skipped, "warnings": warnings}
    # Past the last captured page, so that the end of a capture isn't taken for the ceiling.
    ceiling = (latest.agg(F.max("page")).first()[0] or 0) + 1
    return land(spark, latest, out, compress, ceiling, [s.name for s in searches], extra)


def last_run(spark: SparkSession, pattern: str) -> str | None:
    """When the newest raw run with records and without an error ended."""
    text = spark.read.option("wholetext", "true").text(pattern).select(F.try_parse_json("value").alias("m"))
    at = lambda f, kind: F.try_variant_get("m", f"$.{f}", kind)
    metas = text.select(at("records", "bigint").alias("records"), at("error", "string").alias("error"), at("finished_at", "string").alias("finished_at"))
    best = scrape.previous_runs(metas.where(F.try_to_timestamp("finished_at").isNotNull())).first()
    return best["finished_at"] if best else None


@scoped
def normalize(spark: SparkSession, records_path: str, out: str, similarity: float | None = None) -> dict:
    flat = durable(postings.project(jsonl.read(spark, records_path)))
    calibrated, groups = dedup.calibrate(flat)
    threshold = calibrated if similarity is None else similarity
    kept = durable(dedup.deduplicate(flat, threshold)[0])
    in_order(kept, newest_first(F.col("published_at")), F.col("company"), F.col("title"), F.col("place")).drop("place").write.mode("errorifexists").parquet(f"{out}/postings")
    counts = _one(postings.normalize_counters(flat)) | dedup.dedup_counters(flat, kept)
    return _sidecar(spark, f"{out}/meta.json", counts | {"threshold": threshold, "calibrated": calibrated, "overridden": similarity is not None, "calibrated_on": groups})


@scoped
def screen(spark: SparkSession, postings_path: str, out: str, config: Config = Config()) -> dict:
    settings = rules.Screen(config.comp_floor, config.comp_min_floor, config.wide_geography_cities, config.blocked_companies)
    done = durable(rules.screen(postings.conform(spark.read.parquet(postings_path)), settings))
    in_order(done, *rules.shortlist_order()).write.mode("errorifexists").parquet(f"{out}/screened")
    reasons = {c: _by(rules.reason_counts(done, c), "reason") for c in ("reject_reasons", "demote_reasons")}
    return _sidecar(spark, f"{out}/meta.json", _one(rules.funnel(done)) | reasons | {"sole_reasons": _by(rules.sole_reason_counts(done), "reason")})


def _log(spark: SparkSession, store_dir: str) -> list[str]:
    fs, p = hadoop(spark, f"{store_dir}/commits")
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.getPath().getName().isdigit()) if fs.exists(p) else []


def head(spark: SparkSession, store_dir: str) -> tuple[int, str | None]:
    """(number, version): the last commit of the store, and the version that it names; (0, None) of a new one."""
    names = _log(spark, store_dir)
    return (int(names[-1]), _read_text(spark, f"{store_dir}/commits/{names[-1]}").strip()) if names else (0, None)


def current_version(spark: SparkSession, store_dir: str) -> str | None:
    """The name of the store's version that counts."""
    return head(spark, store_dir)[1]


def commit(spark: SparkSession, store_dir: str, after: int, version: str) -> bool:
    """Make ``version`` the commit behind number ``after``; False if another writer was first.

    The commit is written whole under a name of its own, then given its number by a rename (on a local disk a link)
    that fails where the number is taken, so of several writers one gets it and no reader sees half of it.
    """
    made, place = f"{store_dir}/commits/.{version}", f"{store_dir}/commits/{after + 1:010}"
    _write_text(spark, made, version + "\n")
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(made), jvm.org.apache.hadoop.fs.Path(place)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if fs.getUri().getScheme() == "file":
            os.link(source.toUri().getPath(), target.toUri().getPath())
        else:
            files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            files.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(source, False)


@scoped
def diff(spark: SparkSession, screened_path: str, store_dir: str, out: str, today: str, visit_log: str | None = None, dry_run: bool = False, attempts: int = 10) -> dict:
    """The shortlist, and the next version of the store.

    The commit comes last of all: a run that dies before leaves the old version, and can be run again. A run that finds
    that another one has committed since it read the store starts over from the new version, so both runs' entries stay.
    """
    for _ in range(attempts):
        number, current = head(spark, store_dir)
        store = durable(spark.read.parquet(f"{store_dir}/{current}") if current else seen.empty_store(spark))
        labels = {}
        if visit_log:
            log = visitlog.read(spark, visit_log)
            store = durable(seen.label(store, visitlog.opened_postings(log), visitlog.applied_hosts(log)))
            labels = _one(seen.label_counts(store))
        judged = durable(seen.classify(spark.read.parquet(screened_path), store))
        in_order(seen.shortlist(judged), *rules.shortlist_order()).write.mode("overwrite").parquet(f"{out}/shortlist")
        after, version = store, f"v{datetime.now(UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        if not dry_run:
            after = durable(seen.merge(store, judged, today))
            seen.in_order(after).write.mode("errorifexists").parquet(f"{store_dir}/{version}")
        actions = {"new": 0, "promoted": 0, "suppressed": 0} | _by(judged.groupBy("action").agg(F.count(F.lit(1)).alias("n")), "action")
        bands = _by(seen.shortlist(judged).groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band")
        meta = _sidecar(spark, f"{out}/meta.json", actions | labels | {"bands": bands, "dry_run": dry_run, "store_entries_before": store.count(), "store_entries_after": after.count()})
        if dry_run or commit(spark, store_dir, number, version):
            return meta
        delete(spark, f"{store_dir}/{version}")
    raise RuntimeError(f"{store_dir}: other runs committed first, {attempts} times")


def rollup_options(config: Config) -> rollup.Rollup:
    return rollup.Rollup(config.home_lat, config.home_lon, config.radius_miles, config.excluded_states, config.excluded_sources, config.excluded_domains)


@scoped
def company_rollup(spark: SparkSession, records_path: str, out: str, config: Config) -> dict:
    rows = durable(rollup.judged(rollup.company_inputs(jsonl.read(spark, records_path)), rollup_options(config)))
    found = durable(rollup.companies(rows))
    in_order(found.where("has_website"), F.col("ord")).write.mode("errorifexists").parquet(f"{out}/companies")
    in_order(found.where("not has_website"), F.col("ord")).write.mode("errorifexists").parquet(f"{out}/companies-no-website")
    n = found.agg(F.count_if("has_website").alias("companies"), F.count_if(~F.col("has_website")).alias("tail_companies"), F.count_if(F.col("has_website") & F.col("distance_miles").isNull()).alias("companies_without_distance"))
    counts = {"dropped": _by(rollup.drop_counts(rows), "drop_reason"), "tiers": _by(rollup.tier_counts(found), "careers_tier")} | _one(n)
    return _sidecar(spark, f"{out}/meta.json", counts | {"ambiguous": rollup.ambiguous(found).count()})


@scoped
def company_filter(spark: SparkSession, companies_path: str, visit_log: str, out: str) -> dict:
    """Companies that the log doesn't have; those without a website, beside the input, pass through."""
    found, log = spark.read.parquet(companies_path), visitlog.read(spark, visit_log)
    in_order(visited.remaining(found, log), F.col("ord")).write.mode("errorifexists").parquet(f"{out}/remaining")
    tail, passed = f"{companies_path.rstrip('/')}-no-website", 0
    fs, p = hadoop(spark, tail)
    if fs.exists(p):
        rows = spark.read.parquet(tail)
        in_order(rows, F.col("ord")).write.mode("errorifexists").parquet(f"{out}/remaining-no-website")
        passed = rows.count()
    sample = [r.asDict() for r in visited.excluded(found, log).select("key", "applied").orderBy("key").limit(fixed.EXCLUDED_SAMPLE).collect()]
    kinds = _by(visited.split_log(log).groupBy("kind").agg(F.count(F.lit(1)).alias("n")), "kind")
    return _sidecar(spark, f"{out}/meta.json", _one(visited.filter_counters(found, log)) | {"log": kinds, "excluded_sample": sample, "passthrough_no_website": passed})


@scoped
def render_companies(spark: SparkSession, companies_path: str, page: str, title: str = "Companies to visit", note: str = "") -> int:
    """Write the page; the number of its rows."""
    rows = reports.company_rows(spark.read.parquet(companies_path))
    return reports.write_page(rows, reports.COMPANY_HEADERS, title, page, "{n} companies, nearest first.", note)


@scoped
def render_shortlist(spark: SparkSession, shortlist_path: str, page: str, title: str = "Job shortlist", visit_log: str | None = None, bands: tuple[str, ...] = ("strong", "possible"), note: str = "") -> int:
    """Write the page; the number of its rows. A visit log that can't be read costs its marks, not the page."""
    hosts = spark.createDataFrame([], "host string")
    if visit_log and Path(visit_log).exists():
        hosts = visitlog.applied_hosts(visitlog.read(spark, visit_log))
    listed = spark.read.parquet(shortlist_path)
    counts = _by(listed.where(F.col("band").isin(*bands)).groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band")
    said = ", ".join(f"{counts[b]} {b}" for b in ("strong", "possible") if counts.get(b))
    return reports.write_page(reports.shortlist_rows(listed, hosts, bands), reports.SHORTLIST_HEADERS, title, page, "{n} postings (" + said + "), strongest first.", note)


def search_links(config: Config, site: str) -> list[tuple[str, str, str]]:
    """(kind, name, url) of each configured search, daily with a short window and as it is configured."""
    found = config.searches()
    if not found:
        raise ConfigError("no search is configured")
    daily = [("daily", s.name, reports.search_url(site, s.state | {fixed.WINDOW_FIELD: fixed.DAILY_WINDOW_DAYS})) for s in found]
    return daily + [("catch-up", s.name, reports.search_url(site, s.state)) for s in found]
