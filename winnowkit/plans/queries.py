"""The registered queries: each operator on the driver's tables. Results have scalar columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import careers, geo, guards, hosts, keys, registered, text
from ..operators import capture, dedup, rollup, rules, scrape, seen, timeline, visited
from ..operators.graph import durable
from ..sources import pages as page_source
from . import base, diagnostics, reports
from .base import postings, raw_postings, table

HOME = (38.9531, -77.4565)


def _join(name: str, sep: str = "|"):
    return F.array_join(name, sep).alias(name)


# --- scalars -------------------------------------------------------------------------------------
def host_norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", hosts.normalize_host(F.col("url")).alias("host"))


def host_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by host, without excluded domains."""
    rows = table(spark, sf, "pages").select("page_id", "url", hosts.normalize_host(F.col("url")).alias("host"))
    rows = rows.where(~hosts.ends_with_any(F.col("host"), [".org", "net"]))
    return rows.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("latest"), F.min_by("url", F.struct(F.length("url"), "page_id")).alias("best_url"))


def marker_extract(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", page_source.embedded(F.col("html"), "<title>", "</title>").alias("title"))


def json_guard(spark: SparkSession, sf: str) -> DataFrame:
    v = F.try_parse_json("props")
    return table(spark, sf, "events").select(
        "event_id", guards.number_at(v, "$.k").try_cast("bigint").alias("k"), guards.text_at(v, "$.k").alias("k_text"), guards.true_at(v, "$.k").alias("k_true")
    )


def money_guard(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.floor("o_totalprice")
    return table(spark, sf, "orders").select("o_orderkey", guards.plausible(amount).cast("bigint").alias("amount"), guards.implausible(amount).alias("implausible"))


def careers_tiers(spark: SparkSession, sf: str) -> DataFrame:
    link = careers.careers_link(F.col("apply_url"), F.col("source"))
    p = raw_postings(spark, sf).withColumn("link", link)
    return p.select("ord", F.col("link.url").alias("careers_url"), F.col("link.tier").alias("tier"), careers.entry_url(F.col("link.url"), F.col("homepage")).alias("entry_url"))


def sql_careers(spark: SparkSession, sf: str) -> DataFrame:
    """``careers_tiers`` in SQL alone, by the registered functions."""
    registered.register(spark)
    return spark.sql(
        "SELECT ord, link.url AS careers_url, link.tier AS tier, wk_careers_entry(link.url, homepage) AS entry_url FROM (SELECT ord, homepage, wk_careers_link(apply_url, source) AS link FROM {p})",
        p=raw_postings(spark, sf),
    )


def level_signatures(spark: SparkSession, sf: str) -> DataFrame:
    return raw_postings(spark, sf).select("ord", text.level_signature(F.col("raw_title")).alias("level"), rules.senior_title(F.col("raw_title")).alias("senior"))


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.size(text.tokens(F.col("text"))).cast("bigint").alias("n_tokens"))


def haversine(spark: SparkSession, sf: str) -> DataFrame:
    lat, lon = F.col("s_suppkey") % 90 - 45.5, F.col("s_suppkey") * 7 % 360 - 180.25
    return table(spark, sf, "supplier").select("s_suppkey", F.round(geo.haversine_miles(F.lit(HOME[0]), F.lit(HOME[1]), lat, lon), 4).alias("miles"))


def html_escape(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.html_escape(F.col("html")).alias("escaped"))


def url_quote(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", text.url_quote(F.concat("p_name", F.lit(" *~b/&"))).alias("quoted"))


def match_keys(spark: SparkSession, sf: str) -> DataFrame:
    k = keys.match_keys(F.col("object_id"), F.array(F.concat(F.lit("x"), F.col("object_id")), F.lit("")), F.col("cluster_key"))
    return postings(spark, sf).select("ord", F.array_join(k, ",").alias("match_keys"))


# --- landed pages and captures ---------------------------------------------------------------------
def _visits(spark: SparkSession, sf: str) -> DataFrame:
    """Events as landed records: three searches of pages of fifty, keyed by user and type."""
    nth = F.col("event_id")
    key = F.when(nth % 41 == 0, F.lit(None)).otherwise(F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")))
    return table(spark, sf, "events").select((nth % 3).alias("search"), F.floor(nth / 150).alias("page"), nth.alias("pos"), key.alias("key"))


def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scrape.page_counts(scrape.land(_visits(spark, sf)))


def search_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scrape.search_counts(scrape.land(_visits(spark, sf)))


def search_results(spark: SparkSession, sf: str) -> DataFrame:
    """Why each search ended, with a ceiling that one in three reaches."""
    v = _visits(spark, sf).withColumn("page", F.floor(F.col("page") * (1 + F.col("search")) / 2))
    read = v.select("search", "page").distinct()
    return scrape.search_results(scrape.land(v, read, max_pages=40), read, 40)


def previous_run(spark: SparkSession, sf: str) -> DataFrame:
    """The latest good one of the runs that events stand in for."""
    metas = table(spark, sf, "events").select("event_id", F.col("ts").alias("finished_at"), (F.col("event_id") % 5).alias("records"), F.when(F.col("event_id") % 3 == 0, "failed").alias("error"))
    return scrape.previous_runs(metas).select("event_id", "records")


def run_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """The days that no run of a search covers, with events as runs whose windows are up to four days long."""
    e = table(spark, sf, "events")
    return scrape.uncovered(e.select(F.col("user_id").alias("search"), F.to_date("ts").alias("finished"), (F.col("event_id") % 5).alias("window")))


def capture_match(spark: SparkSession, sf: str) -> DataFrame:
    """Searches with the captures that serve them, by users' events: the widest window, then the first."""
    e = table(spark, sf, "events")
    window = F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 4 * 7)
    known = e.select(F.concat(F.lit("s"), F.col("event_id").cast("string")).alias("state"), (F.col("user_id") % 97).cast("string").alias("base"), window.cast("bigint").alias("window"), F.col("event_id").cast("int").alias("pos"))
    wanted = e.select((F.col("user_id") % 101).cast("string").alias("base")).distinct().withColumn("name", F.concat(F.lit("n"), F.col("base")))
    return capture.match(wanted, known)


def search_union(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return scrape.union_searches([o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), o], "o_orderkey")


def _captures(spark: SparkSession, sf: str) -> DataFrame:
    """Captured pages whose numbers leave out every fourth."""
    e = table(spark, sf, "events")
    return e.select((F.col("user_id") % 50).alias("state"), F.floor((F.col("event_id") % 13) * 4 / 3).alias("page"), F.col("ts").alias("captured_at"), F.col("event_id").alias("pos"), "value")


def latest_capture(spark: SparkSession, sf: str) -> DataFrame:
    return capture.latest_pages(_captures(spark, sf)).select("state", "page", "pos", "value")


def capture_summary(spark: SparkSession, sf: str) -> DataFrame:
    return capture.summary(capture.latest_pages(_captures(spark, sf))).select("state", "pages", "last_page", F.round("span_hours", 6).alias("span_hours"), F.array_join("missing", ",").alias("missing"))


# --- companies ---------------------------------------------------------------------------------------
def _company_rows(spark: SparkSession, sf: str) -> DataFrame:
    p, labels = raw_postings(spark, sf).withColumn("labels", base.split_list("cities")), F.col("labels")
    lat = lambda label: 36.0 + F.length(label) % 7
    points = F.transform(labels, lambda label: F.struct(F.when(label != "Remote", lat(label)).alias("lat"), F.lit(-77.5).alias("lon"), F.lit(None).cast("double").alias("lng")))
    return p.select(
        "ord", "source", "is_expired", "homepage", "labels", points.alias("points"), text.text_or_null(F.col("apply_url")).alias("apply_url"),
        F.when(F.col("ord") % 4 == 0, F.concat("company", F.when(F.col("ord") % 8 == 0, F.lit(" Inc")).otherwise(""))).alias("enriched_name"),
        F.col("company").alias("posting_name"), F.when(F.col("ord") % 6 == 0, F.col("object_id")).alias("profile"), F.col("job_category").alias("category"),
        F.nullif("published_at", F.lit("")).alias("published"), "title",
    )


OPTIONS = rollup.Rollup(*HOME, 150.0, ("Maryland",), ("usagov",), ("gov", ".mil"))


def company_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: companies from postings."""
    found = rollup.companies(rollup.judged(_company_rows(spark, sf), OPTIONS))
    counts = F.array_join(F.transform(F.map_entries("category_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return found.select(
        "key", "name", "website_host", "careers_url", "careers_tier", F.round("distance_miles", 2).alias("distance_miles"), _join("locations"), "posting_count",
        counts.alias("category_counts"), "software_posting_count", _join("sample_titles"), "latest_published_at", _join("sources"), _join("observed_names"), "profile",
    )


def company_drops(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.drop_counts(rollup.judged(_company_rows(spark, sf), OPTIONS))


def company_split(spark: SparkSession, sf: str) -> DataFrame:
    """Companies with a website and the others, which go to tables of their own."""
    found = rollup.companies(rollup.judged(_company_rows(spark, sf), OPTIONS))
    return found.groupBy("has_website").agg(F.count(F.lit(1)).alias("companies"), F.sum("posting_count").alias("postings"), F.count_if(F.col("distance_miles").isNull()).alias("without_distance"))


def company_tiers(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.tier_counts(rollup.companies(rollup.judged(_company_rows(spark, sf), OPTIONS)))


def company_ambiguous(spark: SparkSession, sf: str) -> DataFrame:
    found = rollup.ambiguous(rollup.companies(rollup.judged(_company_rows(spark, sf), OPTIONS)))
    return found.select("key", _join("observed_names"))


def company_page(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the company report."""
    found = durable(rollup.companies(rollup.judged(_company_rows(spark, sf), OPTIONS)))
    return reports.company_rows(found).select("n", "row")


def _log(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    host = F.concat(F.lit("https://www."), F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))), F.lit(".example.com/"))
    key = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("job:"), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 10 == 1, F.lit("localhost")).otherwise(host)
    return c.where("c_custkey % 3 = 0").select(key.alias("key"), (F.col("c_custkey") % 2 == 0).alias("applied"))


def _companies(spark: SparkSession, sf: str) -> DataFrame:
    return postings(spark, sf).select("company", F.col("company_host").alias("website_host")).distinct()


def visited_remaining(spark: SparkSession, sf: str) -> DataFrame:
    return visited.remaining(_companies(spark, sf), _log(spark, sf))


def visited_excluded(spark: SparkSession, sf: str) -> DataFrame:
    return visited.excluded(_companies(spark, sf), _log(spark, sf))


def visited_counters(spark: SparkSession, sf: str) -> DataFrame:
    return visited.filter_counters(_companies(spark, sf), _log(spark, sf))


def subdomain_cover(spark: SparkSession, sf: str) -> DataFrame:
    """Hosts of pages with the hosts of pages that cover them."""
    h = table(spark, sf, "pages").select(hosts.normalize_host(F.col("url")).alias("host")).distinct()
    return hosts.covered_by(h, "host", h, "host")


# --- deduplication --------------------------------------------------------------------------------------
def cluster_similarity(spark: SparkSession, sf: str) -> DataFrame:
    p = postings(spark, sf).where("cluster_key is not null")
    return dedup.mean_similarity(p, "cluster_key", "requirements").select("cluster_key", F.round("similarity", 9).alias("similarity"))


def calibration(spark: SparkSession, sf: str) -> DataFrame:
    threshold, n = dedup.calibrate(durable(postings(spark, sf)))
    return spark.range(1).select(F.round(F.lit(threshold), 9).alias("threshold"), F.lit(n).cast("bigint").alias("groups"))


def greedy_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents grouped by language and source, with a stand-in for levels."""
    d = table(spark, sf, "documents").withColumnRenamed("doc_id", "ord")
    return dedup.greedy_groups(d, ["lang", "source"], "text", (F.col("ord") % 3).cast("string"), 0.44)


def _listings(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """What deduplication reads of postings, and ``more`` columns that its survivors keep: written and read."""
    read = ("ord", "object_id", "cluster_key", "fallback_key", "requirements", "raw_title", "source", "apply_url", "published_at", "duplicate_count", "alternate_object_ids", "alternate_apply_urls")
    return durable(postings(spark, sf).select(*read, *more))


def representatives(spark: SparkSession, sf: str) -> DataFrame:
    out, _ = dedup.deduplicate(_listings(spark, sf), 0.6)
    return out.select("object_id", "dedup_key", F.col("duplicate_count").cast("bigint").alias("duplicate_count"), _join("alternate_object_ids"), _join("alternate_apply_urls"))


def dedup_counters(spark: SparkSession, sf: str) -> DataFrame:
    p = _listings(spark, sf)
    counts = dedup.dedup_counters(p, dedup.deduplicate(p, 0.6)[0])
    return spark.createDataFrame(sorted(counts.items()), "counter string, n bigint")


def postings_order(spark: SparkSession, sf: str) -> DataFrame:
    """The places of the survivors in the order in which postings are written."""
    kept = dedup.deduplicate(_listings(spark, sf, "company", "title"), 0.6)[0].select("object_id", "published_at", "company", "title", "place")
    order = [keys.newest_first(F.col("published_at")), F.col("company"), F.col("title"), F.col("place")]
    return timeline.number(kept, order).select("n", "object_id")


def cluster_merge(spark: SparkSession, sf: str) -> DataFrame:
    p = postings(spark, sf).where("cluster_key is not null")
    return dedup.merge(p, "cluster_key").select("cluster_key", "object_id", F.col("duplicate_count").cast("bigint").alias("duplicate_count"), _join("alternate_object_ids"), _join("alternate_apply_urls"))


def candidate_keys(spark: SparkSession, sf: str) -> DataFrame:
    candidates = ["cluster_key", "fallback_key", "company"]
    p = durable(postings(spark, sf).select("ord", "requirements", *candidates))
    return dedup.compare_keys(p, candidates, "requirements", 0.44)


def truth_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """How alike the vendor's own duplicates are, with the quartiles."""
    found = dedup.truth(durable(postings(spark, sf)))
    figures = [found[c] for c in ("mean", "min", "max")] + (found["quartiles"] or [None] * 3)
    names = ("mean", "low", "high", "q1", "q2", "q3")
    return spark.createDataFrame([(found["groups"], found["scored"], *figures)], "groups bigint, scored bigint, " + ", ".join(f"{c} double" for c in names)).select(
        "groups", "scored", *[F.round(c, 9).alias(c) for c in names]
    )


def key_skew(spark: SparkSession, sf: str) -> DataFrame:
    """The frequent sources and categories of postings with the vendor's key and without it."""
    return dedup.keyed_skew(postings(spark, sf), ["source", "job_category"])


def worst_merges(spark: SparkSession, sf: str) -> DataFrame:
    """The groups of a loose key whose texts are least alike."""
    found = dedup.worst_merges(durable(postings(spark, sf)), "company", "requirements", 0.44, 6, ["source", "cities", "published_at"])
    return found.select("company", F.round("similarity", 9).alias("similarity"), "n", "source", "cities", "published_at")


def key_structure(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.key_structure(postings(spark, sf), "cluster_key")


# --- screening --------------------------------------------------------------------------------------------
SCREEN = rules.Screen(comp_floor=120_000, comp_min_floor=70_000, blocked_companies=("customer#000000007",))


def _screened(spark: SparkSession, sf: str) -> DataFrame:
    return rules.screen(postings(spark, sf), SCREEN)


def _screened_table(spark: SparkSession, sf: str) -> DataFrame:
    """Screened postings as the stages behind the screen get them: written and read."""
    return durable(_screened(spark, sf))


def _surfaced_table(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Those of them that are not rejected, for stages that read no others, and all or some of their columns."""
    return durable(rules.surfaced(_screened(spark, sf)).select(*(columns or "*")))


#: What classification reads of a posting.
KNOWN_BY = ("ord", "object_id", "alternate_object_ids", "cluster_key", "band")


def screen_bands(spark: SparkSession, sf: str) -> DataFrame:
    return _screened(spark, sf).select("ord", "band", "near_miss", _join("reject_reasons", "; "), _join("demote_reasons", "; "))


def reason_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.reason_counts(_screened(spark, sf))


def sole_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return rules.sole_reason_counts(_screened(spark, sf))


def screen_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return rules.funnel(_screened(spark, sf))


def funnel_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    """The funnel in which duplicates are counted behind the rejections, as (step, n)."""
    f = diagnostics.funnel_figures(_screened_table(spark, sf))
    steps = {k: f[k] for k in ("records", "rejected", "duplicates", "near_misses")} | {f"band {b}": n for b, n in f["bands"].items()} | {f"demoted {k}": n for k, n in f["demote_reasons"].items()}
    return spark.createDataFrame(sorted(steps.items()), "step string, n bigint")


def flag_audit(spark: SparkSession, sf: str) -> DataFrame:
    return rules.flag_audit(_screened(spark, sf))


def shortlist_page(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the shortlist report."""
    applied = visited.visited_hosts(_log(spark, sf)).where("applied").select("host")
    return reports.shortlist_rows(_surfaced_table(spark, sf), applied).select("n", "row")


def flag_reliability(spark: SparkSession, sf: str) -> DataFrame:
    return rules.flag_reliability(postings(spark, sf))


# --- the seen store --------------------------------------------------------------------------------------------
def _store(spark: SparkSession, sf: str) -> DataFrame:
    """An earlier run's store: the first half of the postings, one entry a cluster or posting."""
    p = postings(spark, sf).where("ord % 2 = 0")
    more = F.when(F.col("ord") % 8 == 0, F.array(F.concat(F.lit("o"), (F.col("ord") + 1).cast("string"))))
    k = keys.match_keys(F.col("object_id"), more, F.col("cluster_key"))
    return p.select(
        "object_id", k.alias("keys"), F.when(F.col("ord") % 4 == 0, "possible").otherwise("strong").alias("band"), F.lit("2024-01-01").alias("first_surfaced"),
        F.lit("2024-01-01").alias("last_surfaced"), F.lit(1).cast("bigint").alias("surfaced_count"), *[F.lit(False).alias(c) for c in ("opened", "applied", "company_applied")],
        "title", "company", F.coalesce("company_host", F.lit("")).alias("company_host"), F.col("ord").alias("put_seq"),
    )


def seen_diff(spark: SparkSession, sf: str) -> DataFrame:
    return seen.classify(_surfaced_table(spark, sf, *KNOWN_BY), _store(spark, sf)).select("ord", "owner", "action")


def diff_counters(spark: SparkSession, sf: str) -> DataFrame:
    judged = seen.classify(_surfaced_table(spark, sf, *KNOWN_BY), _store(spark, sf))
    return judged.groupBy("action", "band").agg(F.count(F.lit(1)).alias("n"))


def shortlist_order(spark: SparkSession, sf: str) -> DataFrame:
    """The places of the postings that are shown, in the order in which a shortlist is written."""
    shown = seen.shortlist(seen.classify(_surfaced_table(spark, sf), _store(spark, sf)))
    return timeline.number(shown.select("ord", "band", "comp_max", "company"), rules.shortlist_order()).select("n", "ord")


def store_merge(spark: SparkSession, sf: str) -> DataFrame:
    now = _screened_table(spark, sf)
    store = durable(_store(spark, sf))
    after = seen.merge(store, durable(seen.classify(now, store)), "2024-02-02")
    return after.select("object_id", _join("keys", ","), "band", "first_surfaced", "last_surfaced", "surfaced_count", "title", "company")


def visit_labels(spark: SparkSession, sf: str) -> DataFrame:
    opened = table(spark, sf, "orders").where("o_orderkey % 7 = 0").select(F.concat(F.lit("job:o"), F.col("o_orderkey").cast("string")).alias("key"), (F.col("o_orderkey") % 2 == 0).alias("applied"))
    applied = table(spark, sf, "customer").where("c_custkey % 5 = 0").select(F.concat(F.lit("careers."), F.lower(F.replace("c_name", F.lit("#"), F.lit("-"))), F.lit(".example.com")).alias("host"))
    return seen.label(_store(spark, sf), opened, applied).select("object_id", "opened", "applied", "company_applied")


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    applied = visited.visited_hosts(_log(spark, sf)).where("applied").select("host")
    opened = table(spark, sf, "orders").where("o_orderkey % 7 = 0").select(F.concat(F.lit("job:o"), F.col("o_orderkey").cast("string")).alias("key"), (F.col("o_orderkey") % 2 == 0).alias("applied"))
    return seen.label_counts(seen.label(_store(spark, sf), opened, applied))


# --- diagnostics ----------------------------------------------------------------------------------------------------
def daily_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.daily_histogram(postings(spark, sf), "published_at")


def top_sources(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top(postings(spark, sf), "source", 5)


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    p = postings(spark, sf)
    return p.agg(
        F.count(F.lit(1)).alias("postings"), F.round(F.avg(F.col("cluster_key").isNotNull().cast("int")), 4).alias("cluster_key_share"),
        F.count_if(text.strip(F.col("requirements")) == "").alias("blank_requirements"),
    )
