"""Queries over raw input: JSON lines, result pages, captures and the visit log, written to files and read back.

The JSON texts are made by SQL that Spark and DuckDB read alike, with wrong types, blanks and
missing fields dealt out among the rows, so a query and its SQL start from the same texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import registered
from ..functions.keys import record_key
from ..operators import capture, postings, rollup, scrape, visited
from ..operators.graph import durable
from ..operators.postings import COLUMNS
from ..plans import diagnostics
from ..sources import captures, fetch, jsonl, pages, visitlog
from ..tables import new_path
from .base import raw_postings, table
from .queries import OPTIONS

_CITY_LIST = """CASE WHEN ord % 19 = 4 THEN '"Reston"' WHEN cities = '' THEN '[]' WHEN ord % 19 = 5 THEN '[7,"' || replace(cities, '|', '"," ') || ' ",""]' ELSE '["' || replace(cities, '|', '","') || '"]' END"""
_LIST = "CASE WHEN {0} = '' THEN 'null' ELSE '[\"' || replace({0}, '|', '\",\"') || '\"]' END"
_PAY = """CASE WHEN {0} IS NULL THEN 'null' WHEN ord % 23 = 1 THEN '"' || CAST({0} AS STRING) || '"' WHEN ord % 23 = 2 THEN 'true' WHEN ord % 23 = 3 THEN CAST({0} AS STRING) || '.75' WHEN ord % 23 = 4 THEN '99' ELSE CAST({0} AS STRING) END"""
_OPT = "coalesce('\"' || {0} || '\"', 'null')"

#: A raw record of a derived posting.
LINE = f"""'{{"objectID":' || CASE WHEN ord % 11 = 0 THEN 'null' WHEN ord % 11 = 1 THEN '0' WHEN ord % 11 = 2 THEN '" "' WHEN ord % 11 = 3 THEN CAST(ord AS STRING) ELSE '" ' || object_id || '"' END
  || CASE WHEN ord % 33 = 22 THEN '' WHEN ord % 33 = 12 THEN ',"id":false' ELSE ',"id":"x' || object_id || '"' END
  || ',"source":' || CASE WHEN ord % 13 = 5 THEN 'false' ELSE '"' || source || ' "' END
  || ',"apply_url":' || CASE WHEN apply_url = '' THEN 'null' ELSE '"' || apply_url || '"' END
  || ',"is_expired":' || CASE WHEN is_expired THEN 'true' WHEN ord % 7 = 0 THEN '"true"' ELSE 'false' END
  || ',"liberal_dedup_cluster":' || {_OPT.format("cluster_key")}
  || ',"job_information":' || CASE WHEN ord % 17 = 3 THEN '"none"' ELSE '{{"title":"' || raw_title || '"' || CASE WHEN ord % 5 = 0 THEN ',"job_title_raw":" ' || raw_title || ' x"' ELSE '' END || '}}' END
  || ',"enriched_company_data":' || CASE WHEN ord % 9 = 4 THEN 'null' ELSE '{{"name":' || CASE WHEN ord % 6 = 1 THEN '3' ELSE '"' || company || ' Inc"' END || ',"homepage_uri":' || coalesce('"' || homepage || '"', '[]') || ',"year_founded":' || CASE WHEN ord % 4 = 0 THEN '1999' ELSE 'null' END || '}}' END
  || ',"_geoloc":' || CASE WHEN ord % 5 = 4 THEN '{{}}' ELSE '[{{"lat":38.9,"lon":-77.4}},{{"lat":"x","lon":1}},{{"lat":39,"lng":-77}}]' END
  || ',"v5_processed_job_data":{{"core_job_title":' || CASE WHEN ord % 8 = 5 THEN '""' ELSE '"' || title || '"' END || ',"company_name":"' || company || '"'
  || CASE WHEN ord % 12 = 7 THEN '' ELSE ',"yearly_min_compensation":' || {_PAY.format("comp_min")} END || ',"yearly_max_compensation":' || {_PAY.format("comp_max")}
  || ',"workplace_cities":' || {_CITY_LIST} || ',"job_category":' || {_OPT.format("job_category")} || ',"seniority_level":' || {_OPT.format("seniority_level")}
  || ',"role_type":' || {_OPT.format("role_type")} || ',"position_employer_type":"' || employer_type || '","min_industry_and_role_yoe":' || CASE WHEN ord % 6 = 0 THEN 'null' WHEN ord % 6 = 1 THEN '2.9' WHEN ord % 6 = 2 THEN '"3"' ELSE CAST(ord % 6 AS STRING) END
  || ',"listed_compensation_frequency":' || {_OPT.format("comp_frequency")} || ',"is_compensation_transparent":' || CASE WHEN ord % 3 = 0 THEN 'true' WHEN ord % 3 = 1 THEN '1' ELSE 'false' END
  || ',"commitment":' || {_LIST.format("commitment")} || ',"security_clearance":' || {_OPT.format("security_clearance")} || ',"licenses_or_certifications":' || {_LIST.format("certifications")}
  || ',"requirements_summary":" ' || requirements || ' ","technical_tools":' || {_LIST.format("tools")} || ',"air_travel_requirement":' || {_OPT.format("air_travel")}
  || ',"estimated_publish_date":' || CASE WHEN published_at = '' THEN '20240101' ELSE '"' || published_at || '"' END || '}}}}'"""

#: Where the items of a page stand in its payload, by page: the known place, two others, or the payload itself.
PAYLOAD = """CASE page % 4
  WHEN 0 THEN '{"pageProps":{"ssrHits":[' || items || ',5,"x"],"ssrTotalCount":' || CAST(page AS STRING) || ',"nbPages":2.5,"counts":"7","accountTotal":true}}'
  WHEN 1 THEN '{"pageProps":{"none":[],"words":["a"],"zeta":[' || items || ',null],"alpha":[{"objectID":"other"}],"numHits":null,"hitTotal":11}}'
  WHEN 2 THEN '{"hits":[' || items || '],"nbHits":9,"name":"x"}'
  ELSE '{"pageProps":{"ssrHits":[],"alpha":[{"objectID":"other"}],"jobCount":3}}' END"""
_ITEM = """'{"objectID":"e' || CAST(event_id AS STRING) || '"}'"""


def _records(spark: SparkSession, sf: str) -> DataFrame:
    """The raw records as JSON lines in files, read back."""
    path = new_path(spark, "raw")
    raw_postings(spark, sf).select(F.expr(LINE).alias("line")).write.option("compression", "gzip").text(path)
    return jsonl.read(spark, path)


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    """(search, page, payload): result pages of events."""
    e = table(spark, sf, "events").select((F.col("event_id") % 3).alias("search"), F.floor(F.col("event_id") / 150).alias("page"), "event_id", F.expr(_ITEM).alias("item"))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda x: x["item"]), ",")
    return e.groupBy("search", "page").agg(items.alias("items")).select("search", "page", F.expr(PAYLOAD).alias("payload"))


def raw_project(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records, from lines in files to the flat schema."""
    flat = postings.project(_records(spark, sf))
    lists = [f.name for f in flat.schema if f.dataType.typeName() == "array"]
    return flat.select(*[(F.array_join(c, "|") if c in lists else F.col(c)).alias(c) for c in COLUMNS])


def raw_keys(spark: SparkSession, sf: str) -> DataFrame:
    """How many records each identity has, and which have none."""
    keyed = _records(spark, sf).select(record_key(F.col("record")).alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def raw_companies(spark: SparkSession, sf: str) -> DataFrame:
    """Companies out of raw records: what the rollup reads, drops and counts."""
    rows = rollup.judged(rollup.company_inputs(_records(spark, sf)), OPTIONS)
    each = F.array_join(F.transform("places", lambda p: F.concat_ws("@", p["label"], F.round(p["distance_miles"], 1).cast("string"))), "|")
    return rows.groupBy(
        "key", F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason"), each.alias("places"), "enriched_name", F.coalesce("title", F.lit("-")).alias("title"), "profile"
    ).agg(F.count(F.lit(1)).alias("n"))


def raw_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of a raw run."""
    return diagnostics.coverage(_records(spark, sf))


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """What the fields of a raw run differ in from those that the projection reads."""
    return postings.drift(_records(spark, sf))


def page_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records out of result pages, wherever they stand in the payload."""
    found = pages.records(_pages(spark, sf))
    return found.select("search", "page", "pos", record_key(F.col("record")).alias("key"))


def sql_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``page_records`` in SQL alone, by the registered table function."""
    registered.register(spark)
    return spark.sql(
        "SELECT search, page, pos, wk_record_key_of(record) AS key FROM {pages}, LATERAL wk_page_rows(payload) WHERE startswith(schema_of_variant(record), 'OBJECT')", pages=_pages(spark, sf)
    )


def page_totals(spark: SparkSession, sf: str) -> DataFrame:
    """What the pages report as totals."""
    found = _pages(spark, sf).select("search", "page", F.explode(pages.reported_totals(F.col("payload"))).alias("name", "value"))
    return found


def capture_files(spark: SparkSession, sf: str) -> DataFrame:
    """Captured pages of several searches, one file each, read back: the latest of each page, and whether the last was reached."""
    e = table(spark, sf, "events").select(
        (F.col("user_id") % 20).alias("s"), "event_id",
        F.concat(
            F.lit('{"searchState":{"q":"s'), (F.col("user_id") % 20).cast("string"), F.lit('","dateFetchedPastNDays":'), (F.col("user_id") % 20).cast("string"), F.lit('},"page":'),
            (F.col("event_id") % 13).cast("string"), F.lit(',"captured_at":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('","payload":{"pageProps":{"ssrHits":['),
            F.when(F.col("event_id") % 13 == 12, F.lit("")).otherwise(F.expr(_ITEM)), F.lit("]}}}"),
        ).alias("page"),
    )
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "page"))), lambda x: x["page"]), ",")
    end = F.concat(F.lit('],"ends":[{"searchState":{"q":"s'), F.col("s").cast("string"), F.lit('","dateFetchedPastNDays":'), F.col("s").cast("string"), F.lit('},"page":11,"reason":"no next"}]}'))
    files = e.groupBy("s").agg(listed.alias("p")).select(F.concat(F.lit('{"format":"x-capture/1","pages":['), F.col("p"), end).alias("value"))
    path = new_path(spark, "captures")
    files.repartition(20).write.text(path)
    found, ends = captures.read(spark, f"{path}/part-*")
    latest = capture.latest_pages(found)
    done = capture.complete(latest, pages.records(latest.select("state", "page", "payload")), capture.end_markers(ends))
    return capture.summary(latest).join(done, "state").select("state", "pages", "last_page", "last_page_records", "complete", F.round("span_hours", 6).alias("span_hours"), F.array_join("missing", ",").alias("missing"))


def visit_log(spark: SparkSession, sf: str) -> DataFrame:
    """The visit log from its files, of up to 1,000 entries each: hosts, postings and unusable keys."""
    c = table(spark, sf, "customer")
    key = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("job:O"), F.col("c_custkey").cast("string"))).when(F.col("c_custkey") % 10 == 1, F.concat(F.lit("local"), F.col("c_custkey").cast("string")))
    key = key.otherwise(F.concat(F.lit("https://WWW."), F.replace("c_name", F.lit("#"), F.lit("-")), F.lit(".example.com/")))
    mark = F.element_at(F.array(*[F.lit(x) for x in ('{"date":"2024-01-01","r":true}', '{"date":"2024-01-02","r":"true"}', '{"r":false}', '"seen"', "null")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    entry = F.concat(F.lit('"'), key, F.lit('":'), mark)
    path = new_path(spark, "visits")
    files = c.groupBy(F.floor(F.col("c_custkey") / 1000).alias("file")).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("value"))
    files.write.partitionBy("file").text(path)
    log = visitlog.read(spark, f"{path}/file=*")
    return visited.split_log(log).groupBy("kind", "host", "applied").agg(F.count(F.lit(1)).alias("n"))


BLOCK_PAGES = 200


def connector_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The page counts of three searches whose pages are read through the data source, from files of landed pages."""
    key = F.when(F.col("event_id") % 41 != 0, F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_type")))
    item = F.to_json(F.struct(key.alias("objectID"), F.col("event_id").alias("nth")))  # no objectID where there is no key
    e = table(spark, sf, "events").select((F.col("event_id") % 3).cast("int").alias("search"), F.floor(F.col("event_id") / 150).alias("page"), "event_id", item.alias("item"))
    items = e.groupBy("search", "page").agg(F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("i"))  # fifty a page
    payload = F.concat(F.lit('{"pageProps":{"ssrHits":['), F.array_join(F.transform("i", lambda x: x["item"]), ","), F.lit("]}}"))
    folder = new_path(spark, "landed-pages")
    block = F.floor(F.col("page") / BLOCK_PAGES).alias("block")
    items.select("search", block, "page", payload.alias("payload")).repartition("search", "block").write.partitionBy("search", "block").json(folder)
    searches = [{"search": i} for i in range(3)]
    read = durable(fetch.fetch(spark, searches, f"{fetch.__name__}:from_files", folder=folder, block_pages=BLOCK_PAGES, max_pages=1 << 40))
    pages.check(read)
    found = pages.records(read.select("search", "page", "payload")).withColumn("key", record_key(F.col("record")))
    return scrape.page_counts(durable(scrape.land(found.drop("record"), read)))
