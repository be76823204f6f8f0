"""Postings derived from the star-schema tables, for queries on data that has no postings.

``POSTINGS`` is SQL that Spark and DuckDB read alike, so a query and its SQL start from the same rows.
Lists are strings joined with bars; ``split_lists`` makes them arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hosts import normalize_host
from ..functions.keys import fallback_key
from ..tables import small_methods, spread


def pick(by: str, values: list[str | None]) -> str:
    """A CASE that deals the values out by an integer expression."""
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE ({by}) % {len(values)} {arms} END"


TITLES = [
    "Backend Engineer", "Software Engineer", "Sales Engineer", "Data Analyst", "Full Stack Developer", "Embedded Engineer",
    "Platform Engineer", "Network Engineer", "Research Scientist", "Engineering Manager", "Solutions Engineer", "DevOps Engineer",
    "Firmware Engineer", "System Administrator", "Analytics Engineer", "Web Developer",
]
LEVELS = ["", "Senior ", "Sr. ", "", "Staff ", "Junior ", "Principal ", "Lead "]
NUMBERS = ["", " II", " 3", "", " (L4)", "", " - III", " 2_5"]
TOOLS = [
    "Python|AWS|Docker|Kubernetes|Kafka|Spark|Go", "Java|Spring|Postgres", "JavaScript|React", "AutoCAD|SolidWorks", "Active Directory|Citrix|VMware",
    "FedRAMP|NIST 800|STIG", "Terraform|Helm|Istio", "", "C++|Linux", "Excel", "Scala|Airflow|Snowflake",
]
SOURCES = ["grnhse", "lever", "adp", "taleo_rss", "oraclecloud", "adhoc", "usagov", "gr8people", "silkroad", "paycom", "pageup", "workday", "other"]
URLS = [
    "https://Boards.Vendor.example/acme/jobs/1", " https://jobs.vendor.example/firm-x/2?lever=1#top", "https://pay.vendor.example/r/recruitment.html?cid=a b%26c&ccId=9&jobId=7&cid=",
    "https://tal.vendor.example/careersection/requisition.jsp?org=ACME&cws=37&rid=5", "https://ora.vendor.example/hcmUI/CandidateExperience/en/sites/CX_1/job/300",
    "https://site.example.org/", "ftp://files.example.org/x", "", "http://user@host.example.net:8080/a/b/c?x=1",
]
PHRASES = [
    "build backend services in python and go", "own the data platform and its pipelines", "manage a team of 5 and run performance reviews",
    "support customers with direct reports of issues", "requires active clearance ts/sci", "design rest apis", "",
]
CITIES = [
    "Reston, Virginia, US|College Park, Maryland, US", "Boulder, Colorado, US", "Reston, Virginia, US", "", "Denver, Colorado, US|Reston, Virginia, US|Austin, Texas, US|Seattle, Washington, US|Boston, Massachusetts, US",
    "Baltimore, Maryland, US", "Remote",
]

POSTINGS = f"""
SELECT o_orderkey AS ord,
  'o' || CAST(o_orderkey AS STRING) AS object_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'cl' || CAST(c_custkey % 700 AS STRING) END AS cluster_key,
  {pick("o_orderkey", TITLES)} AS title,
  {pick("c_custkey", LEVELS)} || {pick("o_orderkey", TITLES)} || {pick("o_orderkey + c_custkey", NUMBERS)} AS raw_title,
  c_name AS company,
  CASE WHEN c_custkey % 9 = 0 THEN NULL
    WHEN c_custkey % 31 = 1 THEN 'HTTPS://WWW.agency' || CAST(c_custkey AS STRING) || '.Gov/jobs'
    ELSE ' https://www.' || lower(replace(c_name, '#', '-')) || '.example.com:443/about?x=1 ' END AS homepage,
  {pick("o_orderkey", ["Software Development", "Sales", "Data", None])} AS job_category,
  {pick("c_custkey", ["Senior Level", "Entry Level", None, "Mid Level"])} AS seniority_level,
  {pick("o_orderkey + c_custkey", ["Individual Contributor", "People Manager", None])} AS role_type,
  {pick("c_custkey", ["Direct", "Direct", "External Position", "Direct", "Direct"])} AS employer_type,
  {pick("c_custkey", CITIES)} AS cities,
  CASE WHEN o_totalprice > 600000 OR o_totalprice < 25000 THEN NULL WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 0.7) AS INT) END AS comp_min,
  CASE WHEN o_totalprice > 600000 OR o_totalprice < 25000 THEN NULL WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(floor(o_totalprice) AS INT) END AS comp_max,
  {pick("o_orderkey", ["Yearly", "Hourly", None])} AS comp_frequency,
  {pick("o_orderkey", ["Full Time", "Full Time", "Full Time|Contract", "Part Time", "Full Time", "Full Time", "Full Time", "Full Time"])} AS commitment,
  {pick("o_orderkey + c_custkey", [None, "None", "Other", "Public Trust", "None", "Secret", None, "None"])} AS security_clearance,
  {pick("c_custkey", ["", "", "AWS Certified", "Top Secret eligible", ""])} AS certifications,
  {pick("c_custkey", PHRASES)} || ' ' || {pick("o_orderkey", PHRASES)} AS requirements,
  {pick("o_orderkey + 3 * c_custkey", TOOLS)} AS tools,
  {pick("c_custkey", [None, "Minimal", "Moderate", "Extensive", "None"])} AS air_travel,
  {pick("o_orderkey", SOURCES)} AS source,
  {pick("c_custkey + o_orderkey", URLS)} AS apply_url,
  CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS published_at,
  o_orderkey % 29 = 0 AS is_expired
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
"""

#: The same rows in DuckDB, as a WITH clause to build on.
SQL = "WITH p AS (" + POSTINGS.format(orders="orders", customer="customer") + ")"
LISTS = ["cities", "commitment", "certifications", "tools"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived rows as they are, with lists as strings."""
    small_methods(spark)
    return spark.sql(POSTINGS, orders=spread(table(spark, sf_dir, "orders")), customer=table(spark, sf_dir, "customer"))


def split_list(name: str):
    return F.array_remove(F.split(F.coalesce(F.col(name), F.lit("")), r"\|"), "")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived rows with arrays, hosts and keys, ready for the operators."""
    p = raw_postings(spark, sf_dir).withColumns({c: split_list(c) for c in LISTS})
    return p.withColumns(
        {
            "company_host": normalize_host(F.col("homepage")), "city_count": F.size("cities"), "duplicate_count": F.lit(1),
            "fallback_key": fallback_key(F.col("company"), F.col("title"), F.col("cities")),
            "alternate_object_ids": F.array().cast("array<string>"), "alternate_apply_urls": F.array().cast("array<string>"),
        }
    )
