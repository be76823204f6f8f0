"""DuckDB SQL with the rows of each query, written apart from the Spark code: from the rules, not from the plans."""

from __future__ import annotations

from .. import fixed
from ..operators.postings import OBJECTS, READ_FIELDS
from .base import SQL as P
from .raw import LINE, PAYLOAD

SP = r"[\s\x{a0}]"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SP}+', ''), '{SP}+$', '')"


def host(x: str) -> str:
    net = f"regexp_extract(CASE WHEN contains({strip(x)}, '//') THEN {strip(x)} ELSE '//' || {strip(x)} END, '^(?:[a-zA-Z][a-zA-Z0-9+.\\-]*:)?//([^/?#]*)', 1)"
    bare = f"lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace({net}, '^.*@', ''), ':.*$', ''), '^\\.+', ''), '\\.+$', ''))"
    return f"nullif(regexp_extract({bare}, '^(?:www\\.)?(.*\\..*)$', 1), '')"


def listed(x: str) -> str:
    return f"list_filter(string_split(coalesce({x}, ''), '|'), lambda v: v <> '')"


def texts(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def says(x: str, pattern: str) -> str:
    """Case-insensitive search; the one look-ahead (java, not javascript) is a replacement."""
    if "(?!" in pattern:
        plain = pattern.replace("java(?!script)", "java")
        return f"regexp_matches(replace(lower(coalesce({x}, '')), 'javascript', '~'), '{plain}')"
    return f"regexp_matches(lower(coalesce({x}, '')), '{pattern}')"


TOKENS = "list_distinct(regexp_extract_all(lower(coalesce({}, '')), '" + fixed.TOKEN + "'))"
EMPTY = "CAST([] AS VARCHAR[])"


def level(x: str) -> str:
    word = f"list_transform(regexp_extract_all(lower({x}), '{fixed.LEVEL_WORD}'), lambda w: CASE WHEN w IN ('senior', 'snr') THEN 'sr' WHEN w = 'junior' THEN 'jr' ELSE w END)"
    parts = f"list_transform(regexp_split_to_array(lower({x}), '[\\s\\-(),/]+'), lambda t: regexp_extract(t, '^[lt]?(i{{1,3}}|iv|vi{{0,3}}|[1-5](?:[._]\\d)?)$', 1))"
    number = f"list_transform(list_filter({parts}, lambda n: n <> ''), lambda n: replace(n, '_', '.'))"
    return f"array_to_string(list_sort(list_distinct(list_concat({word}, {number}))), '+')"


def senior(x: str) -> str:
    return f"list_has_any(string_split({level(x)}, '+'), [{texts(fixed.SENIOR_LEVELS)}])"


SQL: dict[str, str] = {}

SQL["host_norm"] = f"SELECT page_id, {host('url')} AS host FROM pages"
SQL["host_counts"] = f"""
SELECT host, count(*) AS n, max(page_id) AS latest, arg_min(url, (length(url), page_id)) AS best_url
FROM (SELECT *, {host('url')} AS host FROM pages) WHERE host IS NULL OR NOT (ends_with(host, '.org') OR ends_with(host, '.net')) GROUP BY host"""
SQL["marker_extract"] = """
SELECT page_id, CASE WHEN contains(html, '<title>') AND contains(split_part(html, '<title>', 2), '</title>')
  THEN split_part(split_part(html, '<title>', 2), '</title>', 1) END AS title FROM pages"""
SQL["json_guard"] = """
SELECT event_id, CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
  CASE WHEN json_type(props, '$.k') = 'VARCHAR' THEN nullif(trim(json_extract_string(props, '$.k')), '') END AS k_text,
  coalesce(json_type(props, '$.k') = 'BOOLEAN' AND CAST(json_extract(props, '$.k') AS VARCHAR) = 'true', false) AS k_true
FROM events"""
SQL["money_guard"] = """
SELECT o_orderkey, CASE WHEN a > 25000 AND a < 600000 THEN a END AS amount, a IS NOT NULL AND NOT (a > 25000 AND a < 600000) AS implausible
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS a FROM orders)"""

_ONE = [k for k, n in fixed.PATH_SEGMENTS.items() if n == 1]
_TWO = [k for k, n in fixed.PATH_SEGMENTS.items() if n == 2]
LINKS = f"""
u AS (
  SELECT *, lower(regexp_extract(trim(apply_url), '^([a-zA-Z][a-zA-Z0-9+.\\-]*)://', 1)) AS scheme,
    regexp_extract(trim(apply_url), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1) AS net,
    regexp_extract(trim(apply_url), '^[a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM p
), s AS (SELECT *, list_filter(string_split(path, '/'), lambda v: v <> '') AS seg FROM u),
q AS (
  SELECT *, CASE
    WHEN net = '' OR scheme NOT IN ('http', 'https') OR apply_url IS NULL THEN 'none'
    WHEN source = 'oraclecloud' THEN CASE WHEN list_position(seg, 'sites') > 0 AND list_position(seg, 'sites') < len(seg) THEN 'host_and_segments' ELSE 'posting' END
    WHEN source IN ({texts(list(fixed.BOARDS))}) THEN 'board'
    WHEN source IN ({texts(fixed.POSTING_ONLY)}) THEN 'posting'
    WHEN source IN ({texts(_ONE)}) AND len(seg) >= 1 OR source IN ({texts(_TWO)}) AND len(seg) >= 2 THEN 'host_and_segments'
    ELSE 'host' END AS tier FROM s
), kept AS (
  SELECT *, list_filter(list_transform(string_split(regexp_extract(trim(apply_url), '[?]([^#]*)', 1), '&'), lambda v:
    {{'k': url_decode(split_part(v, '=', 1)), 'v': url_decode(replace(CASE WHEN contains(v, '=') THEN substr(v, strpos(v, '=') + 1) ELSE '' END, '+', ' '))}}),
    lambda e: e.v <> '' AND CASE source WHEN 'adp' THEN e.k IN ('cid', 'ccId') WHEN 'paycom' THEN e.k = 'clientkey' WHEN 'taleo_rss' THEN e.k IN ('org', 'cws') ELSE false END) AS params FROM q
), link AS (
  SELECT *, CASE tier WHEN 'none' THEN NULL WHEN 'posting' THEN apply_url WHEN 'host' THEN scheme || '://' || net || '/'
    WHEN 'host_and_segments' THEN scheme || '://' || net || '/' || CASE WHEN source = 'oraclecloud'
        THEN array_to_string(seg[:list_position(seg, 'sites') + 1], '/') || '/requisitions'
        ELSE array_to_string(seg[:CASE WHEN source IN ({texts(_TWO)}) THEN 2 ELSE 1 END], '/') || '/' END
    ELSE scheme || '://' || net || CASE source WHEN 'paycom' THEN '/v4/ats/web.php/jobs' WHEN 'taleo_rss' THEN regexp_replace(path, 'requisition\\.jsp$', 'jobSearch.jsp') ELSE path END
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_transform(params, lambda e: e.k || '=' || replace(url_encode(e.v), '%20', '+')), '&') ELSE '' END
    END AS careers_url FROM kept
)"""
SQL["careers_tiers"] = f"""
{P}, {LINKS}, h AS (
  SELECT *, {host('homepage')} AS h, {host("regexp_extract(careers_url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)")} AS link_host FROM link
)
SELECT ord, careers_url, tier, CASE WHEN h IS NULL THEN NULL WHEN link_host = h OR ends_with(link_host, '.' || h) THEN careers_url ELSE 'https://' || h END AS entry_url FROM h"""
SQL["level_signatures"] = f"{P} SELECT ord, {level('raw_title')} AS level, {senior('raw_title')} AS senior FROM p"
SQL["token_counts"] = f"SELECT doc_id, len({TOKENS.format('text')}) AS n_tokens FROM documents"
SQL["haversine"] = """
SELECT s_suppkey, round(6371000.0 * 2 * asin(sqrt(pow(sin(radians(lat - 38.9531) / 2), 2)
  + cos(radians(38.9531)) * cos(radians(lat)) * pow(sin(radians(lon + 77.4565) / 2), 2))) / 1609.344, 4) AS miles
FROM (SELECT s_suppkey, CAST(s_suppkey % 90 - 45.5 AS DOUBLE) AS lat, CAST(s_suppkey * 7 % 360 - 180.25 AS DOUBLE) AS lon FROM supplier)"""
ESCAPED = "replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
SQL["html_escape"] = f"""
SELECT page_id, {ESCAPED.format("coalesce(html, '')")} AS escaped FROM pages"""
SQL["url_quote"] = "SELECT p_partkey, replace(url_encode(p_name || ' *~b/&'), '%20', '+') AS quoted FROM part"
SQL["match_keys"] = f"""
{P} SELECT ord, array_to_string(list_sort(list_filter(['id:' || object_id, 'id:x' || object_id, 'cluster:' || cluster_key], lambda v: v IS NOT NULL)), ',') AS match_keys FROM p"""

LANDED = """
WITH r AS (
  SELECT event_id % 3 AS search, CAST(floor(event_id / 150) AS BIGINT) AS page, event_id AS pos,
    CASE WHEN event_id % 41 = 0 THEN NULL ELSE user_id || '-' || event_type END AS key FROM events
), m AS (
  SELECT *, key IS NULL OR row_number() OVER (PARTITION BY search, key ORDER BY page, pos) = 1 AS is_new FROM r
), c AS (SELECT search, page, count(*) FILTER (WHERE is_new) AS new FROM m GROUP BY search, page),
l AS (SELECT *, lag(new) OVER (PARTITION BY search ORDER BY page) AS before FROM c),
st AS (SELECT search, coalesce(min(page) FILTER (WHERE new = 0 AND before = 0), max(page)) AS stop_page FROM l GROUP BY search),
k AS (SELECT m.*, stop_page FROM m JOIN st USING (search) WHERE page <= stop_page),
w AS (SELECT *, is_new AND (key IS NULL OR row_number() OVER (PARTITION BY key ORDER BY search, page, pos) = 1) AS written FROM k)
"""
SQL["page_counts"] = LANDED + "SELECT search, page, count(*) AS received, count_if(is_new) AS new, count_if(written) AS written FROM w GROUP BY search, page"
SQL["search_counts"] = LANDED + """SELECT search, max(stop_page) AS stop_page, count(*) AS received, count_if(is_new) AS unique_records,
  count_if(is_new AND NOT written) AS overlap, count_if(key IS NULL) AS keyless FROM w GROUP BY search"""
SQL["run_gaps"] = """WITH s AS (
  SELECT user_id AS search, CAST(ts AS DATE) - CAST(event_id % 5 AS INT) AS b, max(CAST(ts AS DATE)) AS e FROM events GROUP BY ALL
), g AS (
  SELECT search, max(e) OVER (PARTITION BY search ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS f, b - 1 AS l, max(e) OVER (PARTITION BY search) AS latest FROM s
)
SELECT search, CAST(unnest(generate_series(f, l, INTERVAL 1 DAY)) AS DATE) AS day, CAST(latest - f AS INT) AS closing_window FROM g WHERE f <= l"""
SQL["search_union"] = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 0 WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS search FROM orders"
LATEST = """
WITH latest AS (
  SELECT user_id % 50 AS state, (event_id % 13) * 4 // 3 AS page, event_id AS pos, ts, value FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id % 50, event_id % 13 ORDER BY ts DESC, event_id DESC) = 1
) """
SQL["latest_capture"] = LATEST + "SELECT state, page, pos, value FROM latest"
SQL["capture_summary"] = LATEST + """
SELECT state, count(*) AS pages, max(page) AS last_page, round((epoch_us(max(ts)) - epoch_us(min(ts))) / CAST(3.6e9 AS DOUBLE), 6) AS span_hours,
  array_to_string(list_filter(range(0, max(page) + 1), lambda v: NOT list_contains(list(page), v)), ',') AS missing FROM latest GROUP BY state"""

# --- companies
NEWER = "list_transform(list_filter(string_split({}, ''), lambda ch: ch <> ''), lambda ch: -ord(ch))"
JUDGED = f"""
{P}, {LINKS}, c AS (
  SELECT ord, source, is_expired, {host('homepage')} AS host, {listed('cities')} AS labels, careers_url, tier,
    CASE WHEN ord % 4 = 0 THEN company || CASE WHEN ord % 8 = 0 THEN ' Inc' ELSE '' END END AS enriched, company AS posting_name,
    CASE WHEN ord % 6 = 0 THEN object_id END AS profile, coalesce(job_category, 'Unknown') AS category, published_at, title
  FROM (SELECT * REPLACE (CASE WHEN tier = 'posting' THEN {strip('apply_url')} ELSE careers_url END AS careers_url) FROM link)
), pl AS (
  SELECT ord, i, label, CASE WHEN label = 'Remote' THEN NULL ELSE CAST(36.0 + length(label) % 7 AS DOUBLE) END AS lat,
    CASE WHEN len(string_split(label, ',')) >= 3 THEN trim(string_split(label, ',')[-2]) END AS state
  FROM (SELECT ord, unnest(labels) AS label, generate_subscripts(labels, 1) AS i FROM c)
), pd AS (
  SELECT *, 6371000.0 * 2 * asin(sqrt(pow(sin(radians(lat - 38.9531) / 2), 2)
    + cos(radians(38.9531)) * cos(radians(lat)) * pow(sin(radians(-77.5 + 77.4565) / 2), 2))) / 1609.344 AS d FROM pl
), near AS (SELECT * FROM pd WHERE coalesce(lower(state), '') <> 'maryland' AND (d IS NULL OR d <= 150)),
j AS (
  SELECT c.*, coalesce(host, careers_url) AS key, CASE WHEN source = 'usagov' THEN 'excluded_source' WHEN is_expired THEN 'expired'
    WHEN ends_with(host, '.gov') OR ends_with(host, '.mil') THEN 'excluded_website_tld'
    WHEN len(labels) > 0 AND ord NOT IN (SELECT ord FROM near) THEN 'no_qualifying_location'
    WHEN host IS NULL AND careers_url IS NULL THEN 'unidentifiable' END AS drop_reason FROM c
), g AS (SELECT * FROM j WHERE drop_reason IS NULL)"""
COMPANIES = JUDGED + f""", main AS (
  SELECT key, count(*) AS posting_count, min(ord) AS ord, max(host) AS website_host,
    coalesce(arg_min(coalesce(enriched, posting_name), ord) FILTER (WHERE coalesce(enriched, posting_name) IS NOT NULL), max(host), key) AS name,
    arg_min({{'url': careers_url, 'tier': tier}}, (CASE tier WHEN 'host' THEN 0 WHEN 'host_and_segments' THEN 0 WHEN 'board' THEN 1 ELSE 2 END, {NEWER.format('published_at')}, ord))
      FILTER (WHERE careers_url IS NOT NULL) AS careers,
    max(nullif(published_at, '')) AS latest_published_at, array_to_string(list_sort(list(DISTINCT source)), '|') AS sources,
    coalesce(array_to_string(list_sort(list(DISTINCT enriched) FILTER (WHERE enriched IS NOT NULL)), '|'), '') AS observed_names,
    arg_min(profile, ord) FILTER (WHERE profile IS NOT NULL) AS profile FROM g GROUP BY key
), cat AS (
  SELECT key, string_agg(category || '=' || n, ',' ORDER BY category) AS category_counts, coalesce(CAST(sum(n) FILTER (WHERE category = 'Software Development') AS BIGINT), 0) AS software_posting_count
  FROM (SELECT key, category, count(*) AS n FROM g GROUP BY key, category) GROUP BY key
), loc AS (
  SELECT key, round(min(d), 2) AS distance_miles, string_agg(label, '|' ORDER BY d IS NULL, d, o, n, label) AS locations FROM (
    SELECT key, label, min(d) AS d, min((ord, nth))[1] AS o, min((ord, nth))[2] AS n FROM (
      SELECT g.key, g.ord, near.label, near.d, row_number() OVER (PARTITION BY g.ord ORDER BY near.d IS NULL, near.d, near.i) AS nth FROM g JOIN near USING (ord)) GROUP BY key, label) GROUP BY key
), ti AS (
  SELECT key, string_agg(title, '|' ORDER BY n) AS sample_titles FROM (
    SELECT key, title, row_number() OVER (PARTITION BY key ORDER BY other, pub DESC, ord) AS n FROM (
      SELECT key, title, category <> 'Software Development' AS other, published_at AS pub, ord FROM g
      QUALIFY row_number() OVER (PARTITION BY key, title ORDER BY category <> 'Software Development', published_at DESC, ord) = 1)) WHERE n <= 3 GROUP BY key
), co AS (
  SELECT key, name, website_host, careers.url AS careers_url, coalesce(careers.tier, 'none') AS careers_tier, distance_miles, coalesce(locations, '') AS locations, posting_count,
    category_counts, software_posting_count, coalesce(sample_titles, '') AS sample_titles, latest_published_at, sources, observed_names, profile, ord
  FROM main JOIN cat USING (key) LEFT JOIN loc USING (key) LEFT JOIN ti USING (key)
)"""
SQL["company_rollup"] = COMPANIES + " SELECT * EXCLUDE (ord) FROM co"
SQL["company_drops"] = JUDGED + " SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM j GROUP BY 1"
SQL["company_tiers"] = COMPANIES + " SELECT careers_tier, count(*) AS n FROM co GROUP BY 1"
SQL["company_ambiguous"] = COMPANIES + " SELECT key, observed_names FROM co WHERE website_host IS NOT NULL AND contains(observed_names, '|')"

VISITS = f"""
, firm AS (SELECT DISTINCT company, {host('homepage')} AS website_host FROM p),
lg AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN 'job:' || c_custkey WHEN c_custkey % 10 = 1 THEN 'localhost'
  ELSE 'https://www.' || lower(replace(c_name, '#', '-')) || '.example.com/' END AS key, c_custkey % 2 = 0 AS applied FROM customer WHERE c_custkey % 3 = 0),
vh AS (SELECT {host('key')} AS host, bool_or(applied) AS applied FROM lg WHERE NOT starts_with(key, 'job:') GROUP BY 1 HAVING {host('key')} IS NOT NULL)
"""
VISITS = VISITS.replace(f" GROUP BY 1 HAVING {host('key')} IS NOT NULL", f" AND {host('key')} IS NOT NULL GROUP BY 1")
SQL["visited_remaining"] = P + VISITS + "SELECT * FROM firm WHERE NOT EXISTS (SELECT 1 FROM vh WHERE vh.host = firm.website_host)"
SQL["visited_excluded"] = P + VISITS + "SELECT firm.*, vh.applied FROM firm JOIN vh ON vh.host = firm.website_host"
SQL["visited_counters"] = P + VISITS + """SELECT count(*) AS companies, count_if(vh.host IS NULL) AS kept, count_if(vh.host IS NOT NULL) AS excluded,
  count_if(coalesce(vh.applied, false)) AS excluded_applied, count_if(website_host IS NULL) AS kept_unmatchable FROM firm LEFT JOIN vh ON vh.host = firm.website_host"""
SQL["subdomain_cover"] = f"""
WITH h AS (SELECT DISTINCT {host('url')} AS host FROM pages) SELECT a.host, b.host AS owner FROM h a JOIN h b ON a.host = b.host OR ends_with(a.host, '.' || b.host)"""

# --- deduplication
JACCARD = "CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE CAST(len(list_intersect({a}, {b})) AS DOUBLE) / len(list_distinct(list_concat({a}, {b}))) END"


def similar(key: str) -> str:
    return f""", mem_{key} AS (
  SELECT {key} AS g, {TOKENS.format('requirements')} AS w, row_number() OVER (PARTITION BY {key} ORDER BY ord) AS i
  FROM q WHERE {key} IS NOT NULL AND trim(requirements) <> ''
), pr_{key} AS (
  SELECT a.g, {JACCARD.format(a='a.w', b='b.w')} AS s FROM mem_{key} a JOIN mem_{key} b ON a.g = b.g AND a.i < b.i
  WHERE a.i <= 16 AND b.i <= 16 QUALIFY row_number() OVER (PARTITION BY a.g ORDER BY a.i, b.i) <= 15
), si_{key} AS (SELECT g, avg(s) AS similarity FROM pr_{key} GROUP BY g)"""


Q = P + f""", q AS (SELECT *, concat_ws('|', company, regexp_replace(lower(trim(title)), '\\s+', ' ', 'g'), array_to_string(list_sort({listed('cities')}), ',')) AS fallback_key FROM p)"""
SQL["cluster_similarity"] = Q + similar("cluster_key") + """
SELECT DISTINCT m.g AS cluster_key, round(similarity, 9) AS similarity FROM mem_cluster_key m LEFT JOIN si_cluster_key USING (g)"""
SQL["calibration"] = Q + similar("cluster_key") + """
, o AS (SELECT list(similarity ORDER BY similarity) AS l, count(*) AS n FROM si_cluster_key),
e AS (SELECT *, greatest(least((10 * (n + 1)) // 100, n - 1), 1) AS j FROM o)
SELECT round(CASE WHEN n < 10 THEN 0.44 ELSE (l[j] * (100 - (10 * (n + 1) - 100 * j)) + l[j + 1] * (10 * (n + 1) - 100 * j)) / 100 END, 9) AS threshold, n AS groups FROM e"""
MERGED = """
, best AS (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY lower(source) = 'adhoc', """ + NEWER.format("published_at") + """, -length(requirements), ord) AS rk FROM {t})
, ag AS (
  SELECT {g} AS k, count(*) AS duplicate_count, arg_min(object_id, rk) AS object_id,
    coalesce(string_agg(object_id, '|' ORDER BY ord) FILTER (WHERE rk > 1), '') AS alternate_object_ids,
    list(nullif(apply_url, '') ORDER BY ord) FILTER (WHERE rk > 1 AND apply_url <> '') AS urls FROM best GROUP BY {g}
), un AS (
  SELECT k, string_agg(u, '|' ORDER BY i) AS alternate_apply_urls FROM (
    SELECT k, u, min(i) AS i FROM (SELECT k, unnest(urls) AS u, generate_subscripts(urls, 1) AS i FROM ag) GROUP BY k, u) GROUP BY k
)"""
SQL["cluster_merge"] = Q + ", t AS (SELECT * FROM q WHERE cluster_key IS NOT NULL)" + MERGED.format(g="cluster_key", t="t") + """
SELECT k AS cluster_key, object_id, duplicate_count, alternate_object_ids, coalesce(alternate_apply_urls, '') AS alternate_apply_urls FROM ag LEFT JOIN un USING (k)"""
SQL["candidate_keys"] = Q + similar("cluster_key") + similar("fallback_key") + similar("company") + " UNION ALL ".join(
    f"""{' ' if i else ''} SELECT '{k}' AS key, count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS merged, count_if(similarity >= 0.44) AS believable, count_if(similarity < 0.44) AS suspicious
FROM (SELECT {k} AS g, count(*) AS n FROM q WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) LEFT JOIN si_{k} USING (g)"""
    for i, k in enumerate(["cluster_key", "fallback_key", "company"])
)
_QUARTILES = ", ".join(
    f"round((l[{j}] * (100 - ({q} * (n + 1) - 100 * {j})) + l[{j} + 1] * ({q} * (n + 1) - 100 * {j})) / 100, 9) AS q{q // 25}"
    for q in (25, 50, 75) for j in [f"CAST(greatest(least(({q} * (n + 1)) // 100, n - 1), 1) AS INT)"]
)
SQL["truth_similarity"] = Q + similar("cluster_key") + f""", o AS (SELECT list(similarity ORDER BY similarity) AS l, count(similarity) AS n, avg(similarity) AS m FROM si_cluster_key)
SELECT (SELECT count(*) FROM (SELECT 1 FROM q WHERE cluster_key IS NOT NULL GROUP BY cluster_key HAVING count(*) > 1)) AS groups, n AS scored,
  round(m, 9) AS mean, round(l[1], 9) AS low, round(l[-1], 9) AS high, {_QUARTILES} FROM o"""
SQL["key_skew"] = P + """, x AS (SELECT cluster_key IS NOT NULL AS keyed, unnest([{'field': 'source', 'value': source}, {'field': 'job_category', 'value': job_category}], recursive := true) FROM p)
SELECT keyed, field, value, count(*) AS n, CAST(row_number() OVER (PARTITION BY keyed, field ORDER BY count(*) DESC, value NULLS FIRST) AS INT) AS nth FROM x GROUP BY keyed, field, value QUALIFY nth <= 4"""
SQL["worst_merges"] = Q + similar("company") + """, w AS (SELECT g, round(similarity, 9) AS similarity FROM si_company WHERE similarity < 0.44 ORDER BY 2, g LIMIT 6)
SELECT company, similarity, count(*) AS n, count(DISTINCT source) AS source, count(DISTINCT cities) AS cities, count(DISTINCT published_at) AS published_at FROM q JOIN w ON g = company GROUP BY company, similarity"""
SQL["key_structure"] = P + """ SELECT CAST(sum(n) AS BIGINT) AS present, count(*) AS distinct_keys, count_if(n > 1) AS multi, CAST(sum(n - 1) AS BIGINT) AS merged
FROM (SELECT cluster_key, count(*) AS n FROM p WHERE cluster_key IS NOT NULL GROUP BY 1)"""

# --- screening
_TOOLS = "replace(tools, '|', ' | ')"
_FLAG = "coalesce(role_type = 'People Manager', false)"
_TITLED = f"({says('title', fixed.MANAGEMENT_TITLE)} OR {says('raw_title', fixed.MANAGEMENT_TITLE)})"
_MANAGES = f"({_FLAG} AND ({_TITLED} OR {says('requirements', fixed.MANAGEMENT_LANGUAGE)}))"
_BACKEND, _BUILDS = says(_TOOLS, fixed.BACKEND_TOOLS), says(_TOOLS, fixed.BUILD_TOOLS)
_HAY = "concat_ws(' ', replace(certifications, '|', ' | '), requirements, title, raw_title)"
_REJECT = [
    ("expired", "is_expired"),
    ("public-sector source", f"lower(source) IN ({texts(fixed.PUBLIC_SECTOR_SOURCES)})"),
    ("gov/mil/edu domain", "regexp_matches(company_host, '\\.(gov|mil|edu)$')"),
    ("not full-time", f"NOT list_contains({listed('commitment')}, 'Full Time')"),
    ("clearance field", f"security_clearance NOT IN ({texts(fixed.HARMLESS_CLEARANCES)})"),
    ("clearance in text", says(_HAY, fixed.CLEARANCE)),
    ("staffing placement", "employer_type = 'External Position'"),
    ("people manager", _MANAGES),
    ("non-software discipline", f"{says(_TOOLS, fixed.NON_SOFTWARE_TOOLS)} AND NOT {_BACKEND}"),
    ("full-stack/frontend title", says("title", fixed.FRONTEND_TITLE)),
    ("blocked company", "lower(company) = 'customer#000000007'"),
    ("comp below floor", "comp_max < 120000"),
]
_DEMOTE = [
    ("uncorroborated people-manager flag", f"{_FLAG} AND NOT {_MANAGES}"),
    ("customer-facing title", says("title", fixed.CUSTOMER_FACING_TITLE)),
    ("analyst/research title", f"{says('title', fixed.ANALYST_TITLE)} AND NOT {says('title', fixed.ENGINEERING_TITLE)}"),
    ("hardware/physical title", says("title", fixed.HARDWARE_TITLE)),
    ("network/IT ops title", says("title", fixed.OPS_TITLE)),
    ("frequent air travel", f"air_travel IN ({texts(fixed.FREQUENT_AIR_TRAVEL)})"),
    ("compliance/GRC tooling", f"NOT {_BUILDS} AND {says(_TOOLS, fixed.GRC_TOOLS)}"),
    ("IT-admin tooling", f"NOT {_BUILDS} AND {says(_TOOLS, fixed.IT_ADMIN_TOOLS)}"),
    ("band bottom below floor", "comp_min < 70000"),
    ("geo-tiered pay band", f"len({listed('cities')}) >= 5"),
]


def _labels(rules: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in rules) + "], lambda v: v IS NOT NULL)"


SCREENED = P + f""", h AS (SELECT *, {host('homepage')} AS company_host FROM p),
ruled AS (SELECT *, {_labels(_REJECT)} AS rejects, {_labels(_DEMOTE)} AS demoted FROM h),
strong AS (SELECT *, {_BACKEND} AND len(demoted) = 0 AND (coalesce(seniority_level = 'Senior Level', false) OR {senior('raw_title')} OR coalesce(comp_max >= 120000, false)) AS strong FROM ruled),
v AS (SELECT *, CASE WHEN len(rejects) > 0 THEN 'rejected' WHEN strong THEN 'strong' ELSE 'possible' END AS band, rejects = ['comp below floor'] AND strong AS near_miss FROM strong)
"""
SQL["screen_bands"] = SCREENED + "SELECT ord, band, near_miss, array_to_string(rejects, '; ') AS reject_reasons, CASE WHEN len(rejects) > 0 THEN '' ELSE array_to_string(demoted, '; ') END AS demote_reasons FROM v"
SQL["reason_counts"] = SCREENED + "SELECT reason, count(*) AS n FROM (SELECT unnest(rejects) AS reason FROM v) GROUP BY reason"
SQL["sole_reasons"] = SCREENED + "SELECT rejects[1] AS reason, count(*) AS n FROM v WHERE len(rejects) = 1 GROUP BY 1"
SQL["screen_funnel"] = SCREENED + """SELECT count(*) AS scraped, CAST(0 AS BIGINT) AS duplicates, count(*) AS screened, count_if(band = 'rejected') AS rejected, count_if(band = 'strong') AS strong,
  count_if(band = 'possible') AS possible, count_if(near_miss) AS near_misses FROM v"""
SQL["flag_audit"] = SCREENED + f"""SELECT {_FLAG} AS manager_flag, {_TITLED} AS manager_title, coalesce(seniority_level = 'Senior Level', false) AS senior_field, {senior('raw_title')} AS senior_title,
  count(*) AS n FROM v GROUP BY ALL"""

# --- the seen store
STORE = SCREENED + f""", st AS (
  SELECT object_id, list_sort(list_filter(['id:' || object_id, CASE WHEN ord % 8 = 0 THEN 'id:o' || (ord + 1) END, 'cluster:' || cluster_key], lambda x: x IS NOT NULL)) AS keys,
    CASE WHEN ord % 4 = 0 THEN 'possible' ELSE 'strong' END AS band, ord AS put_seq, title, company, coalesce(company_host, '') AS company_host FROM v WHERE ord % 2 = 0
), ow AS (SELECT key, arg_max(object_id, (company, put_seq)) AS owner FROM (SELECT object_id, company, put_seq, unnest(keys) AS key FROM st) GROUP BY key)
"""
SQL["seen_diff"] = STORE + """, n AS (
  SELECT ord, band, unnest(list_filter(['id:' || object_id, 'cluster:' || cluster_key], lambda x: x IS NOT NULL)) AS key FROM v WHERE band <> 'rejected'
), f AS (SELECT n.ord, any_value(n.band) AS band, arg_min(ow.owner, key) FILTER (WHERE ow.owner IS NOT NULL) AS owner FROM n LEFT JOIN ow USING (key) GROUP BY n.ord)
SELECT ord, owner, CASE WHEN owner IS NULL THEN 'new' WHEN f.band = 'strong' AND st.band = 'possible' THEN 'promoted' ELSE 'suppressed' END AS action
FROM f LEFT JOIN st ON st.object_id = f.owner"""
SQL["visit_labels"] = STORE + """, ids AS (SELECT object_id, substr(k, 4) AS id FROM (SELECT object_id, unnest(keys) AS k FROM st) WHERE starts_with(k, 'id:')),
mk AS (SELECT i.object_id, bool_or(o_orderkey % 2 = 0) AS applied FROM ids i JOIN orders ON i.id = 'o' || o_orderkey AND o_orderkey % 7 = 0 GROUP BY 1)
SELECT st.object_id, mk.object_id IS NOT NULL AS opened, coalesce(mk.applied, false) AS applied,
  coalesce(EXISTS (SELECT 1 FROM customer c WHERE c_custkey % 5 = 0 AND lower(replace(c_name, '#', '-')) || '.example.com' = st.company_host), false) AS company_applied
FROM st LEFT JOIN mk USING (object_id)"""

# --- diagnostics
SQL["daily_histogram"] = P + """, d AS (SELECT substr(published_at, 1, 10) AS day, count(*) AS n FROM p WHERE published_at <> '' GROUP BY 1)
SELECT day, n, repeat('#', greatest(1, CAST(round_even(n / (SELECT max(n) FROM d) * 40, 0) AS INT))) AS bar FROM d"""
SQL["top_sources"] = P + " SELECT source, count(*) AS n FROM p GROUP BY source ORDER BY n DESC, source LIMIT 5"
SQL["coverage"] = P + " SELECT count(*) AS postings, round(avg(CAST(cluster_key IS NOT NULL AS INT)), 4) AS cluster_key_share, count_if(trim(requirements) = '') AS blank_requirements FROM p"

# --- greedy groups, in lockstep: round i takes the i-th member of every group
ALIKE = f"{JACCARD.format(a='a.w', b='m.w')} >= "


def greedy(members: str, by: str, level: str, threshold: float) -> str:
    """CTE ``greedy`` (by, id, anchor): members has by, level, id and tokens w, none of them empty."""
    keys = ", ".join(f"m.{c}" for c in by.split(", "))
    same = " AND ".join(f"m.{c} IS NOT DISTINCT FROM r.{c}" for c in by.split(", "))
    return f"""
m AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {by}, {level} ORDER BY id) AS i FROM {members}),
r AS (
  SELECT {keys}, m.{level}, m.i, m.id, m.id AS anchor, [{{'id': m.id, 'w': m.w}}] AS anchors FROM m WHERE i = 1
  UNION ALL
  SELECT {keys}, m.{level}, m.i, m.id, coalesce(list_filter(r.anchors, lambda a: {ALIKE} {threshold})[1].id, m.id) AS anchor,
    CASE WHEN len(list_filter(r.anchors, lambda a: {ALIKE} {threshold})) > 0 THEN r.anchors ELSE list_append(r.anchors, {{'id': m.id, 'w': m.w}}) END
  FROM r JOIN m ON {same} AND m.{level} IS NOT DISTINCT FROM r.{level} AND m.i = r.i + 1
), greedy AS MATERIALIZED (SELECT {by}, id, anchor FROM r)"""


_DOCS = f"d AS MATERIALIZED (SELECT doc_id AS id, lang, source, doc_id % 3 AS lv, {TOKENS.format('text')} AS w FROM documents), live AS (SELECT * FROM d WHERE len(w) > 0)"
SQL["greedy_dedup"] = f"WITH RECURSIVE {_DOCS}, {greedy('live', 'lang, source', 'lv', 0.44)} SELECT id AS ord, anchor FROM greedy UNION ALL SELECT id, id FROM d WHERE len(w) = 0"

_RQ = Q.replace("WITH p AS", "WITH RECURSIVE p AS", 1)
SQL["representatives"] = (
    _RQ
    + f""", fb AS MATERIALIZED (SELECT ord AS id, fallback_key, {level('raw_title')} AS lv, {TOKENS.format('requirements')} AS w FROM q WHERE cluster_key IS NULL),
live AS (SELECT * FROM fb WHERE len(w) > 0), {greedy('live', 'fallback_key', 'lv', 0.6)},
grouped AS (SELECT fallback_key, id, anchor FROM greedy UNION ALL SELECT fallback_key, id, id FROM fb WHERE len(w) = 0),
numbered AS (SELECT *, dense_rank() OVER (PARTITION BY fallback_key ORDER BY anchor) - 1 AS sub FROM grouped),
t AS (
  SELECT q.*, '0' || cluster_key AS grp, cluster_key AS name FROM q WHERE cluster_key IS NOT NULL
  UNION ALL SELECT q.*, '1' || q.fallback_key || '#' || sub, CASE WHEN sub = 0 THEN q.fallback_key ELSE q.fallback_key || '#' || sub END FROM q JOIN numbered ON q.ord = numbered.id
)"""
    + MERGED.format(g="grp", t="t").replace("SELECT grp AS k,", "SELECT grp AS k, any_value(name) AS dedup_key,")
    + " SELECT object_id, dedup_key, duplicate_count, alternate_object_ids, coalesce(alternate_apply_urls, '') AS alternate_apply_urls FROM ag LEFT JOIN un USING (k)"
)

# --- the store after a run, in lockstep: step i takes the i-th row of every set that shares keys
_FIND = "list_filter(s.es, lambda e: list_contains(e.keys, list_filter(x.keys, lambda k: len(list_filter(s.es, lambda e2: list_contains(e2.keys, k))) > 0)[1]))[-1]"
SQL["store_merge"] = (
    STORE.replace("WITH p AS", "WITH RECURSIVE p AS", 1)
    + """, n AS (
  SELECT ord, band, unnest(list_filter(['id:' || object_id, 'cluster:' || cluster_key], lambda x: x IS NOT NULL)) AS key FROM v WHERE band <> 'rejected'
), f AS (SELECT n.ord, any_value(n.band) AS band, arg_min(ow.owner, key) FILTER (WHERE ow.owner IS NOT NULL) AS owner FROM n LEFT JOIN ow USING (key) GROUP BY n.ord),
act AS (SELECT f.ord, CASE WHEN owner IS NOT NULL AND NOT (f.band = 'strong' AND st.band = 'possible') THEN 2 ELSE 1 END AS phase FROM f LEFT JOIN st ON st.object_id = f.owner),
rows0 AS (
  SELECT 0 AS phase, object_id, keys, band, title, company, put_seq AS ord FROM st
  UNION ALL SELECT phase, object_id, list_sort(list_filter(['id:' || object_id, 'cluster:' || cluster_key], lambda x: x IS NOT NULL)), band, coalesce(nullif(raw_title, ''), title), company, ord FROM v JOIN act USING (ord)
), ck AS (SELECT ord, cluster_key AS c FROM p WHERE cluster_key IS NOT NULL),
-- rows that share a key share this name: a posting's cluster, or that of the one beside it whose id a stored entry has too
placed AS (
  SELECT r.*, coalesce(own.c, after.c, before.c, 'p' || CAST(CASE WHEN r.ord % 8 = 1 THEN r.ord - 1 ELSE r.ord END AS VARCHAR)) AS grp
  FROM rows0 r LEFT JOIN ck own ON own.ord = r.ord LEFT JOIN ck after ON r.ord % 8 = 0 AND after.ord = r.ord + 1 LEFT JOIN ck before ON r.ord % 8 = 1 AND before.ord = r.ord - 1
), x AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY phase, CASE WHEN phase = 0 THEN company END, ord) AS i FROM placed),
"""
    + f"""s AS (
  SELECT grp, 0 AS i, [] :: STRUCT(object_id VARCHAR, keys VARCHAR[], band VARCHAR, f VARCHAR, l VARCHAR, n BIGINT, title VARCHAR, company VARCHAR)[] AS es FROM x WHERE i = 1
  UNION ALL
  SELECT s.grp, x.i, CASE
    WHEN x.phase = 0 THEN list_append(s.es, {{'object_id': x.object_id, 'keys': x.keys, 'band': x.band, 'f': '2024-01-01', 'l': '2024-01-01', 'n': 1, 'title': x.title, 'company': x.company}})
    WHEN {_FIND} IS NULL AND x.phase = 1 THEN list_append(s.es, {{'object_id': x.object_id, 'keys': x.keys, 'band': x.band, 'f': '2024-02-02', 'l': '2024-02-02', 'n': 1, 'title': x.title, 'company': x.company}})
    WHEN {_FIND} IS NULL THEN s.es
    ELSE list_append(list_filter(s.es, lambda e: e.object_id <> {_FIND}.object_id), {{'object_id': {_FIND}.object_id, 'keys': list_sort(list_distinct(list_concat({_FIND}.keys, x.keys))),
      'band': CASE WHEN x.phase = 1 AND x.band = 'strong' THEN 'strong' ELSE {_FIND}.band END, 'f': {_FIND}.f, 'l': CASE WHEN x.phase = 1 THEN '2024-02-02' ELSE {_FIND}.l END,
      'n': {_FIND}.n + CASE WHEN x.phase = 1 THEN 1 ELSE 0 END, 'title': {_FIND}.title, 'company': {_FIND}.company}}) END
  FROM s JOIN x ON x.grp = s.grp AND x.i = s.i + 1
), last AS (SELECT unnest(arg_max(es, i)) AS e FROM s GROUP BY grp)
SELECT e.object_id, array_to_string(e.keys, ',') AS keys, e.band, e.f AS first_surfaced, e.l AS last_surfaced, e.n AS surfaced_count, e.title, e.company FROM last"""
)

_ACT = SQL["seen_diff"].replace("SELECT ord, owner, CASE", "SELECT f.ord, f.band, CASE").rstrip()
SQL["diff_counters"] = _ACT.replace("\nSELECT f.ord, f.band, CASE", "\n, a AS (SELECT f.ord, f.band, CASE") + ") SELECT action, band, count(*) AS n FROM a GROUP BY ALL"
SQL["shortlist_order"] = _ACT.replace("\nSELECT f.ord, f.band, CASE", "\n, a AS (SELECT f.ord, f.band, CASE") + """)
SELECT row_number() OVER (ORDER BY CASE a.band WHEN 'strong' THEN 0 ELSE 1 END, coalesce(v.comp_max, 0) DESC, v.company, v.ord) AS n, v.ord FROM a JOIN v USING (ord) WHERE action <> 'suppressed'"""
SQL["label_counts"] = STORE + VISITS + """, ids AS (SELECT object_id, substr(k, 4) AS id FROM (SELECT object_id, unnest(keys) AS k FROM st) WHERE starts_with(k, 'id:')),
mk AS (SELECT i.object_id, bool_or(o_orderkey % 2 = 0) AS applied FROM ids i JOIN orders ON i.id = 'o' || o_orderkey AND o_orderkey % 7 = 0 GROUP BY 1)
SELECT count(mk.object_id) AS opened, count_if(coalesce(mk.applied, false)) AS applied, count_if(st.company_host IN (SELECT host FROM vh WHERE vh.applied)) AS company_applied FROM st LEFT JOIN mk USING (object_id)"""
SQL["dedup_counters"] = SQL["representatives"].replace(" SELECT object_id, dedup_key,", " , z AS (SELECT object_id, dedup_key,") + """)
SELECT 'postings' AS counter, (SELECT count(*) FROM p) AS n UNION ALL SELECT 'survivors', count(*) FROM z UNION ALL SELECT 'merged_groups', count_if(duplicate_count > 1) FROM z
UNION ALL SELECT 'duplicates', CAST(sum(duplicate_count - 1) AS BIGINT) FROM z"""
SQL["postings_order"] = SQL["representatives"].replace("SELECT q.*, '0' || cluster_key AS grp, cluster_key AS name FROM q", "SELECT q.*, '0' || cluster_key AS grp, cluster_key AS name, 0 AS path, 0 AS sub FROM q").replace(
    "ELSE q.fallback_key || '#' || sub END FROM q JOIN", "ELSE q.fallback_key || '#' || sub END, 1, sub FROM q JOIN"
).replace(" SELECT object_id, dedup_key,", " , z AS (SELECT object_id, dedup_key,") + f""")
, place AS (SELECT object_id, published_at, company, title, path, sub, min(ord) OVER (PARTITION BY path, CASE WHEN path = 0 THEN cluster_key ELSE fallback_key END) AS first FROM t)
SELECT row_number() OVER (ORDER BY {NEWER.format('published_at')}, company, title, path, first, sub) AS n, object_id FROM place JOIN (SELECT object_id FROM z) USING (object_id)"""
SQL["search_results"] = LANDED.replace("CAST(floor(event_id / 150) AS BIGINT) AS page", "CAST(floor(event_id // 150 * (1 + event_id % 3) / 2) AS BIGINT) AS page").replace("FROM events\n", "FROM events WHERE floor(event_id // 150 * (1 + event_id % 3) / 2) <= 40\n") + """
, a AS (SELECT search, min(page) FILTER (WHERE new = 0 AND before = 0) AS stale, max(page) AS last FROM l GROUP BY search), n AS (SELECT a.search, stale, count(*) AS pages_fetched FROM c JOIN a USING (search) WHERE page <= coalesce(stale, last) GROUP BY ALL)
SELECT search, pages_fetched, CASE WHEN stale IS NOT NULL THEN '2 consecutive pages with no new records' WHEN pages_fetched > 40 THEN 'reached max_pages=40' ELSE 'no more pages' END AS stop_reason FROM n"""
SQL["previous_run"] = "SELECT event_id, event_id % 5 AS records FROM events WHERE event_id % 5 > 0 AND event_id % 3 <> 0 ORDER BY ts DESC LIMIT 1"
SQL["capture_match"] = """WITH k AS (SELECT 's' || event_id AS state, CAST(user_id % 97 AS VARCHAR) AS base, CASE WHEN event_id % 4 > 0 THEN event_id % 4 * 7 END AS w, event_id AS pos FROM events),
b AS (SELECT base, arg_max(state, (coalesce(w, 0), -pos)) AS state, max(coalesce(w, 0)) AS top FROM k GROUP BY base), n AS (SELECT DISTINCT CAST(user_id % 101 AS VARCHAR) AS base FROM events)
SELECT 'n' || n.base AS name, n.base, b.state, nullif(b.top, 0) AS "window" FROM n LEFT JOIN b USING (base)"""
SQL["company_split"] = COMPANIES + " SELECT website_host IS NOT NULL AS has_website, count(*) AS companies, CAST(sum(posting_count) AS BIGINT) AS postings, count_if(distance_miles IS NULL) AS without_distance FROM co GROUP BY 1"
SQL["flag_reliability"] = SCREENED + f"""SELECT count(*) AS postings, count_if({_FLAG}) AS flagged, count_if({_FLAG} AND NOT {_MANAGES}) AS uncorroborated, count_if({_FLAG} AND NOT {_MANAGES} AND {_BACKEND}) AS uncorroborated_backend,
  count_if({level('raw_title')} <> '') AS leveled_titles, count_if({level('raw_title')} <> '' AND {senior('raw_title')} AND NOT coalesce(seniority_level = 'Senior Level', false)) AS senior_title_only,
  count_if({level('raw_title')} <> '' AND NOT {senior('raw_title')} AND coalesce(seniority_level = 'Senior Level', false)) AS senior_field_only FROM v"""

# --- reports
ESC = ESCAPED.format


def queued(url: str, key: str, label: str) -> str:
    return f"""'<a href="' || {ESC(url)} || '" data-visit-open data-visit-key="' || {ESC(key)} || '" data-visit-mark="auto">' || {label} || '</a>'"""


def dash(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN '-' ELSE {x} END"


_QUOTED = "replace(url_encode({}), '%20', '+')"
_HEADS = "list_transform(list_filter(string_split({}, '|'), lambda v: v <> ''), lambda v: trim(split_part(v, ',', 1)))"
SQL["company_page"] = COMPANIES + f""", placed AS (
  SELECT *, row_number() OVER (ORDER BY distance_miles NULLS LAST, ord) AS n, {host("regexp_extract(careers_url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)")} AS link_host FROM co
), shown AS (
  SELECT *, CASE WHEN website_host IS NULL THEN NULL WHEN link_host = website_host OR ends_with(link_host, '.' || website_host) THEN careers_url ELSE 'https://' || website_host END AS url,
    coalesce(nullif({ESC('name')}, ''), nullif({ESC('website_host')}, ''), '(unnamed)') AS label FROM placed
)
SELECT n, '<tr><td>' || n || '</td><td class="num">' || coalesce(format('{{:.1f}}', distance_miles), '-') || '</td><td>'
  || CASE WHEN careers_url IS NULL THEN '-' ELSE '<a href="' || {ESC('careers_url')} || '">careers</a>' END || '</td><td>'
  || CASE WHEN url IS NULL THEN label ELSE {queued('url', 'website_host', 'label')} END || '</td><td><a href="' || {ESC("('" + fixed.SEARCH_ENGINE + "' || " + _QUOTED.format("name || ' careers'") + ")")} || '">search</a></td><td>'
  || {dash(ESC(f"array_to_string({_HEADS.format('locations')}, ', ')"))} || '</td><td class="num">' || posting_count || CASE WHEN software_posting_count > 0 THEN ' (' || software_posting_count || ' sw)' ELSE '' END
  || '</td><td class="titles">' || CASE WHEN sample_titles = '' THEN '-' ELSE replace({ESC('sample_titles')}, '|', '<br>') END || '</td><td class="num">'
  || CASE WHEN coalesce(latest_published_at, '') = '' THEN '-' ELSE {ESC('substr(latest_published_at, 1, 10)')} END || '</td></tr>' AS row
FROM shown"""


def capped(items: str, shown: str, n: int) -> str:
    return f"array_to_string({shown}[:{n}], ', ') || CASE WHEN len({items}) > {n} THEN ' +' || (len({items}) - {n}) ELSE '' END"


_LABELS = "CASE WHEN len(demoted) > 0 THEN '<br><span class=\"flag\">' || " + ESC("array_to_string(demoted, ', ')") + " || '</span>' ELSE '' END"
_CITIES = listed("cities")
SQL["shortlist_page"] = (
    SCREENED.rstrip()
    + VISITS
    + f""", {LINKS.strip()}, sl AS (
  SELECT v.*, list_filter({_CITIES}, lambda c: true) AS cl, {listed('tools')} AS tl, row_number() OVER (ORDER BY CASE band WHEN 'strong' THEN 0 ELSE 1 END, coalesce(v.comp_max, 0) DESC, lower(v.company), v.ord) AS n,
    EXISTS (SELECT 1 FROM vh WHERE vh.applied AND (vh.host = v.company_host OR ends_with(vh.host, '.' || v.company_host))) AS sent, link.careers_url,
    {host("regexp_extract(link.careers_url, '^[a-zA-Z][a-zA-Z0-9+.\\-]*://([^/?#]*)', 1)")} AS link_host
  FROM v JOIN (SELECT ord, careers_url FROM link) link ON link.ord = v.ord WHERE band <> 'rejected'
), y AS (
  SELECT *, CASE WHEN company_host IS NULL THEN NULL WHEN link_host = company_host OR ends_with(link_host, '.' || company_host) THEN careers_url ELSE 'https://' || company_host END AS url, trim(apply_url) AS au FROM sl
)
SELECT n, '<tr class="' || band || '"><td class="num">' || n || '</td><td><span class="band ' || band || '">' || band || '</span>' || {_LABELS} || '</td><td>'
  || coalesce(nullif({ESC('raw_title')}, ''), {ESC('title')}) || '</td><td>'
  || CASE WHEN url IS NULL THEN {ESC('company')} ELSE {queued('url', 'company_host', ESC('company'))} || CASE WHEN sent THEN '<br><span class="applied">resume sent</span>' ELSE '' END END || '</td><td class="num">'
  || CASE WHEN comp_max IS NULL THEN '<span class="unknown">not stated</span>' ELSE
       CASE WHEN comp_min IS NOT NULL AND comp_min <> comp_max THEN '$' || format('{{:,}}', comp_min) || ' - $' || format('{{:,}}', comp_max) ELSE '$' || format('{{:,}}', comp_max) END
       || CASE WHEN comp_frequency = 'Hourly' OR len(cl) >= 5 THEN ' <span class="flag">(' || concat_ws(', ', CASE WHEN comp_frequency = 'Hourly' THEN 'hourly' END, CASE WHEN len(cl) >= 5 THEN len(cl) || ' metros' END) || ')</span>' ELSE '' END END || '</td><td>'
  || coalesce(seniority_level, '-') || '</td><td>' || {dash(ESC(capped('cl', "list_transform(cl, lambda c: split_part(c, ',', 1))", fixed.CITIES_SHOWN)))} || '<br><span class="flag"></span></td><td class="tools">'
  || CASE WHEN len(tl) = 0 THEN '<span class="unknown">none listed</span>' ELSE {ESC(capped('tl', 'tl', fixed.TOOLS_SHOWN))} END || '</td><td class="num">'
  || CASE WHEN published_at = '' THEN '-' ELSE substr(published_at, 1, 10) END || '</td><td class="num">'
  || CASE WHEN au = '' THEN '<span class="unknown">-</span>' ELSE {queued('au', "('job:' || object_id)", "'apply'")} END || '</td></tr>' AS row
FROM y"""
)
SQL["funnel_dry_run"] = SCREENED + f""", k AS (SELECT v.*, coalesce(cluster_key, concat_ws('|', company, regexp_replace(lower(trim(title)), '\\s+', ' ', 'g'), array_to_string(list_sort({_CITIES}), ','))) AS dk FROM v),
kept AS (SELECT * FROM k WHERE band <> 'rejected' QUALIFY row_number() OVER (PARTITION BY dk ORDER BY ord) = 1)
SELECT 'records' AS step, count(*) AS n FROM v UNION ALL SELECT 'rejected', count_if(band = 'rejected') FROM v
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM v WHERE band <> 'rejected') - (SELECT count(*) FROM kept)
UNION ALL SELECT 'near_misses', count(DISTINCT dk) FROM k WHERE near_miss
UNION ALL SELECT 'band ' || band, count(*) FROM kept GROUP BY band
UNION ALL SELECT 'demoted ' || d, count(*) FROM (SELECT unnest(demoted) AS d FROM kept) GROUP BY d"""

# --- raw input: the same texts, read by DuckDB's JSON functions
RAW = P + f", raw AS MATERIALIZED (SELECT p.*, CAST({LINE} AS JSON) AS j FROM p)"
_J, _F, _I = "$.v5_processed_job_data.", "$.enriched_company_data.", "$.job_information."


def jtext(path: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') = 'VARCHAR' THEN nullif({strip(f"json_extract_string(j, '{path}')")}, '') END"


def jnum(path: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(trunc(CAST(json_extract(j, '{path}') AS DOUBLE)) AS BIGINT) END"


def jtrue(path: str) -> str:
    return f"coalesce(CAST(json_extract(j, '{path}') AS VARCHAR) = 'true' AND json_type(j, '{path}') = 'BOOLEAN', false)"


def jitems(path: str) -> str:
    return f"CASE WHEN json_type(j, '{path}') = 'ARRAY' THEN CAST(json_extract(j, '{path}') AS JSON[]) ELSE CAST([] AS JSON[]) END"


def jstrings(path: str) -> str:
    one = f"CASE WHEN json_type(x) = 'VARCHAR' THEN nullif({strip("json_extract_string(x, '$')")}, '') END"
    return f"list_filter(list_transform({jitems(path)}, lambda x: {one}), lambda x: x IS NOT NULL)"


def money(x: str) -> str:
    return f"CASE WHEN {x} > 25000 AND {x} < 600000 THEN CAST({x} AS INT) END"


_BAD = "coalesce(NOT ({0} > 25000 AND {0} < 600000), false)"
SQL["raw_project"] = RAW + f""", a AS (
  SELECT *, {jnum(_J + 'yearly_min_compensation')} AS lo, {jnum(_J + 'yearly_max_compensation')} AS hi, coalesce({jtext(_I + 'job_title_raw')}, {jtext(_I + 'title')}, '') AS rt,
    coalesce({jtext(_F + 'name')}, {jtext(_J + 'company_name')}, '(unknown)') AS firm, {jstrings(_J + 'workplace_cities')} AS cl, {jtext('$.liberal_dedup_cluster')} AS cluster FROM raw
), b AS (SELECT *, coalesce({jtext(_J + 'core_job_title')}, rt) AS tt FROM a)
SELECT coalesce({jtext('$.objectID')}, {jtext('$.id')}, '') AS object_id, cluster AS cluster_key, coalesce(cluster, '') AS dedup_key,
  concat_ws('|', firm, trim(regexp_replace(lower(tt), '\\s+', ' ', 'g')), array_to_string(list_sort(cl), ',')) AS fallback_key, 1 AS duplicate_count, '' AS alternate_object_ids, '' AS alternate_apply_urls,
  tt AS title, rt AS raw_title, firm AS company, {host(jtext(_F + 'homepage_uri'))} AS company_host, {jtext(_J + 'job_category')} AS job_category, {jtext(_J + 'seniority_level')} AS seniority_level,
  {jtext(_J + 'role_type')} AS role_type, {jtext(_J + 'position_employer_type')} AS employer_type, CAST({jnum(_J + 'min_industry_and_role_yoe')} AS INT) AS min_years_experience, {jtext(_J + 'workplace_type')} AS workplace_type,
  array_to_string(cl, '|') AS cities, CAST(len(cl) AS INT) AS city_count, {money('lo')} AS comp_min, {money('hi')} AS comp_max, {jtext(_J + 'listed_compensation_frequency')} AS comp_frequency,
  {jtrue(_J + 'is_compensation_transparent')} AS comp_transparent, {_BAD.format('lo')} OR {_BAD.format('hi')} AS comp_implausible, array_to_string({jstrings(_J + 'commitment')}, '|') AS commitment,
  {jtext(_J + 'security_clearance')} AS security_clearance, array_to_string({jstrings(_J + 'licenses_or_certifications')}, '|') AS certifications, coalesce({jtext(_J + 'requirements_summary')}, '') AS requirements,
  array_to_string({jstrings(_J + 'technical_tools')}, '|') AS tools, {jtext(_J + 'air_travel_requirement')} AS air_travel, coalesce({jtext('$.source')}, '') AS source, {jtext('$.apply_url')} AS apply_url,
  {jtext(_J + 'estimated_publish_date')} AS published_at, {jtrue('$.is_expired')} AS is_expired
FROM b"""
_ID = """CASE WHEN json_type(j, '$.objectID') = 'VARCHAR' THEN nullif(json_extract_string(j, '$.objectID'), '')
  WHEN json_type(j, '$.objectID') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN nullif(CAST(json_extract(j, '$.objectID') AS VARCHAR), '0') END"""
_OTHER = """CASE json_type(j, '$.id') WHEN 'VARCHAR' THEN json_extract_string(j, '$.id') WHEN 'BOOLEAN' THEN CASE CAST(json_extract(j, '$.id') AS VARCHAR) WHEN 'true' THEN 'True' ELSE 'False' END END"""
SQL["raw_keys"] = RAW + f" SELECT coalesce({_ID}, {_OTHER}) AS key, count(*) AS n FROM raw GROUP BY 1"
SQL["raw_coverage"] = RAW + f""", d AS (SELECT *, CASE WHEN json_type(j, '{_J}estimated_publish_date') = 'VARCHAR' THEN substr(json_extract_string(j, '{_J}estimated_publish_date'), 1, 10) END AS day,
  CASE WHEN {jtext(_F + 'name')} IS NOT NULL THEN json_extract_string(j, '{_F}name') END AS firm FROM raw)
SELECT count(*) AS records, count(DISTINCT {_ID}) AS distinct_ids, count(DISTINCT {host(jtext(_F + 'homepage_uri'))}) AS company_hosts, count(DISTINCT firm) AS company_names, count_if({jtrue('$.is_expired')}) AS expired,
  min(day) AS first_day, max(day) AS last_day, CAST(date_diff('day', CAST(min(day) AS DATE), CAST(max(day) AS DATE)) + 1 AS INT) AS span_days FROM d"""
_RP = f"""rp AS MATERIALIZED (SELECT ord, j, {jtext('$.apply_url')} AS apply_url, {jtext('$.source')} AS source, {jtrue('$.is_expired')} AS expired, {host(jtext(_F + 'homepage_uri'))} AS host,
  {jtext(_F + 'name')} AS enriched_name, coalesce({jtext(_J + 'core_job_title')}, {jtext(_I + 'title')}, '-') AS title,
  CASE WHEN json_type(j, '{_F}year_founded') = 'UBIGINT' OR json_type(j, '{_F}year_founded') = 'BIGINT' THEN '{{"year_founded":' || CAST(json_extract(j, '{_F}year_founded') AS VARCHAR) || '}}' END AS profile FROM raw)"""
_COORD = "CASE WHEN json_type(pts[i], '$.{0}') IN ('BIGINT', 'UBIGINT', 'DOUBLE') THEN CAST(json_extract(pts[i], '$.{0}') AS DOUBLE) END"
SQL["raw_companies"] = RAW + f""", {_RP}, {LINKS.strip().replace("FROM p", "FROM rp", 1)}, c AS (
  SELECT ord, {jitems(_J + 'workplace_cities')} AS labels, {jitems('$._geoloc')} AS pts FROM rp
), pl AS (
  SELECT ord, i, CASE WHEN json_type(l) = 'VARCHAR' THEN nullif({strip("json_extract_string(l, '$')")}, '') END AS label, {_COORD.format('lat')} AS lat, coalesce(nullif({_COORD.format('lon')}, 0), {_COORD.format('lng')}) AS lon
  FROM (SELECT ord, unnest(labels) AS l, generate_subscripts(labels, 1) AS i, pts FROM c)
), pd AS (
  SELECT *, list_filter(list_transform(string_split(label, ','), lambda x: trim(x)), lambda x: x <> '') AS parts, 6371000.0 * 2 * asin(sqrt(pow(sin(radians(lat - 38.9531) / 2), 2)
    + cos(radians(38.9531)) * cos(radians(lat)) * pow(sin(radians(lon + 77.4565) / 2), 2))) / 1609.344 AS d FROM pl WHERE label IS NOT NULL
), near AS (SELECT * FROM pd WHERE NOT (len(parts) >= 3 AND lower(parts[-2]) = 'maryland') AND (d IS NULL OR d <= 150)),
pa AS (SELECT ord, string_agg(concat_ws('@', label, CAST(round(d, 1) AS VARCHAR)), '|' ORDER BY d IS NULL, d, i) AS places FROM near GROUP BY ord),
z AS (SELECT link.*, coalesce(pa.places, '') AS places, link.ord IN (SELECT ord FROM pd) AS located FROM link LEFT JOIN pa USING (ord))
SELECT coalesce(host, careers_url) AS key, CASE WHEN lower(source) = 'usagov' THEN 'excluded_source' WHEN expired THEN 'expired' WHEN ends_with(host, '.gov') OR ends_with(host, '.mil') THEN 'excluded_website_tld'
  WHEN located AND places = '' THEN 'no_qualifying_location' WHEN host IS NULL AND careers_url IS NULL THEN 'unidentifiable' ELSE 'kept' END AS drop_reason, places, enriched_name, title, profile, count(*) AS n
FROM z GROUP BY ALL"""

_PAGES = "SELECT DISTINCT event_id % 3 AS search, event_id // 150 AS page FROM events"
SQL["page_records"] = """SELECT event_id % 3 AS search, event_id // 150 AS page, CAST(row_number() OVER (PARTITION BY event_id % 3, event_id // 150 ORDER BY event_id) - 1 AS INT) AS pos, 'e' || event_id AS key
FROM events WHERE (event_id // 150) % 4 <> 3"""
SQL["page_totals"] = f"""WITH g AS ({_PAGES}), t AS (SELECT search, page, CAST({PAYLOAD.replace("items", "'0'")} AS JSON) AS j FROM g),
o AS (SELECT search, page, coalesce(json_extract(j, '$.pageProps'), j) AS o FROM t), k AS (SELECT search, page, o, unnest(json_keys(o)) AS name FROM o),
v AS (SELECT search, page, name, json_extract(o, '$.' || name) AS x FROM k)
SELECT search, page, name, CAST(x AS DOUBLE) AS value FROM v
WHERE (starts_with(lower(name), 'nb') OR regexp_matches(lower(name), 'total|count|numhits|numpages')) AND json_type(x) IN ('BIGINT', 'UBIGINT', 'DOUBLE')"""
SQL["capture_files"] = """WITH e AS (
  SELECT user_id % 20 AS s, event_id % 13 AS page, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp, date_trunc('second', ts) AS t, event_id FROM events
), l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY s, page ORDER BY stamp DESC, event_id DESC) = 1)
SELECT '{"dateFetchedPastNDays":' || s || ',"q":"s' || s || '"}' AS state, count(*) AS pages, max(page) AS last_page, CASE WHEN max(page) = 12 THEN 0 ELSE 1 END AS last_page_records,
  max(page) >= 11 AS complete, round((epoch_us(max(t)) - epoch_us(min(t))) / CAST(3.6e9 AS DOUBLE), 6) AS span_hours,
  array_to_string(list_filter(range(0, max(page) + 1), lambda v: NOT list_contains(list(page), v)), ',') AS missing FROM l GROUP BY s"""
SQL["visit_log"] = """SELECT CASE c_custkey % 10 WHEN 0 THEN 'posting' WHEN 1 THEN 'unusable' ELSE 'company' END AS kind,
  CASE WHEN c_custkey % 10 > 1 THEN lower(replace(c_name, '#', '-')) || '.example.com' END AS host, c_custkey % 5 = 0 AS applied, count(*) AS n FROM customer GROUP BY ALL"""

SQL["schema_drift"] = RAW + """, f AS (SELECT unnest(json_keys(j)) AS path, '' AS o, j FROM raw """ + " ".join(
    f"UNION ALL SELECT unnest(json_keys(json_extract(j, '$.{o}'))), '{o}.', json_extract(j, '$.{o}') FROM raw WHERE json_type(j, '$.{o}') = 'OBJECT'" for o in OBJECTS
) + f"""), k AS (
  SELECT o || path AS path, CASE json_type(j, '$."' || path || '"') WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, count(*) AS n
  FROM f GROUP BY ALL
), e AS (SELECT * FROM (VALUES {", ".join(f"('{p}', '{kind}')" for p, kind in READ_FIELDS.items())}) v(path, takes))
SELECT path, kind, n, CASE WHEN takes IS NULL THEN 'new' ELSE 'retyped' END AS state FROM k LEFT JOIN e USING (path) WHERE kind <> 'null' AND (takes IS NULL OR kind <> takes)
UNION ALL SELECT path, takes, 0, 'lost' FROM e WHERE path NOT IN (SELECT path FROM k)"""
SQL["connector_pages"] = SQL["page_counts"]

# The same rows in SQL alone, by the registered functions.
SQL["sql_careers"] = SQL["careers_tiers"]
SQL["sql_page_rows"] = SQL["page_records"]
