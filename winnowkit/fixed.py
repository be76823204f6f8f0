"""Word lists, patterns, tables and constants that results depend on.

They are stated here together, as plain text; no logic lives in this module.
"""

# --- money and similarity -------------------------------------------------------------------
MONEY_OVER = 25_000
MONEY_UNDER = 600_000
DEFAULT_SIMILARITY = 0.44
CALIBRATION_PERCENTILE = 10
MIN_CALIBRATION_GROUPS = 10
MAX_PAIRS_PER_GROUP = 15

# --- geography -------------------------------------------------------------------------------
EARTH_RADIUS_METERS = 6_371_000.0
METERS_PER_MILE = 1609.344

# --- screening defaults -----------------------------------------------------------------------
COMP_FLOOR = 180_000
COMP_MIN_FLOOR = 130_000
WIDE_GEOGRAPHY_CITIES = 5

# --- names of things ----------------------------------------------------------------------------
UNKNOWN_COMPANY = "(unknown)"
UNKNOWN_CATEGORY = "Unknown"
SOFTWARE_CATEGORY = "Software Development"
POSTING_PREFIX = "job:"
AGGREGATOR_SOURCES = ["adhoc"]
PUBLIC_SECTOR_SOURCES = ["usagov", "governmentjobs", "winocular", "schoolspring", "peopleadmin", "oraclepeoplesoft"]
PUBLIC_DOMAINS = [".gov", ".mil", ".edu"]
HARMLESS_CLEARANCES = ["None", "Public Trust", "Other"]
FREQUENT_AIR_TRAVEL = ["Moderate", "Extensive"]
SENIOR_LEVELS = ["sr", "staff", "principal", "lead", "distinguished", "fellow", "iii", "iv", "v", "3", "4", "5"]
LEVEL_SYNONYMS = {"senior": "sr", "snr": "sr", "junior": "jr"}
BAND_RANKS = {"strong": 2, "possible": 1}
TIER_RANKS = {"host": 0, "host_and_segments": 0, "board": 1, "posting": 2, "none": 3}
PROFILE_FIELDS = [
    "tagline", "industries", "activities", "nb_employees", "year_founded", "organization_type", "hq_country",
    "parent_company", "latest_funding_type", "latest_funding_year", "latest_funding_amount",
    "latest_funding_investors", "stock_exchange", "stock_symbol",
]

# --- patterns -------------------------------------------------------------------------------------
TOKEN = r"[a-z0-9+#.]+"
LEVEL_WORD = (
    r"\b(?:junior|jr|associate|entry|mid|senior|snr|sr|staff|principal|lead|distinguished|fellow|apprentice"
    r"|intern|trainee)\b"
)
LEVEL_NUMBER = r"(?:^|[\s\-(,/])(?:l|t)?(i{1,3}|iv|vi{0,3}|[1-5](?:[._]\d)?)(?=$|[\s\-),/])"
CLEARANCE = (
    r"top secret|ts/sci|ts-sci|\bsci\b|\bsecret\b|polygraph|\bpoly\b|doe level q|dod clearance|active clearance"
    r"|\bcleared\b|clearance required"
)
NON_SOFTWARE_TOOLS = (
    r"solidworks|autocad|revit|\bcad\b|creo|comsol|ansys|staad|bluebeam|\bbim\b|\bfea\b|finite element|microscopy"
    r"|elisa|hplc|mass spectrom|flow cytometry|qpcr|cell culture|chromatograph|\bcfd\b|solumina|tipqa|resrad"
    r"|microshield|lumerical|klayout|\bvhdl\b|verilog|xilinx|\bzynq\b|quartus|vivado|altera"
)
BACKEND_TOOLS = (
    r"python|java(?!script)|kotlin|golang|\bgo\b|rust|c\+\+|kubernetes|docker|terraform|kafka|postgres|mysql|spring"
    r"|django|fastapi|aws|azure|gcp|linux|ci/cd|jenkins|redis|graphql|grpc|microservice|airflow|spark|helm|ansible"
    r"|istio|envoy|lambda|dynamodb|typescript|node|scala|elasticsearch|rabbitmq|snowflake|databricks"
)
BUILD_TOOLS = (
    r"kubernetes|terraform|docker|kafka|spring|django|fastapi|golang|\brust\b|\bgrpc\b|airflow|spark|helm|istio"
    r"|envoy|lambda|dynamodb|postgres|redis|microservice|ci/cd|jenkins|gitlab ci|github actions"
)
GRC_TOOLS = (
    r"fedramp|\brmf\b|fisma|nist 800|nist sp|nist csf|cis controls|\bstig\b|poa&m|\bato\b|soc 2|iso 27001"
    r"|mitre att&ck|\bsiem\b|onetrust|\bgrc\b|\bfips\b"
)
IT_ADMIN_TOOLS = (
    r"microsoft 365|\bm365\b|entra id|\bintune\b|active directory|configuration manager|\bsccm\b|vmware|citrix"
    r"|servicenow|sharepoint|microsoft exchange|\bmdm\b|microsoft office|group policy"
)
FRONTEND_TITLE = r"full.?stack|front.?end|ui engineer|web develop"
CUSTOMER_FACING_TITLE = (
    r"solutions? engineer|sales engineer|pre.?sales|account manager|customer success|technical success"
    r"|success engineer|transformation success|field engineer|field application|implementation consultant"
    r"|technical account"
)
ANALYST_TITLE = (
    r"\banalyst\b|\bresearcher\b|business intelligence|ux research|data scientist|epidemiolog|psychologist"
    r"|economist|\bscientist\b|modeler|\banalytics\b|\bspecialist\b|\bofficer\b"
)
ENGINEERING_TITLE = r"\bengineer|\bdeveloper\b|\barchitect\b|\bsre\b"
HARDWARE_TITLE = (
    r"\brf\b|\bdsp\b|\bfpga\b|\basic\b|photonic|elint|\bsigint\b|antenna|radar|nuclear|mechanical|structural"
    r"|electrical|firmware|embedded|manufactur|test engineer|hardware|circuit|\bpcb\b|thermal|propulsion"
    r"|spacecraft|flight"
)
OPS_TITLE = (
    r"network (reliability |)engineer|\bdns\b|system administrator|sysadmin|help ?desk|desktop|endpoint|workstation"
    r"|service management|\bitsm\b|technician|noc\b"
)
MANAGEMENT_TITLE = (
    r"\bmanager\b|\bdirector\b|head of|\bvp\b|vice president|\bchief\b|supervisor|\bsupervisory\b|team lead\b"
    r"|\bforeman\b"
)
MANAGEMENT_LANGUAGE = (
    r"direct reports?|supervis|performance review|managing (?:people|teams|staff)|manage (?:a )?(?:team|staff|people)"
    r"|leading a team|hiring and|people manage|team of \d|budget responsib|\bp&l\b"
)

# --- careers links: what identifies an employer in a posting's URL, by source ------------------------
PATH_SEGMENTS = {
    "grnhse": 1, "lever": 1, "eu_lever": 1, "ashby": 1, "smartrecruiters": 1, "workday": 1, "rippling": 1, "gem": 1,
    "harri": 1, "recooty": 1, "dover": 1, "hireology": 1, "governmentjobs": 2, "jobvite": 1, "adprecruiting": 1,
    "gr8people": 0, "silkroad": 2, "dayforce": 2, "jobscore": 2, "talentreef": 2, "csod": 1, "vivahr": 1, "gusto": 0,
    "workable": 0, "interfolio": 0, "appone_api": 0, "ourcareerpages": 0, "schoolspring": 0,
}
#: source: (query parameters kept, new path, (old path end, new path end))
BOARDS = {
    "adp": (["cid", "ccId"], None, None),
    "paycom": (["clientkey"], "/v4/ats/web.php/jobs", None),
    "paycor": (["clientId"], "/career/CareerHome.action", None),
    "saashr": ([], None, None),
    "taleo_rss": (["org", "cws"], None, ("requisition.jsp", "jobSearch.jsp")),
}
SITE_PATHS = {"oraclecloud": ("sites", "requisitions")}
POSTING_ONLY = [
    "brassring", "hirebridge", "appone_rss", "njoyn", "virecruit", "brightmove", "pereless", "peoplematter",
    "csodsaba", "appvault", "pageup", "winocular", "oraclepeoplesoft", "salesforce", "paradox",
]

# --- reports ---------------------------------------------------------------------------------------------
SAMPLE_TITLES = 3
TOOLS_SHOWN = 5
CITIES_SHOWN = 2
EXCLUDED_SAMPLE = 25
REPORT_WIDE_CITIES = 5
EMPTY_PAGES_TO_STOP = 2
SEARCH_ENGINE = "https://duckduckgo.com/?q="
BAR_WIDTH = 40
#: Shares of what was reported, from which on a run counts as complete or partial.
COVERAGE_COMPLETE, COVERAGE_PARTIAL = 0.9, 0.6

# --- result pages, captures and search links ---------------------------------------------------------------
PAGE_DATA_OPEN = '<script id="__NEXT_DATA__" type="application/json">'
PAGE_DATA_CLOSE = "</script>"
REDIRECT_FIELD = "__N_REDIRECT"
FIRST_PAGE_LABEL = "ssr"
CAPTURE_FORMAT = "-capture/1"
WINDOW_FIELD = "dateFetchedPastNDays"
SEARCH_PATH = "/classic"
DAILY_WINDOW_DAYS = 2
SPAN_WARNING_HOURS = 6.0
TOTAL_RECORDS, TOTAL_COMPANIES = "ssrTotalCount", "ssrCompanyCount"
