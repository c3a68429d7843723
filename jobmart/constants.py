"""Fixed values shared by the classifiers, lookups and job wrappers.

Everything under "FIXED VALUES" must equal the behaviour being reproduced
(keyword lists, thresholds, regex patterns, the state table); the rest are
our own operating parameters.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — keyword lists, thresholds, patterns and lookup tables that
# must stay exactly as stated for results to match.
# ---------------------------------------------------------------------------

# Title seniority (observed classifier), tested as plain substrings of lower(title).
SENIOR_TITLE_TAGS = ("sr", "senior", "iv", "lead", "principal", "director", "head", "vp", "executive", "president")
MID_TITLE_TAGS = ("ii", "experienced", "manager", "iii")
JUNIOR_TITLE_TAGS = ("jr", "associate", "junior", "intern", "entry level")

# Salary band thresholds on salary_min.
SALARY_JUNIOR_BELOW = 74000
SALARY_SENIOR_ABOVE = 100000

# Years-of-experience patterns, tried in this order; group 1 is the number.
YOE_PATTERNS = (
    r"(\d+)\s*-\s*(\d+)\s*years?",
    r"(\d+)\+?\s*(?:years?|yrs?|yos?)",
    r"at\s*least\s*(\d+)\s*years?",
    r"minimum\s*(?:of\s*)?(\d+)\s*years?",
)

# Title+description classifier (v1): senior hints anywhere in the text,
# junior hints in the title only.
V1_SENIOR_TAGS = ("sr", "lead", "principal", "director", "head", "vp", "executive", "team lead")
V1_JUNIOR_TAGS = ("jr", "associate", "junior", "intern")
V1_LEVEL_PATTERN = r"\b(level\s*(i|ii|iii|iv|v))\b"

# Remote detection over lower(title || ' ' || description).
REMOTE_KEYWORDS = ("remote", "work from home", "wfh")

# Industry rules, evaluated in order, case-insensitive, word-bounded.
INDUSTRY_RULES = (
    ("big_tech", None, r"google|microsoft|amazon|apple|meta|netflix|tesla|uber|airbnb"),
    ("finance", None, r"jpmorgan|goldman|morgan stanley|wells fargo|bank of america|citi"),
    ("consulting", None, r"mckinsey|bain|bcg|deloitte|pwc|accenture|kpmg"),
    ("pharma", None, r"pfizer|merck|johnson|roche|novartis|astrazeneca"),
    ("fintech", r"fintech", r"stripe|square|robinhood|coinbase"),
    ("healthcare", r"healthcare?", r"health|medical|hospital"),
)
STARTUP_COMPANY_PATTERN = r"startup|inc\.?|llc"
STARTUP_MAX_POSTINGS = 10

# Domain hints for industry (planned in the original; precedence below the rules above).
INDUSTRY_HINTS = (
    ("healthcare", ("nurse", "clinical", "hospital")),
    ("tech", ("software", "engineer", "developer")),
)

# Second-source employment types: the part before " and ", lower-cased.
JOB_TYPE_SPLIT = " and "

# US states: full name -> abbreviation (51 entries incl. DC).
US_STATES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR",
    "California": "CA", "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE",
    "Florida": "FL", "Georgia": "GA", "Hawaii": "HI", "Idaho": "ID",
    "Illinois": "IL", "Indiana": "IN", "Iowa": "IA", "Kansas": "KS",
    "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV",
    "New Hampshire": "NH", "New Jersey": "NJ", "New Mexico": "NM",
    "New York": "NY", "North Carolina": "NC", "North Dakota": "ND",
    "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA",
    "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD",
    "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT",
    "Virginia": "VA", "Washington": "WA", "West Virginia": "WV",
    "Wisconsin": "WI", "Wyoming": "WY", "District of Columbia": "DC",
}

# Housing: metro rows only; a date column is named YYYY-MM-DD.
HOUSING_REGION_TYPE = "msa"
HOUSING_ID_COLUMNS = ("RegionID", "SizeRank", "RegionName", "RegionType", "StateName")

# Paging: at most this many pages per pull.
MAX_PAGES = 20

# Snapshot windows (days) and top-k size.
NEW_WINDOWS_DAYS = (7, 30)
TOP_CATEGORIES = 5

# Affordability: rent may take at most this share of income.
RENT_SHARE_OF_INCOME = 0.30

# ---------------------------------------------------------------------------
# Operating parameters (ours).
# ---------------------------------------------------------------------------

# Fixture run date (latest order date in the driver tables).
FIXTURE_RUN_DATE = "2001-08-01"

# Lookups are broadcast only below this many rows (checked at run time).
BROADCAST_MAX_ROWS = 100_000
