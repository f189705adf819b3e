"""Policy tables: which spellings mean nothing, which source is trusted for which field.

All of these are fixed values: results depend on each of them.
"""

EMPTY = ("", "-", "n/a", "na", "null", "none", "not disclosed", "unknown", "linkedin member")

SOURCES = ("linkedin_scraper", "naukri_export", "github_crawl")
ENRICHMENT = "enrichment"
CONFIDENCE = {"linkedin_scraper": 0.90, "naukri_export": 0.80, "github_crawl": 0.70, "enrichment": 0.90}
DEFAULT_CONFIDENCE = 0.5

DEFAULT_TRUST = 99
TRUST = {
    "full_name": {"linkedin_scraper": 0, "naukri_export": 1, "enrichment": 1, "github_crawl": 2},
    "current_title": {"linkedin_scraper": 0, "enrichment": 0, "naukri_export": 1, "github_crawl": 2},
    "current_company": {"linkedin_scraper": 0, "enrichment": 0, "naukri_export": 1, "github_crawl": 2},
    "location": {"linkedin_scraper": 0, "github_crawl": 1, "naukri_export": 2},
    "experience_months": {"naukri_export": 0, "linkedin_scraper": 1, "github_crawl": 2},
    "annual_salary_inr": {"naukri_export": 0, "linkedin_scraper": 1, "github_crawl": 1},
    "notice_period_days": {"naukri_export": 0, "linkedin_scraper": 1},
    "open_to_work": {"linkedin_scraper": 0, "naukri_export": 0, "github_crawl": 0, "enrichment": 0},
}
FIELDS = tuple(TRUST)
NULL_PROTECTED = tuple(f for f in FIELDS if f != "open_to_work")

GMAIL = ("gmail.com", "googlemail.com")
JUNK_MAIL = ("test.com", "example.com", "example.org", "example.net")
FREE_MAIL = ("gmail.com", "googlemail.com", "yahoo.com", "yahoo.co.in", "outlook.com", "hotmail.com", "rediffmail.com", "protonmail.com", "icloud.com")

#: alias: (city, state, country)
CITIES = {
    "bengaluru": ("bengaluru", "karnataka", "IN"),
    "bangalore": ("bengaluru", "karnataka", "IN"),
    "blr": ("bengaluru", "karnataka", "IN"),
    "pune": ("pune", "maharashtra", "IN"),
    "hyderabad": ("hyderabad", "telangana", "IN"),
    "mumbai": ("mumbai", "maharashtra", "IN"),
    "surat": ("surat", "gujarat", "IN"),
    "chennai": ("chennai", "tamil nadu", "IN"),
    "kochi": ("kochi", "kerala", "IN"),
    "jaipur": ("jaipur", "rajasthan", "IN"),
    "noida": ("noida", "uttar pradesh", "IN"),
    "delhi ncr": ("delhi", "delhi", "IN"),
    "delhi": ("delhi", "delhi", "IN"),
}
STATES = {"mh": "maharashtra", "ka": "karnataka", "tn": "tamil nadu", "up": "uttar pradesh"}

#: Taken off a company's name once each, in this order.
COMPANY_SUFFIXES = (" software pvt ltd", " pvt ltd", " private limited", " ltd", " inc.", " inc", " india", " technologies", " labs")

SKILL_ALIASES = {
    "powerbi": "power bi",
    "power-bi": "power bi",
    "ms excel": "excel",
    "msexcel": "excel",
    "advanced excel": "excel",
    "postgres": "postgresql",
    "postgre sql": "postgresql",
    "js": "javascript",
    "node": "node.js",
    "nodejs": "node.js",
    "k8s": "kubernetes",
    "py": "python",
    "ml": "machine learning",
}

#: Strongest first.
IDENTIFIER_STRENGTH = ("linkedin_handle", "email", "phone", "github_login")

LOOKUP_COST = 0.09
LOOKUP_BUDGET = 15
NEGATIVE_TTL_DAYS = 30
