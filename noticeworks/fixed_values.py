"""Fixed values.

Every literal in this module has to be exactly this for results to be right: word lists, code
prefixes, domains, labels, formats and the two curated registers. They are stated plainly, in their
natural order, and hold no logic.
"""

# --- Fixed values: relevance configuration -------------------------------------------------------
RELEVANCE_VERSION = "2.0"
STRONG_KEYWORDS = (
    "artificial intelligence",
    "ai",
    "machine learning",
    "deep learning",
    "neural network",
    "large language model",
    "llm",
    "generative ai",
    "natural language processing",
    "nlp",
    "computer vision",
    "machine vision",
    "automated decision",
    "foundation model",
    "predictive analytics",
    "chatbot",
    "conversational ai",
    "recommendation engine",
    "recommender system",
    "intelligent automation",
    "robotic process automation",
    "facial recognition",
    "image recognition",
    "speech recognition",
    "sentiment analysis",
    "anomaly detection",
    "optical character recognition",
)
WEAK_KEYWORDS = (
    "algorithm",
    "algorithmic",
    "predictive",
    "automation",
    "data science",
    "data analytics",
    "optimisation model",
    "decision support",
)
STRONG_CPV_PREFIXES = ("7222", "7223")
WEAK_CPV_PREFIXES = ("7221", "7224", "7226", "7231", "7232", "4800", "4815", "4816", "4817")

# --- Fixed values: announcement and question searches --------------------------------------------
ANNOUNCEMENT_DOCUMENT_TYPES = (
    "press_release",
    "news_story",
    "policy_paper",
    "consultation",
    "open_consultation",
    "closed_consultation",
    "guidance",
    "speech",
)
ANNOUNCEMENT_QUERIES = (
    "artificial intelligence",
    "machine learning",
    "generative AI",
    "large language model",
    "AI Growth Zone",
    "sovereign AI",
    "AI infrastructure",
    "AI compute",
    "frontier AI",
)
QUESTION_SEARCH_TERMS = (
    "artificial intelligence",
    "machine learning",
    "large language model",
    "generative AI",
    "facial recognition",
    "automated decision",
)
MAX_ITEMS_PER_QUERY = 300

# --- Fixed values: procurement sources ------------------------------------------------------------
CONTRACTS_FINDER = "contracts_finder"
FIND_A_TENDER = "find_a_tender"
NOTICE_DOMAINS = {
    CONTRACTS_FINDER: "contractsfinder.service.gov.uk",
    FIND_A_TENDER: "find-tender.service.gov.uk",
}
DEFAULT_STAGES = {
    CONTRACTS_FINDER: ("award", "planning", "tender", "contract"),
    FIND_A_TENDER: None,
}
CONTRACTS_FINDER_OCID_PREFIX = "ocds-b5fd17-"
CONTRACTS_FINDER_NOTICE_URL = "https://www.contractsfinder.service.gov.uk/Notice/"
NOTICE_DOCUMENT_TYPES = ("tenderNotice", "awardNotice", "contractNotice")
UNKNOWN_SUPPLIER = "supplier_unknown"
DEFAULT_CURRENCY = "GBP"

# --- Fixed values: public page addresses ----------------------------------------------------------
GOV_UK = "https://www.gov.uk"
QUESTION_DETAIL_URL = "https://questions-statements.parliament.uk/written-questions/detail"

# --- Fixed values: transparency-record sections ---------------------------------------------------
MODEL_ARCHITECTURE_SECTIONS = (
    "model-architecture",
    "model-type",
    "algorithm-type",
    "system-architecture",
)
SENSITIVE_ATTRIBUTE_SECTIONS = (
    "sensitive-attributes",
    "personal-and-sensitive-data",
    "equalities-characteristics",
)
IMPACT_ASSESSMENT_SECTIONS = (
    "impact-assessments",
    "dpia",
    "data-protection-impact-assessment",
)

# --- Fixed values: labels -------------------------------------------------------------------------
STATUS_LABELS = {
    "awarded": "Awarded",
    "open": "Out to tender",
    "planned": "Planned",
    "closed": "Closed (no award)",
    "cancelled": "Cancelled",
    "withdrawn": "Withdrawn",
    "unsuccessful": "Unsuccessful",
    "unknown": "Unknown",
}
GAP_METRIC_LABELS = {
    "ai_procurement_count": "AI-flagged contracts",
    "atrs_record_count": "ATRS registrations",
}
NO_VALUE = "—"

# Texts a seed CSV may use for "no value".
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Fixed values: organisation aliases (raw_name, canonical_name, org_type) ---------------------
ORG_ALIASES = (
    ("Department for Work and Pensions", "Department for Work and Pensions", "government_department"),
    ("Department for Work & Pensions", "Department for Work and Pensions", "government_department"),
    ("DWP", "Department for Work and Pensions", "government_department"),
    ("DWP - Department for Work and Pensions", "Department for Work and Pensions", "government_department"),
    ("HM Revenue & Customs", "HM Revenue & Customs", "government_department"),
    ("HM Revenue and Customs", "HM Revenue & Customs", "government_department"),
    ("HMRC", "HM Revenue & Customs", "government_department"),
    ("NHS England", "NHS England", "arm_length_body"),
    ("NHS England and NHS Improvement", "NHS England", "arm_length_body"),
    ("NHSE", "NHS England", "arm_length_body"),
    ("Ministry of Justice", "Ministry of Justice", "government_department"),
    ("MoJ", "Ministry of Justice", "government_department"),
    ("Ministry of Justice (MoJ)", "Ministry of Justice", "government_department"),
    ("His Majesty's Prison and Probation Service", "His Majesty's Prison and Probation Service", "executive_agency"),
    ("HMPPS", "His Majesty's Prison and Probation Service", "executive_agency"),
    ("Home Office", "Home Office", "government_department"),
    ("Department for Science Innovation and Technology", "Department for Science Innovation and Technology", "government_department"),
    ("Department for Science, Innovation and Technology", "Department for Science Innovation and Technology", "government_department"),
    ("DSIT", "Department for Science Innovation and Technology", "government_department"),
    ("Office for National Statistics", "Office for National Statistics", "arm_length_body"),
    ("ONS", "Office for National Statistics", "arm_length_body"),
    ("Natural England", "Natural England", "arm_length_body"),
    ("Department of Health and Social Care", "Department of Health and Social Care", "government_department"),
    ("DHSC", "Department of Health and Social Care", "government_department"),
    ("Ministry of Defence", "Ministry of Defence", "government_department"),
    ("MoD", "Ministry of Defence", "government_department"),
    ("Ministry of Defence (MoD)", "Ministry of Defence", "government_department"),
    ("Department for Education", "Department for Education", "government_department"),
    ("DfE", "Department for Education", "government_department"),
    ("Cabinet Office", "Cabinet Office", "government_department"),
    ("HM Treasury", "HM Treasury", "government_department"),
    ("Treasury", "HM Treasury", "government_department"),
    ("Department for Transport", "Department for Transport", "government_department"),
    ("DfT", "Department for Transport", "government_department"),
    ("Department for Energy Security and Net Zero", "Department for Energy Security and Net Zero", "government_department"),
    ("DESNZ", "Department for Energy Security and Net Zero", "government_department"),
    ("Foreign Commonwealth and Development Office", "Foreign Commonwealth and Development Office", "government_department"),
    ("Foreign, Commonwealth & Development Office", "Foreign Commonwealth and Development Office", "government_department"),
    ("FCDO", "Foreign Commonwealth and Development Office", "government_department"),
    ("Department for Business and Trade", "Department for Business and Trade", "government_department"),
    ("DBT", "Department for Business and Trade", "government_department"),
    ("Environment Agency", "Environment Agency", "arm_length_body"),
    ("Driver and Vehicle Licensing Agency", "Driver and Vehicle Licensing Agency", "executive_agency"),
    ("DVLA", "Driver and Vehicle Licensing Agency", "executive_agency"),
    ("UK Health Security Agency", "UK Health Security Agency", "arm_length_body"),
    ("UKHSA", "UK Health Security Agency", "arm_length_body"),
    ("Government Digital Service", "Government Digital Service", "executive_agency"),
    ("GDS", "Government Digital Service", "executive_agency"),
    ("HM Land Registry", "HM Land Registry", "executive_agency"),
    ("Land Registry", "HM Land Registry", "executive_agency"),
    ("HMLR", "HM Land Registry", "executive_agency"),
    ("Department for Environment Food and Rural Affairs", "Department for Environment Food and Rural Affairs", "government_department"),
    ("Department for Environment, Food & Rural Affairs", "Department for Environment Food and Rural Affairs", "government_department"),
    ("DEFRA", "Department for Environment Food and Rural Affairs", "government_department"),
    ("Defra", "Department for Environment Food and Rural Affairs", "government_department"),
    ("Ministry of Housing Communities and Local Government", "Ministry of Housing Communities and Local Government", "government_department"),
    ("MHCLG", "Ministry of Housing Communities and Local Government", "government_department"),
    ("Information Commissioner's Office", "Information Commissioner's Office", "arm_length_body"),
    ("ICO", "Information Commissioner's Office", "arm_length_body"),
    ("Driver and Vehicle Standards Agency", "Driver and Vehicle Standards Agency", "executive_agency"),
    ("DVSA", "Driver and Vehicle Standards Agency", "executive_agency"),
    ("HMT", "HM Treasury", "government_department"),
    ("MOD", "Ministry of Defence", "government_department"),
    ("Money and Pensions Service", "Money and Pensions Service", "arm_length_body"),
    ("MaPS", "Money and Pensions Service", "arm_length_body"),
    ("Care Quality Commission", "Care Quality Commission", "arm_length_body"),
    ("CQC", "Care Quality Commission", "arm_length_body"),
    ("NHS Blood & Transplant", "NHS Blood & Transplant", "arm_length_body"),
    ("NHS BSA", "NHS Business Services Authority", "arm_length_body"),
    ("NHS Business Services Authority", "NHS Business Services Authority", "arm_length_body"),
    ("NHSBSA", "NHS Business Services Authority", "arm_length_body"),
    ("National Institute for Health and Care Excellence", "National Institute for Health and Care Excellence", "arm_length_body"),
    ("NICE", "National Institute for Health and Care Excellence", "arm_length_body"),
    ("National Savings & Investments", "National Savings & Investments", "arm_length_body"),
    ("NS&I", "National Savings & Investments", "arm_length_body"),
    ("Insolvency Service", "Insolvency Service", "executive_agency"),
    ("The Insolvency Service", "Insolvency Service", "executive_agency"),
    ("Student Loans Company", "Student Loans Company", "arm_length_body"),
    ("SLC", "Student Loans Company", "arm_length_body"),
    ("Children and Family Court Advisory and Support Service", "Children and Family Court Advisory and Support Service", "arm_length_body"),
    ("Cafcass", "Children and Family Court Advisory and Support Service", "arm_length_body"),
    ("CAFCASS", "Children and Family Court Advisory and Support Service", "arm_length_body"),
    ("Intellectual Property Office", "Intellectual Property Office", "executive_agency"),
    ("IPO", "Intellectual Property Office", "executive_agency"),
    ("The Crown Prosecution Service", "Crown Prosecution Service", "arm_length_body"),
    ("Crown Prosecution Service", "Crown Prosecution Service", "arm_length_body"),
    ("CPS", "Crown Prosecution Service", "arm_length_body"),
    ("The Gambling Commission", "Gambling Commission", "arm_length_body"),
    ("Gambling Commission", "Gambling Commission", "arm_length_body"),
    ("National Highways", "National Highways", "arm_length_body"),
    ("Maritime and Coastguard Agency", "Maritime and Coastguard Agency", "executive_agency"),
    ("MCA", "Maritime and Coastguard Agency", "executive_agency"),
    ("Met Office", "Met Office", "arm_length_body"),
    ("UK Export Finance", "UK Export Finance", "arm_length_body"),
    ("UKEF", "UK Export Finance", "arm_length_body"),
    ("Valuation Office Agency", "Valuation Office Agency", "executive_agency"),
    ("VOA", "Valuation Office Agency", "executive_agency"),
    ("UK Hydrographic Office", "UK Hydrographic Office", "arm_length_body"),
    ("UKHO", "UK Hydrographic Office", "arm_length_body"),
    ("Health Research Authority", "Health Research Authority", "arm_length_body"),
    ("HRA", "Health Research Authority", "arm_length_body"),
    ("Food Standards Agency", "Food Standards Agency", "arm_length_body"),
    ("FSA", "Food Standards Agency", "arm_length_body"),
    ("Public Sector Fraud Authority", "Public Sector Fraud Authority", "executive_agency"),
    ("PSFA", "Public Sector Fraud Authority", "executive_agency"),
    ("Building Digital UK", "Building Digital UK", "executive_agency"),
    ("BDUK", "Building Digital UK", "executive_agency"),
    ("Office for Students", "Office for Students", "arm_length_body"),
    ("OfS", "Office for Students", "arm_length_body"),
    ("Salix Finance", "Salix Finance", "arm_length_body"),
    ("Oak National Academy", "Oak National Academy", "arm_length_body"),
    ("Department for Health and Social Care and NHS Digital", "Department of Health and Social Care", "government_department"),
    ("DSIT - Parlex", "Department for Science Innovation and Technology", "government_department"),
    ("DSIT - Redbox", "Department for Science Innovation and Technology", "government_department"),
    ("Gov.UK Data Labs (Cabinet Office)", "Cabinet Office", "government_department"),
    ("UK Heath Security Agency", "UK Health Security Agency", "arm_length_body"),
    ("The Probation Service", "His Majesty's Prison and Probation Service", "executive_agency"),
)

# --- Fixed values: growth zones (zone_id, zone_name, site, region, status, investment_gbp) ---
# then compute_capacity, announced_date, lead_org, source_url, notes.
GROWTH_ZONES = (
    (
        "culham",
        "Culham",
        "Culham Science Centre",
        "Oxfordshire (England)",
        "confirmed",
        None,
        None,
        "2025-01-13",
        "Department for Science Innovation and Technology",
        "https://www.gov.uk/government/news/45m-for-uks-first-ai-supercomputer-to-accelerate-fusion-energy",
        "UK's first AI Growth Zone, announced with the AI Opportunities Action Plan (Jan 2025)",
    ),
    (
        "north-east",
        "North East",
        "Blyth / Cobalt Park",
        "North East England",
        "confirmed",
        None,
        None,
        "2025-09-24",
        "Department for Science Innovation and Technology",
        "https://www.gov.uk/government/news/north-east-ai-growth-zone-taskforce-launched-to-accelerate-jobs-skills-and-growth",
        "Taskforce launched Sept 2025",
    ),
    (
        "lanarkshire",
        "Lanarkshire",
        "Ravenscraig / Killellan",
        "Scotland",
        "confirmed",
        "8200000000",
        "100MW to 2GW (Killellan)",
        "2026-01-29",
        "Department for Science Innovation and Technology",
        "https://www.gov.uk/government/news/more-than-3400-jobs-and-targeted-support-for-local-communities-to-help-tackle-the-cost-of-living-as-lanarkshire-named-latest-ai-growth-zone",
        "£8.2bn private investment and 3,400 jobs, as reported",
    ),
    (
        "north-wales",
        "North Wales",
        "Wrexham / Deeside",
        "Wales",
        "confirmed",
        None,
        None,
        "2025-11-13",
        "Department for Science Innovation and Technology",
        "https://www.gov.uk/government/news/ai-growth-zones-to-create-thousands-of-jobs-and-unlock-up-to-100-billion-in-investment-as-new-site-confirmed-for-north-wales",
        "Part of programme projected to unlock up to £100bn nationally (not site-specific)",
    ),
    (
        "greater-manchester",
        "Greater Manchester",
        None,
        "North West England",
        "announced",
        None,
        None,
        "2025-01-13",
        "Department for Science Innovation and Technology",
        "https://www.gov.uk/government/publications/ai-opportunities-action-plan-one-year-on",
        "Named as an early AI Growth Zone region",
    ),
)
