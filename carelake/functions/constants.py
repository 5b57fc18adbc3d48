"""Fixed values.

FIXED VALUES: these lists must equal the domain vocabulary of the claims /
appeals data model for results to line up (category names, code lists,
status names).  They are stated here once, in their natural order; every
derived column picks from them by position.
"""

# --- FIXED VALUES (domain vocabulary, natural order) -----------------------
PLAN_TYPES = ["Medicare", "Medicare Advantage", "Medicare Supplement"]
GENDERS = ["M", "F"]
STATES = ["CA", "TX", "FL", "NY", "PA", "IL", "OH", "GA", "NC", "MI",
          "NJ", "VA", "WA", "AZ", "MA", "TN", "IN", "MO", "MD", "WI"]
PROVIDER_TYPES = ["Hospital", "Physician", "Specialist", "Lab", "DME Supplier", "Pharmacy"]
SPECIALTIES = [
    "Internal Medicine", "Cardiology", "Orthopedics", "Oncology",
    "Endocrinology", "Neurology", "Pulmonology", "Rheumatology",
    "Gastroenterology", "Nephrology", "General Surgery", "Family Medicine",
]
SERVICE_TYPES = [
    "Inpatient", "Outpatient", "Lab", "Imaging", "DME",
    "Pharmacy", "Surgery", "Therapy", "Home Health",
]
CPT_CODES = [
    99213, 99214, 99215, 99223, 99232, 99283, 99284, 99285,
    70553, 71046, 73721, 74177, 77067,
    27447, 43239, 43249, 47562, 49505,
    90834, 97110, 97140, 97530,
]
HCPCS_CODES = [
    "E0601", "E0260", "E0470", "E0691", "E1390",
    "J1745", "J2505", "J3490", "J7613", "J9035",
    "L0650", "A4253", "A6216", "K0823", "Q4131",
]
GLP1_DRUGS = ["semaglutide", "liraglutide", "dulaglutide", "tirzepatide"]
OTHER_DRUGS = [
    "metformin", "atorvastatin", "lisinopril", "amlodipine", "omeprazole",
    "albuterol", "levothyroxine", "gabapentin", "hydrochlorothiazide", "prednisone",
]
NDC_CODES = [
    "00169-4132-12", "00169-4130-12", "00002-1506-80", "00002-1506-01",
    "00024-5850-01", "00024-5851-01", "00169-4775-13", "00169-4771-13",
    "00002-4448-01", "00074-3799-01", "00378-1805-01", "00071-0156-23",
    "00378-4150-05", "00093-7180-01", "00186-0379-01",
]
ICD10_CODES = [
    "E11.9", "E11.65", "E78.5", "I10", "J44.1", "M17.11", "M17.12",
    "Z96.641", "K21.0", "G89.29", "E66.01", "E66.09", "N18.3",
    "I25.10", "J45.20", "F32.1", "M54.5",
]
DENIAL_REASONS = [
    "Not medically necessary",
    "Service not covered under plan",
    "Prior authorization not obtained",
    "Out-of-network provider",
    "Benefit maximum exceeded",
    "Duplicate claim submission",
    "Experimental or investigational",
    "Missing or incomplete documentation",
    "Non-formulary drug",
    "Coverage terminated",
    "Pre-existing condition exclusion",
    "Timely filing limit exceeded",
]
DENIAL_CODES = [
    "CO-50", "CO-97", "CO-4", "CO-151", "OA-23",
    "PR-96", "CO-29", "CO-16", "CO-11", "CO-18",
    "CO-197", "CO-22",
]
DENIAL_CATEGORIES = [
    "Medical Necessity", "Coverage", "Administrative",
    "Network", "Benefit Limit", "Documentation",
]
APPEAL_TYPES = ["Standard", "Expedited", "External Review"]
APPEAL_SOURCES = ["Member", "Provider", "Representative"]
APPEAL_STATUSES = ["Pending", "Under Review", "Resolved - Upheld", "Resolved - Overturned", "Withdrawn"]
CLAIM_STATUSES = ["Approved", "Denied", "Pending", "In Review"]
CLAIM_STATUS_WEIGHTS_PCT = [55, 25, 12, 8]
# coverage span lengths in days
COVERAGE_DAYS = [365, 730, 1095]
# probabilities in percent
PA_APPROVED_PCT = 65
MEMBER_ACTIVE_PCT = 92
CLAIM_HAS_PA_PCT = 60
APPEAL_HAS_CLAIM_PCT = 70
APPEAL_HAS_PA_PCT = 50
APPEAL_DOCUMENTED_PCT = 75
# assistant loop limit and judge sampling
MAX_APPROVAL_ROUNDS = 10
JUDGE_SAMPLE_RATE = 1.0
# dashboard limits
TOP_DENIAL_REASONS_LIMIT = 5
RECENT_APPEALS_LIMIT = 8
# --- end FIXED VALUES -------------------------------------------------------

# Ours (not from the source application): brand names mapped to the generic
# names above.  The application's prompts mention brands; its data only has
# generics, so this lookup is our own.
BRAND_TO_GENERIC = [
    ("Ozempic", "semaglutide"),
    ("Wegovy", "semaglutide"),
    ("Rybelsus", "semaglutide"),
    ("Victoza", "liraglutide"),
    ("Saxenda", "liraglutide"),
    ("Trulicity", "dulaglutide"),
    ("Mounjaro", "tirzepatide"),
    ("Zepbound", "tirzepatide"),
]

ALL_DRUGS = GLP1_DRUGS + OTHER_DRUGS

# Default as-of date replacing "today" so results are reproducible.
DEFAULT_AS_OF = "1998-01-01"
# Base date for coverage spans in the fixture recipe.
COVERAGE_BASE = "1995-01-01"
