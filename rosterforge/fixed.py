"""Values whose exact spelling decides results.

Everything here is a fixed value of the record format: word lists, closed
sets, limits, prices.  Nothing in this module is logic.
"""

# --- fixed values: register standardisation -------------------------------

UNKNOWN_NAME = "Unknown"

EXCLUDED_TYPES = ["Agency", "Residential"]

EXCLUDED_NAME_WORDS = [
    "child placing",
    "residential treatment",
    "placement agency",
    "adoption",
    "foster care",
]

# (type, words that select it), tested in this order on lower-cased text
TYPE_WORDS = [
    ("Agency", ["child placing", "agency", "placement"]),
    ("Residential", ["residential", "treatment", "shelter"]),
    ("Center", ["center"]),
    ("Home", ["home", "family"]),
    ("School", ["school"]),
]
OTHER_TYPE = "Other"

# Drop reasons in the order they are tested; the first that holds is kept.
DROP_REASONS = [
    "filtered_type",
    "filtered_keyword",
    "filtered_capacity",
    "filtered_contact",
    "missing_name",
    "missing_address",
    "filtered_city",
    "filtered_state",
    "filtered_zip",
    "inactive",
    "duplicate",
    "processing_error",
]

# --- fixed values: place lookup -------------------------------------------

NOT_FOUND = "NOT_FOUND"
MISMATCH = "mismatch"
MISMATCH_CACHED = "mismatch_cached"
CLOSED_FOR_GOOD = "CLOSED_PERMANENTLY"
NAME_RATIO_THRESHOLD = 0.3
PLACE_PHOTO_LIMIT = 5

# --- fixed values: site selection -----------------------------------------

CRAWL_MAX_DEPTH = 3
CRAWL_MAX_PAGES = 15

PRIORITY_LINK_WORDS = [
    "about",
    "program",
    "curriculum",
    "tuition",
    "contact",
    "gallery",
    "admission",
    "staff",
    "team",
    "philosophy",
    "schedule",
]

BLOCKED_LINK_WORDS = [
    "blog",
    "news",
    "event",
    "calendar",
    "login",
    "portal",
    "parent-portal",
    "career",
    "job",
    "policy",
    "terms",
    "privacy",
]

IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".webp"]
PDF_MIN_BYTES = 5 * 1024
IMAGE_MIN_BYTES = 10 * 1024
IMAGE_MIN_SIDE = 200
IMAGE_MIN_RATIO = 0.33
IMAGE_MAX_RATIO = 3.0
STORED_IMAGE_WIDTH = 1000
MODEL_IMAGE_SIDE = 500
PAGE_TEXT_MIN_CHARS = 100
MAIN_TEXT_MIN_CHARS = 200

# --- fixed values: refinement ---------------------------------------------

RANK_MIN_BYTES = 5000
IMAGE_TOP_N = 10
PDF_TOP_N = 5

PDF_PRIORITY_WORDS = [
    "handbook",
    "policy",
    "parent",
    "tuition",
    "rates",
    "enroll",
    "schedule",
    "calendar",
]
PDF_LOW_WORDS = ["menu", "lunch", "flyer", "news", "update"]

NOISE_PATTERNS = [
    r"copyright \d{4}",
    r"all rights reserved",
    r"privacy policy",
    r"terms of use",
    r"cookie policy",
    r"subscribe to our newsletter",
    r"follow us on",
    r"menu",
    r"navigation",
    r"skip to content",
    r"search this site",
    r"sign in",
    r"log in",
    r"cart \(\d+\)",
]

SITE_TEXT_CAP = 100_000
SITE_TEXT_CAP_MARK = "\n...[Truncated]..."

POSITIVE_PROMPTS = [
    "daycare classroom with educational toys",
    "safe fenced outdoor playground",
    "children napping on cots",
    "clean toddler bathroom with small sinks",
    "children eating healthy food at table",
    "children art work on walls",
    "secure entrance gate with keypad",
    "teacher reading to circle of kids",
    "bright montessori shelf with materials",
    "soft play area for infants",
    "happy children playing together",
    "daycare building exterior",
]
NEGATIVE_PROMPTS = [
    "icon",
    "logo",
    "website banner",
    "text document",
    "flyer",
    "map",
    "blurry image",
    "stock photo of business people",
    "closeup of food only",
    "empty parking lot",
    "abstract background pattern",
    "clipart vector graphic",
]

# --- fixed values: synthesis ----------------------------------------------

CONTEXT_TEXT_CAP = 20_000
DESCRIPTION_CAP = 1_000
DESCRIPTION_WINDOW = 150
RESEARCH_RAW_CAP = 200
SYNTHESIS_RAW_CAP = 1_000
IMAGE_CANDIDATE_LIMIT = 10
MODEL_TRIES = 3
MODEL_FIRST_WAIT = 1.0

PROGRAM_TYPES = [
    "Montessori",
    "Reggio",
    "Waldorf",
    "Play-based",
    "Academic",
    "Religious",
    "Nature-based",
    "Language Immersion",
]
AVAILABILITY_STATUSES = ["Waitlist", "Open Enrollment", "Call to Confirm"]
RANKING_TIERS = ["Top Rated", "Verified", "Standard", "Needs Review"]
# (tier, lowest total that earns it), best first
TIER_FLOORS = [("Top Rated", 85), ("Verified", 70), ("Standard", 50), ("Needs Review", 0)]
SCORE_PARTS = [
    "safety_and_transparency",
    "facility_environment",
    "teacher_quality",
    "parent_reputation",
]
PART_SCORE_MAX = 25
TOTAL_SCORE_MAX = 90
NO_SITE_SAFETY_MAX = 10
NO_REVIEWS_REPUTATION_MAX = 5
MAX_TAGS = 5

FINAL_COLUMNS = [
    "daycare_id", "name", "trust_score", "trust_score_explanation",
    "score_breakdown", "ranking_tier", "review_score", "review_count",
    "min_age_months", "max_age_months", "program_type", "meals_provided",
    "snacks_provided", "teacher_student_ratio", "cameras", "secure_entry",
    "availability_status", "price_start", "price_end", "certifications",
    "capacity", "operating_hours", "is_internal", "thumbnail_url", "headline",
    "sub_headline", "description", "search_tags", "insights",
    "google_maps_url", "google_place_id", "website_url", "website_active",
    "email", "director_name", "phone", "address", "city", "state", "zip",
    "country", "latitude", "longitude", "photos",
]

# --- fixed values: publishing ---------------------------------------------

COUNTRY = "US"
LISTING_STATUS = "ACTIVE"
REVIEW_SOURCE = "google"
PHOTO_SOURCE = "google_photo"
STREET_VIEW_SOURCE = "google_street_view"
REPLACED_SOURCES = [PHOTO_SOURCE, STREET_VIEW_SOURCE]
DEFAULT_CONTENT_TYPE = "application/octet-stream"

CONTENT_TYPES = {
    "jpg": "image/jpeg",
    "jpeg": "image/jpeg",
    "png": "image/png",
    "gif": "image/gif",
    "webp": "image/webp",
    "pdf": "application/pdf",
    "txt": "text/plain",
    "html": "text/html",
    "htm": "text/html",
    "json": "application/json",
    "csv": "text/csv",
}

RESEARCH_STEP = "gemini_search"
SYNTHESIS_STEP = "gemini_finalizer"

# USD per million tokens, per step
TOKEN_PRICES = {
    RESEARCH_STEP: (0.50, 3.00),
    SYNTHESIS_STEP: (0.50, 3.00),
}

# --- fixed values: landed register batches --------------------------------

REGISTER_PAGE_SIZE = 100_000
