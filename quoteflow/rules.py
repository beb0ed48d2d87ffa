"""Fixed values of the quote contract.

Every value in this file is part of the observable contract (prices, limits, error texts, names),
so it is stated literally here and nowhere else.
"""

from decimal import Decimal

# --- fixed values: regional pricing rules ------------------------------------------------------
REGIONS = ("IN", "US", "EU")
CURRENCY = {"IN": "INR", "US": "USD", "EU": "EUR"}
TAX_RATE = {"IN": Decimal("0.18"), "US": Decimal("0.0825"), "EU": Decimal("0.20")}
SHIPPING_FEE = {"IN": Decimal("49.00"), "US": Decimal("15.00"), "EU": Decimal("12.00")}
FREE_SHIPPING_FROM = {"IN": Decimal("999.00"), "US": Decimal("100.00"), "EU": Decimal("90.00")}

# --- fixed values: coupons ---------------------------------------------------------------------
PERCENT_COUPON = "SAVE10"
PERCENT_COUPON_RATE = Decimal("0.10")
PERCENT_COUPON_CAP = Decimal("500.00")
FLAT_COUPON = "FLAT50"
FLAT_COUPON_AMOUNT = Decimal("50.00")
FLAT_COUPON_MIN_SUBTOTAL = Decimal("500.00")

# --- fixed values: size limits of a request ----------------------------------------------------
MAX_QUOTES = 50
MAX_ITEMS = 100
MAX_SKU = 64
MAX_COUPON = 32
MAX_QTY = 1000
MAX_UNIT_PRICE = Decimal("100000")
PRICE_MAX_DIGITS = 8
PRICE_MAX_PLACES = 2

# --- fixed values: dead-letter reasons, in the order they are checked ----------------------------
EMPTY_MESSAGE = "empty message"
MALFORMED_JSON = "malformed JSON"
NOT_AN_OBJECT = "message is not a JSON object"
MISSING_JOB_ID = "missing job_id"
BAD_QUOTES = "quotes must be a list of 1-50 requests"
QUOTE_NOT_OBJECT = " is not an object"
BAD_REGION = ".region must be IN, US or EU"
BAD_ITEMS = ".items must be a list of 1-100 items"
ITEM_NOT_OBJECT = " is not an object"
BAD_SKU = ".sku must be 1-64 characters"
BAD_QTY = ".qty must be an integer from 1 to 1000"
BAD_PRICE = ".unit_price must be > 0 and <= 100000 with at most 2 decimals"
BAD_COUPON = ".coupon must be a string of at most 32 characters"

# --- fixed values: names of topics and headers ---------------------------------------------------
JOBS_TOPIC = "quote-jobs"
DLQ_TOPIC = "quote-jobs-dlq"
REQUESTS_TOPIC = "quote-requests"
STATS_TOPIC = "quote-region-stats"
STATS_TABLE = "quote_region_stats"
ERROR_HEADER = "dlq.error"
SOURCE_TOPIC_HEADER = "dlq.source.topic"

# --- fixed values: windows, retention, job states ------------------------------------------------
WINDOW = "1 minute"
GRACE = "30 seconds"
TTL_DAYS = 7
PENDING = "pending"
DONE = "done"
FAILED = "failed"
ENQUEUE_ERROR = "could not enqueue job"
PAYLOAD_ERROR = "invalid job payload"
QUOTE_NOT_FOUND = "Quote not found"
JOB_NOT_FOUND = "Job not found"
QUEUE_DOWN = "Job queue unavailable"

# --- fixed values: name-based quote ids (RFC 4122, URL namespace) ---------------------------------
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
DERIVED_ID_PREFIX = "quote-job:"

# --- fixed values: fields that differ between two runs of the same request ------------------------
VOLATILE_FIELDS = ("id", "created_at", "job_id", "quote_ids")
VOLATILE_MARK = "<volatile>"

# --- fixed values: traffic policy ------------------------------------------------------------------
RATE_LIMIT_PER_MINUTE = 6000
CANARY_WEIGHTS = {"stable": 20, "canary": 80}
LIVE_FAILURES_TO_UNHEALTHY = {"http": 3, "tcp": 2}
ACTIVE_FAILURES_TO_UNHEALTHY = {"http": 2, "tcp": 2, "timeout": 2}
P95_BUDGET_MS = 1000.0

# Names of the probe's metrics.
REQUESTS_METRIC = "probe_requests_total"
ERRORS_METRIC = "probe_errors_total"
LATENCY_METRIC = "probe_latency_p95_ms"

# What becomes of a worker message besides ``done`` and ``failed``.
SKIPPED = "skipped"
DEAD_LETTER = "dead_letter"
UNREADABLE = "no readable job id"

# Why an order is not priced.
NO_ITEMS = "no items"
TOO_MANY_ITEMS = "more than 100 items"
ITEM_OUT_OF_RANGE = "item out of range"
REGION_WITHOUT_PRICES = "region without prices"
