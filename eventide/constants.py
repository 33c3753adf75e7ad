"""They must equal the data contract for the results to be right."""

# Event types the raw event table may hold.
ACCEPTED_EVENT_TYPES = ["click", "purchase", "view", "search", "session_start", "session_end"]

# Text that stands for NULL inside a surrogate key (public dbt_utils contract).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

# Scheme and host of a web address.
URL_ORIGIN = r"^https?://[^/]+"

# Keys read from the event payload.
PAYLOAD_KEYS = ["session_id", "page_url", "referrer", "device_type", "country_code"]

# Source name given to streamed events, and the defaults for missing categories.
STREAM_SOURCE = "gcp_pubsub"
DEFAULT_COUNTRY = "XX"
DEFAULT_DEVICE = "unknown"

# Days of late data the fact table still takes in.
LOOKBACK_DAYS = 3

# Gates: rows per day with tolerance, smallest day, largest relative count drift.
GATE_PASS_VALUE = 1000
GATE_TOLERANCE = 0.05
GATE_MIN_ROWS = 1000
GATE_MAX_DRIFT = 0.01

# Freshness limits in hours: (warn, error).
FRESHNESS_EVENTS = (12, 24)
FRESHNESS_TRANSACTIONS = (6, 12)

# Table care: file size after compaction, clustering columns, shortest history kept.
COMPACT_TARGET_MB = 256
ZORDER_COLUMNS = ["user_id", "event_type"]
RETENTION_HOURS = 168
ROWS_PER_FILE = 1_000_000

# Range split of a parallel database read.
RANGE_LOWER = 1
RANGE_UPPER = 1_000_000
RANGE_PARTS = 4
