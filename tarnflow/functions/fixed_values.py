"""Word lists, patterns, labels and limits that results must agree on."""

from __future__ import annotations

# ---- fixed values: reject reasons of the schema stage, in the order they are tested ----
UNEXPECTED = "unexpected_normalize_error"
MISSING_ID = "missing_id"
MISSING_SESSION_ID = "missing_session_id"
MISSING_EVENT_TYPE = "missing_event_type"
MISSING_PLATFORM = "missing_platform"
INVALID_EVENT_TIMESTAMP = "invalid_event_timestamp"
INVALID_DT = "invalid_dt"

# ---- fixed values: data-quality rules, in the order they are tested ----
ALLOWED_PLATFORMS = ("web", "mobile")
FUTURE_TOLERANCE_MINUTES = 5
INVALID_PLATFORM = "invalid_platform"
EVENT_TS_IN_FUTURE = "event_ts_in_future"
DQ_REASONS = (INVALID_PLATFORM, EVENT_TS_IN_FUTURE)

# Ours: a landed document that is not a readable envelope.
MALFORMED_ENVELOPE = "malformed_envelope"

# ---- fixed values: defaults ----
UNKNOWN_BATCH = "unknown"
EPOCH = "1970-01-01T00:00:00Z"
LOOKBACK_DAYS = 3

# ---- fixed values: device family, first matching pattern wins ----
DEVICE_FAMILIES = (
    ("(?i)iphone|ipad", "apple_mobile"),
    ("(?i)pixel|samsung|android", "android_mobile"),
    (r"(?i)macbook|\bmac\b", "apple_desktop"),
    ("(?i)windows", "windows_desktop"),
)
DEVICE_FAMILY_ELSE = "other"
DEVICE_FAMILY_ABSENT = "unknown"

# ---- fixed values: province to region, case-sensitive ----
GEO_REGIONS = (
    (("Nova Scotia", "New Brunswick", "Prince Edward Island", "Newfoundland and Labrador"), "atlantic"),
    (("Alberta", "Saskatchewan", "Manitoba"), "prairies"),
    (("Ontario",), "ontario"),
    (("Quebec",), "quebec"),
    (("British Columbia",), "bc"),
)
GEO_REGION_ELSE = "unknown"

# ---- fixed values: event type to category, on the lower-cased type ----
EVENT_CATEGORIES = (
    (("pageview", "clicks", "referral"), "engagement"),
    (("log_in", "log_off", "signups"), "account"),
    (("delete_account",), "churn_signal"),
)
EVENT_CATEGORY_ELSE = "other"

# ---- fixed values: columns of the sample shown after a run ----
SAMPLE_COLUMNS = (
    "event_id",
    "event_type",
    "platform",
    "country",
    "geo_region",
    "device_family",
    "event_hour",
    "event_category",
)
SAMPLE_ROWS = 5
