"""Fixed values, raw schema and column documentation.

Everything under "Fixed values" must equal the attribution source's own
configuration so that staging filters, validator messages and synthetic
draws give the same results. They are stated once, here, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must match the source configuration exactly)
# ---------------------------------------------------------------------------

# Event types with their draw probabilities.
EVENT_TYPE_WEIGHTS = [
    ("impression", 0.60),
    ("click", 0.25),
    ("install", 0.12),
    ("reinstall", 0.03),
]

# Partners with market-share weights.
PARTNER_WEIGHTS = [
    ("Adjust", 0.30),
    ("AppsFlyer", 0.35),
    ("Branch", 0.20),
    ("Kochava", 0.10),
    ("Singular", 0.05),
]

# Cost range per event type, in USD (min, max).
COST_RANGES = {
    "impression": (0.001, 0.01),
    "click": (0.10, 0.50),
    "install": (1.50, 8.00),
    "reinstall": (0.80, 4.00),
}

# Platforms with weights.
PLATFORM_WEIGHTS = [
    ("iOS", 0.40),
    ("Android", 0.60),
]

SAMPLE_APPS = [
    "com.example.game",
    "com.example.fitness",
    "com.example.social",
    "com.example.ecommerce",
    "com.example.productivity",
]

SAMPLE_CAMPAIGNS = [
    "campaign_001_summer",
    "campaign_002_winter",
    "campaign_003_holiday",
    "campaign_004_launch",
    "campaign_005_retargeting",
    "campaign_006_brand",
    "campaign_007_performance",
    "campaign_008_test",
]

COUNTRY_WEIGHTS = [
    ("US", 0.25),
    ("CN", 0.15),
    ("IN", 0.12),
    ("BR", 0.10),
    ("JP", 0.08),
    ("DE", 0.07),
    ("GB", 0.06),
    ("FR", 0.05),
    ("KR", 0.05),
    ("CA", 0.07),
]

# Validator: required keys in checking order, accepted values.
REQUIRED_FIELDS = [
    "event_id",
    "timestamp",
    "event_type",
    "partner",
    "cost_usd",
    "app_id",
    "campaign_id",
    "platform",
    "country_code",
]
VALID_EVENT_TYPES = ["install", "reinstall", "click", "impression"]
VALID_PLATFORMS = ["iOS", "Android"]

# Staging: raw timestamp layout and accepted (raw, case-sensitive) types.
RAW_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STAGED_PLATFORMS = ["IOS", "ANDROID"]
GRAINS = ["daily", "weekly", "monthly"]

# ---------------------------------------------------------------------------
# Derived lists (no new values)
# ---------------------------------------------------------------------------
EVENT_TYPES = [t for t, _ in EVENT_TYPE_WEIGHTS]
PARTNERS = [p for p, _ in PARTNER_WEIGHTS]
PLATFORMS = [p for p, _ in PLATFORM_WEIGHTS]
COUNTRY_CODES = [c for c, _ in COUNTRY_WEIGHTS]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------
RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("partner", T.StringType()),
        T.StructField("cost_usd", T.DoubleType()),
        T.StructField("app_id", T.StringType()),
        T.StructField("campaign_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("country_code", T.StringType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Descriptions persisted as comments of tables and columns.
TABLE_DOCS = {
    "stg_mmp_events": """Cleaned and typed mobile measurement partner events.
This staging model performs:
- Type conversions (timestamp parsing, cost casting)
- Normalization (lowercase event types, uppercase platforms)
- Derived fields (date dimensions)
- Data quality filters (non-null timestamps, non-negative costs)""",
    "mart_installs_reinstalls": """Installs and reinstalls aggregated across daily, weekly, and monthly time grains.
This mart combines multiple aggregation levels for flexible reporting.""",
    "mart_click_through_rate": """Click-through rate (CTR) metrics aggregated across daily, weekly, and monthly time grains.
CTR is calculated as clicks divided by impressions.""",
    "mart_cost_per_install": """Cost per install (CPI) metrics aggregated across daily, weekly, and monthly time grains.
Includes both direct CPI (install cost only) and blended CPI (total cost including impressions/clicks).""",
}
STAGED_DOCS = {
    "event_id": "Unique event identifier (UUID)",
    "event_timestamp": "Parsed timestamp as TIMESTAMP type",
    "event_date": "Event date (derived from timestamp)",
    "event_type": "Normalized event type (lowercase)",
    "partner": "MMP partner name (lowercase)",
    "cost_usd": "Event cost in USD (FLOAT64)",
    "app_id": "Application identifier",
    "campaign_id": "Campaign identifier",
    "platform": "Mobile platform (uppercase)",
    "country_code": "ISO country code (uppercase)",
    "year": "Year extracted from timestamp",
    "month": "Month extracted from timestamp",
    "week": "Week number extracted from timestamp",
    "day_of_week": "Day of week (1=Sunday, 7=Saturday)",
}

METRIC_DOCS = {
    "installs": "Count of install events",
    "reinstalls": "Count of reinstall events",
    "clicks": "Count of click events",
    "impressions": "Count of impression events",
    "install_cost": "Direct cost of install events",
    "reinstall_cost": "Cost of reinstall events",
    "click_cost": "Cost of click events",
    "impression_cost": "Cost of impression events",
    "total_cost": "Total cost across all event types",
    "total_events": "Count of all events",
    "grain": "Time grain (daily, weekly, monthly)",
    "period": "Period identifier (formatted as YYYY-MM-DD string)",
    "partner": "Mobile measurement partner",
    "platform": "Mobile platform (iOS or Android)",
    "total_install_events": "Sum of installs and reinstalls",
    "total_install_cost": "Total cost for install and reinstall events",
    "ctr": "Click-through rate (decimal between 0 and 1)",
    "ctr_percentage": "Click-through rate as percentage",
    "cpi_direct": "Cost per install (install cost only)",
    "cpi_blended": "Blended cost per install (total cost / installs)",
    "cpi_direct_rounded": "Direct CPI rounded to 2 decimal places",
    "cpi_blended_rounded": "Blended CPI rounded to 2 decimal places",
}
