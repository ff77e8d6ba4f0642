"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from adlens.functions.dates import (  # noqa: F401
    day_of_week, parse_event_timestamp, period_start, sunday_week_of_year,
    timestamp_shape_ok, timestamp_text,
)
from adlens.functions.numeric import (  # noqa: F401
    exact_sum, round_half_up, safe_divide,
)
from adlens.functions.hashing import uniform_draw, uuid_from_hash  # noqa: F401
