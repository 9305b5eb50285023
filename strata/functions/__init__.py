"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from strata.functions.parse import (  # noqa: F401
    NA_TOKENS,
    dayfirst_timestamp,
    lenient_double,
    lenient_timestamp,
    null_na_tokens,
    utc_naive_timestamp,
)
from strata.functions.scalars import (  # noqa: F401
    age_floor_years,
    age_years,
    clip_upper,
    deceased_flag,
    delta_pct,
    matches_flag,
    percent,
    sanitize_name,
    sanitize_name_truncated,
)
