"""Column-level helpers (built-in Spark expressions only)."""

from paymart.functions.columns import (  # noqa: F401
    as_date,
    as_text,
    day_of,
    day_range_predicate,
    first_null,
    to_millis,
    try_cast,
)
