from subtide.functions.columns import (  # noqa: F401
    column,
    days,
    elapsed_seconds,
    first_match,
    hours,
    money,
    month_start,
    ntz,
    outside,
    passes,
    pct,
    sort_keys,
)
