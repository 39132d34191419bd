from idwarden.functions.columns import (
    all_not_null,
    any_null,
    blank_to_null,
    elapsed,
    first_rows,
    is_failure,
    labelled,
    seconds,
    within_rate,
)

__all__ = [
    "all_not_null",
    "any_null",
    "blank_to_null",
    "elapsed",
    "first_rows",
    "is_failure",
    "labelled",
    "seconds",
    "within_rate",
]
