"""Scalar Column helpers: guarded casts, NULL rules, record canonical form."""

from moodline.functions.casts import (  # noqa: F401
    as_type,
    blank_to,
    is_missing,
    least_strict,
    safe_bool,
    safe_double,
    safe_timestamp,
)
