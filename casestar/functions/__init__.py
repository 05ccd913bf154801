"""Column expressions: lenient parsing, key normalization, labels and rates. All JVM-side."""

from casestar.functions.columns import (
    all_zero,
    day_part,
    exceeds,
    hour_of_stamp,
    is_blank,
    lenient_double,
    lenient_int,
    lenient_long,
    null_outside,
    null_zero,
    period_label,
    rate_per,
    severity,
    text_bytes,
    trimmed_or,
    utc_stamp,
    year_month_label,
)

__all__ = [
    "all_zero",
    "day_part",
    "exceeds",
    "hour_of_stamp",
    "is_blank",
    "lenient_double",
    "lenient_int",
    "lenient_long",
    "null_outside",
    "null_zero",
    "period_label",
    "rate_per",
    "severity",
    "text_bytes",
    "trimmed_or",
    "utc_stamp",
    "year_month_label",
]
