"""Column expressions shared by the operators. Malformed input becomes null, never an error."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# a number with a decimal point, and the replacement that leaves its whole part
DECIMAL_TEXT = r"^\s*(?<sign>[+-]?)(?<digits>\d*)\.\d*\s*$"
WHOLE_PART = "${sign}0${digits}"


def is_blank(text: Column) -> Column:
    """True for null, empty and all-space text. Never null itself."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def _lenient_integral(text: Column, kind: str) -> Column:
    # '1.7' counts as 1. The regular expression only runs where the plain cast found nothing.
    # It is one short expression because a row's whole cleaning shares a generated method,
    # and the JVM never compiles a method above 8000 bytes.
    whole = F.regexp_replace(text, DECIMAL_TEXT, WHOLE_PART)
    return F.coalesce(text.try_cast(kind), whole.try_cast(kind))


def lenient_int(text: Column) -> Column:
    return _lenient_integral(text, "int")


def lenient_long(text: Column) -> Column:
    return _lenient_integral(text, "bigint")


def lenient_double(text: Column) -> Column:
    return text.try_cast("double")


def null_zero(number: Column) -> Column:
    return F.nullif(number, F.lit(0.0))


def null_outside(number: Column, low: float, high: float) -> Column:
    """The number where it lies in the closed range, else null."""
    return F.when(number.between(F.lit(float(low)), F.lit(float(high))), number)


def utc_stamp(date_text: Column, time_text: Column, date_format: str, time_format: str,
              default_time: str) -> Column:
    """Date and time text as an instant, read as UTC whatever the session's time zone is."""
    filled = F.coalesce(F.trim(time_text), F.lit(default_time))
    return F.try_to_timestamp(
        F.concat_ws(" ", date_text, filled, F.lit("+00:00")),
        F.lit(f"{date_format} {time_format} xxx"),
    )


def hour_of_stamp(stamp: Column) -> Column:
    """Hour of day in UTC; ``hour()`` would shift with the session's time zone."""
    return F.floor(F.pmod(F.unix_seconds(stamp), F.lit(86400)) / 3600).cast("int")


def all_zero(numbers: list[Column]) -> Column:
    """Three-valued AND: false if any number is non-zero, else null if any is null, else true."""
    return reduce(and_, [number == 0 for number in numbers])


def exceeds(number: Column, threshold: int) -> Column:
    """Strictly above the threshold; null counts as false."""
    return F.coalesce(number > threshold, F.lit(False))


def trimmed_or(text: Column, placeholder: str | None) -> Column:
    """Join-key text: trimmed, null replaced. Blank text stays ``''``, it is not null."""
    trimmed = F.trim(text)
    return trimmed if placeholder is None else F.coalesce(trimmed, F.lit(placeholder))


def severity(killed: Column) -> Column:
    return F.when(killed > 0, "Fatal").otherwise("Non-Fatal")


def day_part(hour: Column, parts, otherwise: str) -> Column:
    label = F.lit(otherwise)
    for name, first, last in reversed(parts):
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label


def period_label(year: Column, split_year: int) -> Column:
    return F.when(year >= split_year, f"Post-{split_year}").otherwise(f"Pre-{split_year}")


def rate_per(part: Column, total: Column, scale: int) -> Column:
    """``part`` per ``scale`` of ``total`` as an exact decimal; 0 where the total is 0."""
    factor = F.lit(f"{scale}.0").cast(f"decimal({len(str(scale)) + 1},1)")
    exact = part * factor / total
    return F.when(total > 0, exact).otherwise(F.lit(0))


def year_month_label(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def text_bytes(columns: list[Column]) -> Column:
    """Bytes of text in one row, null counting as none."""
    return reduce(lambda total, text: total + F.coalesce(F.octet_length(text), F.lit(0)),
                  columns, F.lit(0).cast("bigint"))
