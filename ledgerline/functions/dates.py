"""Date and timestamp text. Bad text gives null, never an error, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positional_date(text: Column) -> Column:
    """``dd/MM/yyyy`` read by character position, so ``5/7/2020`` has no date."""
    digits = F.concat(F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))
    return F.try_to_date(digits, "yyyyMMdd")


def lenient_date(text: Column) -> Column:
    """Day-month-year with ``/`` or ``-`` and with or without padding."""
    return F.try_to_date(F.translate(text, "/", "-"), "d-M-yyyy")


def us_date_text(text: Column) -> Column:
    """Day-month-year text rewritten as ``MM/dd/yyyy`` text."""
    return F.date_format(lenient_date(text), "MM/dd/yyyy")


def parse_us_date(text: Column) -> Column:
    return F.try_to_date(text, "MM/dd/yyyy")


def iso_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def parse_timestamp(text: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ssZZZZ") -> Column:
    """Timestamp text with a zone offset, written with or without a colon.

    Older patterns spell the offset ``ZZZZ``, which newer Spark reads differently; it is replaced by the
    two offset forms that occur in data (``+01:00`` or ``Z``, and ``+0100``).
    """
    if not pattern.endswith("ZZZZ"):
        return F.try_to_timestamp(text, F.lit(pattern))
    stem = pattern[: -len("ZZZZ")]
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(stem + "XXX")),
        F.try_to_timestamp(text, F.lit(stem + "xx")),
    )


def month_start(moment: Column) -> Column:
    return F.trunc(moment.cast("date"), "month")
