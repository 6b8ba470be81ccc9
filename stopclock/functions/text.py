"""Number formatting for report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def with_commas(number: Column, places: int = 0) -> Column:
    return F.format_number(number, places)


def fixed_point(number: Column, places: int) -> Column:
    """Fixed decimals without grouping.

    ``format_number`` rounds the exact binary value half-even, which is what
    C-style ``%.nf`` does; Java's own ``format_string`` rounds half-up on the
    shortest decimal and would show 2.25 as 2.3.
    """
    return F.replace(F.format_number(number, places), F.lit(","), F.lit(""))


def percentile_label(percentile: Column) -> Column:
    """The shortest decimal with at least one place, never in powers of ten."""
    plain = percentile.cast("decimal(25,20)").cast("string")
    return F.concat(F.regexp_replace(plain, "(\\.[0-9]+?)0+$", "$1"), F.lit("th"))


def run_time(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """When the query runs, as text in the session time zone."""
    return F.date_format(F.current_timestamp(), pattern)
