"""Column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen. ``try_`` variants are used wherever bad text must become NULL rather
than fail the job under ANSI mode (D13).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The low-water default used when a target holds no rows, and the
# text that replaces NULL or blank strings.
LOW_WATER_DEFAULT = "1900-01-01 00:00:00"
BLANK_DEFAULT = "NAFS"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """Trim spaces; an empty result becomes NULL."""
    return F.nullif(F.trim(col_of(c)), F.lit(""))


def clean_string(c: str | Column, default: str = BLANK_DEFAULT) -> Column:
    """Trimmed text, or ``default`` for NULL and blank values."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def safe_date(c: str | Column, fmt: str | None = None) -> Column:
    """Text to date; blank or invalid text gives NULL instead of an error."""
    c = blank_to_null(c)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def safe_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    c = blank_to_null(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds to a timestamp instant.

    ``timestamp_seconds`` keeps both instants of a doubled DST hour, which a
    round trip through formatted text would merge.
    """
    return F.timestamp_seconds(col_of(c))


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def epoch_to_ntz(c: str | Column) -> Column:
    """Epoch seconds to a UTC wall-clock ``timestamp_ntz``, independent of the
    session time zone."""
    return F.timestamp_add("SECOND", col_of(c), _epoch_ntz())


def instant_to_utc(c: str | Column) -> Column:
    """A timestamp instant as its UTC wall clock (``timestamp_ntz``),
    independent of the session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_of(c)), _epoch_ntz())
