"""Text to date, number and timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month-first text, the reading that keeps days up to the 12th.
READING_FORMAT = "MM-dd-yyyy HH:mm"

# What counts as a number (Java would also take "1d" and "0x1p3").
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def to_reading_time(column, fmt: str = READING_FORMAT) -> Column:
    """Timestamp without zone; text that does not fit the format gives NULL."""
    return F.try_to_timestamp(column, F.lit(fmt)).cast("timestamp_ntz")


def to_number(column) -> Column:
    """Double; anything that is not a number gives NULL."""
    column = F.col(column) if isinstance(column, str) else column
    text = column.cast("string")
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def drop_bad_dates(df: DataFrame, column: str = "noted_date", fmt: str = READING_FORMAT) -> DataFrame:
    return df.withColumn(column, to_reading_time(column, fmt)).where(F.col(column).isNotNull())


def drop_bad_numbers(df: DataFrame, column: str = "temp") -> DataFrame:
    return df.withColumn(column, to_number(column)).where(F.col(column).isNotNull())


def null_if_nan(column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.when(~F.isnan(column), column)


def iso_to_utc(column) -> Column:
    """ISO-8601 text with an offset -> TIMESTAMP. Bad text fails the job (ANSI)."""
    return F.to_timestamp(column)


def seconds_between(start, end) -> Column:
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("SECOND", start, end)


def resolution_seconds(status, created, updated, final=("resolved", "closed")) -> Column:
    """Seconds to resolution, only for tickets in a final status."""
    status = F.col(status) if isinstance(status, str) else status
    return F.when(status.isin(*final), seconds_between(created, updated))


def length_or_zero(column) -> Column:
    return F.coalesce(F.array_size(column), F.lit(0))
