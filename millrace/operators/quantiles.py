"""Exact percentiles that never need all values in one place, and the trim.

Ranks are found by counting. A first histogram over logarithmic buckets gives
the number of rows and the bucket each wanted rank falls into. A bucket that
holds too many rows is cut into equal slices and counted again, until it holds
one value only or few enough rows to order. Every step is a grouped count that
combines before its small shuffle, and the driver only sees bucket rows.
Readings with limited resolution take two passes over one column; a slice is
4096 times narrower than its bucket, so any column takes a handful.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_LIMIT = 1_000_000  # rows one task may order; about 100 MB
OCTAVE_STEPS = 8  # first-round buckets per power of two
SLICES = 4096  # buckets per range in later rounds


@dataclass(frozen=True)
class Range:
    """An interval of values: its smallest and largest, the rows below and in it."""

    low: float
    high: float
    below: int
    rows: int


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    row_limit: int = ROW_LIMIT,
) -> list[float | None]:
    """Percentiles with linear interpolation over the numbers in a column."""
    value = F.col(column).cast("double")
    values = df.select(value.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    first = _histogram(values.withColumn("_range", F.lit(0)), _octave(F.col("v")))
    total = sum(r["rows"] for r in first)
    if not total:
        return [None] * len(probabilities)
    places = [p * (total - 1) for p in probabilities]
    ranks = {k for at in places for k in (math.floor(at), min(math.floor(at) + 1, total - 1))}
    found = _values_at(values, {k: _locate(first, k, 0) for k in ranks}, row_limit)
    results = []
    for at in places:
        low, part = found[math.floor(at)], at - math.floor(at)
        high = found[min(math.floor(at) + 1, total - 1)]
        results.append(low if part == 0 or low == high else (1 - part) * low + part * high)
    return results


def _octave(v: Column) -> Column:
    """Logarithmic bucket with the sign of ``v``; grows with ``v``."""
    size = F.least(F.log2(F.abs(v)), F.lit(1100.0)) + F.lit(1100.0)
    bucket = F.floor(size * F.lit(OCTAVE_STEPS)) + F.lit(1)
    return F.when(v == 0, F.lit(0)).when(v > 0, bucket).otherwise(-bucket)


def _histogram(tagged: DataFrame, bucket: Column) -> list:
    """Counts per range and bucket, in value order. At most a few thousand rows."""
    counted = tagged.groupBy("_range", bucket.alias("_bucket")).agg(
        F.count("*").alias("rows"),
        F.min("v").alias("low"),
        F.max("v").alias("high"),
    )
    return sorted(counted.collect(), key=lambda r: (r["_range"], r["low"]))


def _locate(buckets: list, rank: int, below: int) -> Range:
    """The bucket that holds a rank, given the rows below the first bucket."""
    for b in buckets:
        if rank < below + b["rows"]:
            return Range(b["low"], b["high"], below, b["rows"])
        below += b["rows"]
    raise AssertionError("rank beyond the counted rows")


def _tag(values: DataFrame, ranges: Sequence[Range]) -> DataFrame:
    """Rows of the ranges with the number of their range."""
    number = F.when(F.lit(False), F.lit(0))
    for i, r in enumerate(ranges):
        number = number.when(F.col("v").between(r.low, r.high), F.lit(i))
    return values.withColumn("_range", number).where(F.col("_range").isNotNull())


def _slice(ranges: Sequence[Range]) -> Column:
    """Equal slices of each range; grows with ``v``."""
    bucket = F.when(F.lit(False), F.lit(0).cast("bigint"))
    for i, r in enumerate(ranges):
        place = (F.col("v") - F.lit(r.low)) / F.lit(r.high - r.low)
        bucket = bucket.when(F.col("_range") == i, F.floor(place * F.lit(float(SLICES))))
    return bucket


def _values_at(values: DataFrame, where: dict[int, Range], limit: int) -> dict[int, float]:
    """The values at the wanted ranks (from 0), each known to lie in a range."""
    while True:
        open_ranges = {r for r in where.values() if r.low < r.high}
        wide = sorted((r for r in open_ranges if r.rows > limit), key=lambda r: r.low)
        if not wide:
            break
        counted = _histogram(_tag(values, wide), _slice(wide))
        for rank, r in where.items():
            if r in wide:
                inside = [b for b in counted if b["_range"] == wide.index(r)]
                where[rank] = _locate(inside, rank, r.below)
    found = {k: r.low for k, r in where.items() if r.low == r.high}
    narrow = sorted(open_ranges, key=lambda r: r.low)
    if narrow:
        # At most ``limit`` rows of a range reach this window.
        place = F.row_number().over(Window.partitionBy("_range").orderBy("v"))
        ranked = _tag(values, narrow).withColumn("_place", place - F.lit(1))
        rest = sorted(set(where) - set(found))
        picks = []
        for k in rest:
            r = where[k]
            here = (F.col("_range") == narrow.index(r)) & (F.col("_place") == k - r.below)
            picks.append(F.max(F.when(here, F.col("v"))).alias(f"r{k}"))
        found.update(zip(rest, ranked.agg(*picks).first()))
    return found


def between(df: DataFrame, column: str, bounds: Sequence[float | None]) -> DataFrame:
    """Rows inside the bounds, both ends included. Literals reach the file scan."""
    lower, upper = (F.lit(b).cast("double") for b in bounds)
    return df.where((F.col(column) >= lower) & (F.col(column) <= upper))


def percentile_trim(
    df: DataFrame,
    column: str = "temp",
    low: float = 0.05,
    high: float = 0.95,
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Rows between the two percentiles of ``column``, both ends included."""
    return between(df, column, quantiles(df, column, (low, high), row_limit))


def trim_report(
    df: DataFrame, bounds: Sequence[float | None], column: str = "temp"
) -> DataFrame:
    """The bounds, and row counts and ranges before and after the trim, in one pass."""
    lower, upper = (F.lit(b).cast("double") for b in bounds)
    value = F.col(column)
    kept = F.when((value >= lower) & (value <= upper), value)
    return df.agg(
        F.count(value).alias("rows_before"),
        F.count(kept).alias("rows_after"),
        F.min(value).alias("min_before"),
        F.max(value).alias("max_before"),
        F.min(kept).alias("min_after"),
        F.max(kept).alias("max_after"),
    ).select(lower.alias("lower_percentile"), upper.alias("upper_percentile"), "*")
