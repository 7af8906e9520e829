"""One row per key, chosen by an explicit order.

``min_by``/``max_by`` combine before the shuffle, so a key that holds a large
share of all rows leaves each task as a single row. The whole row travels as
one struct, so a NULL field of the chosen row stays NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _choose(df: DataFrame, key, order, pick: Callable) -> DataFrame:
    keys = _names(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    # A struct is never NULL itself, so rows with a NULL position still count.
    place = F.struct(*_names(order))
    chosen = pick(F.struct(*[F.col(f"`{c}`") for c in rest]), place).alias("_row")
    # Keys come from the grouping, so a join on them needs no second shuffle.
    picked = [F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns]
    return df.groupBy(*keys).agg(chosen).select(*picked)


def keep_first(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    return _choose(df, key, order, F.min_by)


def keep_last(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    return _choose(df, key, order, F.max_by)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*_names(key)).agg(F.count("*").alias("rows")).where("rows > 1")


def duplicate_key_count(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return duplicate_keys(df, key).agg(F.count("*").alias("duplicate_keys"))
