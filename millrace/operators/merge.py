"""Key-based merges of a source into a target, as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedupe import keep_first


def known_keys(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key exists in ``other``."""
    return df.join(other.select(*key), list(key), "left_semi").select(*df.columns)


def new_keys(df: DataFrame, other: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not exist in ``other``."""
    return df.join(other.select(*key), list(key), "left_anti").select(*df.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    keep: Sequence[str] = (),
    on_update: Sequence[str] = (),
) -> DataFrame:
    """The target after inserting new keys and updating known ones.

    ``source`` has the target's columns and unique keys. ``keep`` lists columns
    an update leaves as they are in the target; ``on_update`` lists columns an
    update sets to the current time (an insert takes them from the source).

    Rows that stay are filtered by an anti join with the source's keys
    (broadcast when there are few). Rows that arrive look up the target's key and
    kept columns alone, so a wide target is never shuffled as a whole.
    """
    columns = target.columns
    source = source.select(*columns)
    stay = new_keys(target, source, key)
    if not keep and not on_update:
        return stay.unionByName(source)

    known = target.select(
        *key, *[F.col(f"`{c}`").alias(f"_old_{c}") for c in keep], F.lit(True).alias("_known")
    )

    def merged(name: str):
        if name in keep:
            value = F.when(F.col("_known"), F.col(f"`_old_{name}`")).otherwise(F.col(f"`{name}`"))
        elif name in on_update:
            now = F.current_timestamp().cast(target.schema[name].dataType)
            value = F.when(F.col("_known"), now).otherwise(F.col(f"`{name}`"))
        else:
            value = F.col(f"`{name}`")
        return value.alias(name)

    arrived = source.join(known, list(key), "left").select(*[merged(c) for c in columns])
    return stay.unionByName(arrived)


def first_of_each(source: DataFrame, key: Sequence[str], order: str | Sequence[str] | None) -> DataFrame:
    """The first row of each key by ``order``, else by the values of the other columns."""
    rest = [c for c in source.columns if c not in key]
    return keep_first(source, list(key), order or rest) if order or rest else source.distinct()


def insert_ignore(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    order: str | Sequence[str] | None = None,
) -> DataFrame:
    """The target after inserting the first source row of each key it does not hold."""
    first = first_of_each(source, key, order)
    return target.unionByName(new_keys(first.select(*target.columns), target, key))
