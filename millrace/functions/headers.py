"""Header rules. Pure metadata: they rename columns and start no job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

# The columns the temperature processing job needs, and the
# names it accepts when they are missing.
REQUIRED = ("noted_date", "temp", "out/in")
ALIASES = {"date": "noted_date", "temperature": "temp"}


class HeaderCollision(ValueError):
    """Two source columns would end up with the same name."""


def clean_name(name: str, slash: bool = False) -> str:
    cleaned = name.strip().lower().replace(" ", "_")
    return cleaned.replace("/", "_") if slash else cleaned


def with_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    names = list(names)
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise HeaderCollision(f"columns {df.columns} give repeated names {repeated}")
    return df.toDF(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return with_names(df, [mapping.get(c, c) for c in df.columns])


def standardise(df: DataFrame, slash: bool = False) -> DataFrame:
    return with_names(df, [clean_name(c, slash) for c in df.columns])


def canonical_for_processing(df: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    """Give each required name to the first column whose name contains it.

    Only the searched text has its slash replaced, so ``out/in`` is matched by
    a column holding ``out_in`` and is otherwise left as it is.
    """
    mapping: dict[str, str] = {}
    for name in required:
        wanted = clean_name(name, slash=True)
        found = next((c for c in df.columns if wanted in c), None)
        if found is not None:
            mapping[found] = name
    return rename(df, mapping)


def canonical_for_load(df: DataFrame, loose: bool = False) -> DataFrame:
    """Name date, temperature and location columns by the text they contain.

    ``loose`` also takes any column containing ``out`` or ``in`` as location.
    """
    markers = [("date", "noted_date"), ("temp", "temp")]
    markers += [("out", "out_in"), ("in", "out_in")] if loose else [("out_in", "out_in")]
    mapping = {}
    for column in df.columns:
        target = next((t for text, t in markers if text in column), None)
        if target is not None:
            mapping[column] = target
    return rename(df, mapping)


def apply_aliases(df: DataFrame, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Accept a fallback name only where the wanted column is missing."""
    present = set(df.columns)
    return rename(
        df, {a: w for a, w in aliases.items() if a in present and w not in present}
    )
