"""Column types from cell texts, the same however the rows are spread.

Each cell is of a kind: missing, whole number, number, truth value or text. A column's
kinds add up as bits, and the bits say its type: a lattice in which whole numbers lie
below numbers and everything below text. One aggregate reads all columns; tasks send one
number for a column.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.coerce import NUMBER_TEXT, to_number

WHOLE, NUMBER, TRUTH, TEXT = 1, 2, 4, 8

# Spellings of truth values, and what a whole number looks like.
TRUE_TEXT, FALSE_TEXT = ("True", "TRUE", "true"), ("False", "FALSE", "false")
WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"


def cell_kind(cell: Column) -> Column:
    """A bit for the kind of a cell; 0 for a missing one."""
    whole = cell.rlike(WHOLE_TEXT) & F.trim(cell).try_cast("bigint").isNotNull()
    return (
        F.when(cell.isNull(), 0)
        .when(whole, WHOLE)
        .when(cell.rlike(NUMBER_TEXT), NUMBER)
        .when(cell.isin(*TRUE_TEXT, *FALSE_TEXT), TRUTH)
        .otherwise(TEXT)
    )


def type_of(kinds: int) -> str:
    """The least type that holds all kinds; a column without a cell is a number."""
    if kinds == WHOLE:
        return "bigint"
    if kinds == TRUTH:
        return "boolean"
    return "double" if kinds | WHOLE | NUMBER == WHOLE | NUMBER else "string"


def inferred_types(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, str]:
    """Type of each text column of ``df``, from every cell."""
    names = list(columns) if columns is not None else df.columns
    if not names:
        return {}
    bits = [F.bit_or(cell_kind(F.col(f"`{c}`"))).alias(f"k{i}") for i, c in enumerate(names)]
    found = df.agg(*bits).first()
    return {c: type_of(found[i] or 0) for i, c in enumerate(names)}


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as values of the inferred types; missing cells are NULL."""

    def typed(name: str, kind: str) -> Column:
        cell = F.col(f"`{name}`")
        if kind == "bigint":
            return F.trim(cell).cast("bigint")
        if kind == "double":
            return to_number(cell)
        return cell.isin(*TRUE_TEXT) if kind == "boolean" else cell

    return df.withColumns({name: typed(name, kind) for name, kind in types.items()})
