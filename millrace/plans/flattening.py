"""JSON and XML documents into flat tables. Appends by default, so a re-run adds rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.flatten import flatten_foods, flatten_pets
from millrace.sinks.tables import TableSpec, append, create, replace_all

NOW = {"processed_at": "current_timestamp()"}

PETS = TableSpec(
    name="flat_pets",
    ddl=(
        "name STRING, species STRING, fav_foods STRING, birth_year INT, photo STRING, "
        "processed_at TIMESTAMP"
    ),
    defaults=NOW,
)
FOODS = TableSpec(
    name="flat_foods",
    ddl=(
        "food_name STRING, manufacturer STRING, serving_size STRING, calories_total INT, "
        "calories_fat INT, total_fat STRING, saturated_fat STRING, cholesterol STRING, "
        "sodium STRING, carb STRING, fiber STRING, protein STRING, vitamin_a STRING, "
        "vitamin_c STRING, calcium STRING, iron STRING, processed_at TIMESTAMP"
    ),
    defaults=NOW,
)


def _store(spark: SparkSession, rows: DataFrame, table: TableSpec, mode: str) -> None:
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    create(spark, table)
    (append if mode == "append" else replace_all)(rows, table)


def load_pets(
    spark: SparkSession, documents: DataFrame, table: TableSpec = PETS, mode: str = "append"
) -> None:
    _store(spark, flatten_pets(documents), table, mode)


def load_foods(
    spark: SparkSession, documents: DataFrame, table: TableSpec = FOODS, mode: str = "append"
) -> None:
    _store(spark, flatten_foods(documents), table, mode)
