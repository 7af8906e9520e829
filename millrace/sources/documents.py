"""Document sources: collections as JSON lines, and JSON or XML text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.position import source_position


def read_collection(
    spark: SparkSession, path: str, schema: StructType, order: str = "_ord"
) -> DataFrame:
    """One collection, bound to the declared fields only (``_id`` is left out)."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return reader.json(path).select("*", source_position().alias(order))


def read_xml_elements(
    spark: SparkSession, path: str, element: str, schema: StructType | str
) -> DataFrame:
    """Every ``element`` in the files, at any depth, as one row."""
    return (
        spark.read.schema(schema)
        .option("rowTag", element)
        .option("ignoreSurroundingSpaces", False)
        .option("mode", "FAILFAST")
        .xml(path)
    )


def json_value(column, schema: str) -> Column:
    return F.from_json(column, schema, {"mode": "FAILFAST"})


def xml_value(column, schema: StructType | str, strict: bool = True) -> Column:
    """Parsed XML text; surrounding spaces kept, malformed text fails unless lenient."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return F.from_xml(column, schema, {"mode": mode, "ignoreSurroundingSpaces": "false"})
