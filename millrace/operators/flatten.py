"""Nested JSON and XML documents to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.text import blank_to_null, json_string_array
from millrace.sources.documents import json_value, xml_value

# Scalars are read as text: numbers and booleans come out spelled as written.
PETS_SCHEMA = (
    "pets ARRAY<STRUCT<name: STRING, species: STRING, birthYear: STRING, "
    "photo: STRING, favFoods: ARRAY<STRING>>>"
)

# Repeated elements are arrays, so that the first one can be taken.
FOOD_FIELDS = (
    "name ARRAY<STRING>, mfr ARRAY<STRING>, "
    "serving ARRAY<STRUCT<_VALUE: STRING, _units: STRING>>, "
    "calories ARRAY<STRUCT<_total: STRING, _fat: STRING>>, "
    "`total-fat` ARRAY<STRING>, `saturated-fat` ARRAY<STRING>, cholesterol ARRAY<STRING>, "
    "sodium ARRAY<STRING>, carb ARRAY<STRING>, fiber ARRAY<STRING>, protein ARRAY<STRING>, "
    "vitamins ARRAY<STRUCT<a: ARRAY<STRING>, c: ARRAY<STRING>>>, "
    "minerals ARRAY<STRUCT<ca: ARRAY<STRING>, fe: ARRAY<STRING>>>"
)

# Target column -> element read as text.
FOOD_TEXT = {
    "food_name": "name",
    "manufacturer": "mfr",
    "serving_size": "serving",
    "total_fat": "total-fat",
    "saturated_fat": "saturated-fat",
    "cholesterol": "cholesterol",
    "sodium": "sodium",
    "carb": "carb",
    "fiber": "fiber",
    "protein": "protein",
}
FOOD_COUNTS = {"calories_total": "_total", "calories_fat": "_fat"}
FOOD_NUTRIENTS = {
    "vitamin_a": ("vitamins", "a"),
    "vitamin_c": ("vitamins", "c"),
    "calcium": ("minerals", "ca"),
    "iron": ("minerals", "fe"),
}
FOOD_COLUMNS = (
    "food_name", "manufacturer", "serving_size", "calories_total", "calories_fat",
    "total_fat", "saturated_fat", "cholesterol", "sodium", "carb", "fiber", "protein",
    "vitamin_a", "vitamin_c", "calcium", "iron",
)


def flatten_pets(documents: DataFrame, column: str = "json_data") -> DataFrame:
    """One row per element of each document's ``pets`` array."""
    pets = documents.select(F.explode(json_value(column, PETS_SCHEMA)["pets"]).alias("pet"))
    year = blank_to_null(F.col("pet.birthYear")).cast("int")  # bad text fails the job
    return pets.select(
        "pet.name",
        "pet.species",
        year.alias("birth_year"),
        "pet.photo",
        json_string_array("pet.favFoods").alias("fav_foods"),
    )


def _gather(lists: Column) -> Column:
    """One array from an array of arrays, skipping missing ones."""
    return F.flatten(F.filter(lists, lambda one: one.isNotNull()))


def first_text(elements: Column) -> Column:
    """First non-empty text of a repeated element."""
    return F.get(F.filter(elements, lambda e: e != F.lit("")), F.lit(0))


def flat_foods(foods: DataFrame, food: str | None = None, strict: bool = True) -> DataFrame:
    """Food elements (columns as in ``FOOD_FIELDS``) to the flat layout."""
    columns = _direct_columns(lambda name: F.col(f"{food}.`{name}`" if food else f"`{name}`"), strict)
    return foods.select(*[columns[c].alias(c) for c in FOOD_COLUMNS])


def _whole(text: Column, strict: bool) -> Column:
    text = blank_to_null(text)
    return text.cast("int") if strict else text.try_cast("int")


def _direct_columns(field, strict: bool) -> dict[str, Column]:
    """Flat columns from fields that stand directly in the food element."""
    columns = {}
    for target, name in FOOD_TEXT.items():
        elements = field(name)
        columns[target] = first_text(elements["_VALUE"] if name == "serving" else elements)
    for target, attribute in FOOD_COUNTS.items():
        # The first attribute that exists, even when it is empty.
        present = F.filter(field("calories")[attribute], lambda a: a.isNotNull())
        columns[target] = _whole(F.get(present, F.lit(0)), strict)
    for target, (group, name) in FOOD_NUTRIENTS.items():
        columns[target] = F.coalesce(first_text(_gather(field(group)[name])), F.lit("0"))
    return columns


def _deep_columns(xml: Column, strict: bool) -> dict[str, Column]:
    """Flat columns from fields at any depth of a food element, by XPath."""

    def found(path: str) -> Column:
        return F.xpath(xml, F.lit(path))

    columns = {t: first_text(found(f"//{name}/text()")) for t, name in FOOD_TEXT.items()}
    for target, attribute in FOOD_COUNTS.items():
        value = F.get(found(f"//calories/@{attribute.removeprefix('_')}"), F.lit(0))
        columns[target] = _whole(value, strict)
    for target, (group, name) in FOOD_NUTRIENTS.items():
        columns[target] = F.coalesce(first_text(found(f"//{group}/{name}/text()")), F.lit("0"))
    return columns


# A food element with its content, the start of a food, and the start of an element that is a field.
_FOOD = r"(?s)<food(?:\s[^>]*)?(?:/>|(?<!/)>.*?</food\s*>)"
_FOOD_START = r"<food(?=[\s/>])"
_NAMES = [*FOOD_TEXT.values(), "calories", "vitamins", "minerals"]
_FIELD = rf"<(?:{'|'.join(_NAMES)})(?=[\s/>])"
_FIELD_ELEMENT = rf"(?s)<({'|'.join(_NAMES)})(?=[\s/>])[^>]*?(?:/>|(?<!/)>.*?</\1\s*>)"
# What an XML text is made of: tags of foods, and all between two of them as one piece
# (comments, character data, other tags, text).
_TOKEN = r"(?s)(?:<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(?!/?food[\s/>])[^>]*>|[^<]+)++|<[^>]*>"


def _nested_foods(documents: DataFrame, text: str, strict: bool) -> DataFrame:
    """The text of every food element, also of foods in foods, by a scan of tags with a running depth.

    A start and the next end on its level make an element. Tags of a document are
    rows, told apart by a digest of the document; equal documents are scanned once.
    """
    whole = documents.groupBy(F.md5(text).alias("doc")).agg(
        F.first(text).alias("text"), F.count(F.lit(1)).alias("copies")
    )
    if strict:  # a malformed text fails here
        whole = whole.where(F.xpath_int("text", F.lit("count(//food)")) >= 0)

    def kind(token: Column) -> Column:
        return (
            F.when(token.rlike(r"^<food[\s/>]"), F.when(token.endswith("/>"), F.lit("whole")).otherwise("start"))
            .when(token.rlike(r"^</food[\s>]"), F.lit("end"))
            .otherwise("")
        )

    pieces = F.transform(
        F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0)),
        lambda t: F.struct(kind(t).alias("kind"), F.char_length(t).alias("length")),
    )
    tokens = whole.select("doc", F.posexplode(pieces).alias("place", "token")).select("doc", "place", "token.*")
    so_far = Window.partitionBy("doc").orderBy("place")
    step = F.when(F.col("kind") == "start", 1).when(F.col("kind") == "end", -1).otherwise(0)
    tags = tokens.select(
        "*", F.sum("length").over(so_far).alias("until"), F.sum(step).over(so_far).alias("depth")
    ).where("kind <> ''")
    level = F.col("depth") + F.when(F.col("kind") == "start", 0).otherwise(1)
    on_level = Window.partitionBy("doc", "level").orderBy("place")
    closed = tags.withColumn("level", level).select(
        "*", F.lead("kind").over(on_level).alias("then"), F.lead("until").over(on_level).alias("closed")
    )
    elements = closed.where("kind = 'whole' OR kind = 'start' AND then = 'end'").select(
        "doc",
        (F.col("until") - F.col("length") + 1).cast("int").alias("first"),
        F.when(F.col("kind") == "whole", F.col("until")).otherwise(F.col("closed")).cast("int").alias("last"),
    )
    cut = F.col("text").substr(F.col("first"), F.col("last") - F.col("first") + 1)
    found = elements.join(whole, "doc").select(cut.alias("food_xml"), "copies")
    return found.select(F.explode(F.array_repeat("food_xml", F.col("copies").cast("int"))).alias("food_xml"))


def food_elements(
    documents: DataFrame, column: str = "xml_data", strict: bool = True
) -> DataFrame:
    """One row per ``food`` element of each XML document, at any depth, foods in foods too: ``food_xml``.

    One pattern cuts the foods of ordinary documents. Documents with foods in foods,
    comments or character data are scanned tag by tag. Documents whose tags do not pair
    up fail, unless ``strict`` is off. Documents are dealt over tasks first: a few MB of
    stored columns, read by one task, can be a great many texts.
    """
    rows = documents.select(F.col(column).cast("string").alias("text")).where("text IS NOT NULL").hint("rebalance")
    foods = F.regexp_extract_all("text", F.lit(_FOOD), F.lit(0))
    plain = (F.regexp_count("text", F.lit(_FOOD_START)) == F.size(foods)) & ~F.contains("text", F.lit("<!"))
    cut = foods
    if strict:
        ends = F.regexp_count("text", F.lit("</|/>"))
        unpaired = F.regexp_count("text", F.lit("<[A-Za-z_:]")) != ends
        message = F.lit(f"{column}: start and end tags do not pair up")
        cut = F.when(unpaired, F.raise_error(message).cast("array<string>")).otherwise(foods)
    # Explodes, since filters would be moved before the dealing, to the few tasks of the scan.
    ordinary = rows.select(F.explode(F.when(plain, cut)).alias("food_xml"))
    others = rows.select(F.explode(F.when(~plain, F.array("text"))).alias("text"))
    return ordinary.unionByName(_nested_foods(others, "text", strict))


def flatten_foods(documents: DataFrame, column: str = "xml_data", strict: bool = True) -> DataFrame:
    """Flat rows of the food elements in a text column of XML documents.

    Foods and their fields are found at any depth. A food whose fields all stand
    directly in it is parsed once. Else the fields are cut out and parsed side by side;
    only fields within fields, comments and character data are left to XPath, field by
    field.

    For files use ``read_xml_elements(..., "food", FOOD_FIELDS)`` and ``flat_foods``.
    """
    schema = StructType.fromDDL(FOOD_FIELDS)

    def direct(food: str) -> Column:
        sizes = [F.coalesce(F.size(F.col(f"{food}.`{f.name}`")), F.lit(0)) for f in schema.fields]
        return sum((F.greatest(s, F.lit(0)) for s in sizes), F.lit(0))

    foods = food_elements(documents, column, strict).select(
        "food_xml",
        xml_value("food_xml", schema, strict).alias("food"),
        F.regexp_count("food_xml", F.lit(_FIELD)).alias("fields"),
    )
    foods = foods.select("*", (F.col("fields") == direct("food")).alias("plain"))
    cut = F.regexp_extract_all("food_xml", F.lit(_FIELD_ELEMENT), F.lit(0))
    beside = F.concat(F.lit("<food>"), F.array_join(cut, ""), F.lit("</food>"))
    lifted = F.when(~F.col("plain") & ~F.contains("food_xml", F.lit("<!")), xml_value(beside, schema, strict))
    foods = foods.select("*", lifted.alias("lifted"))
    one = _direct_columns(lambda name: F.col(f"food.`{name}`"), strict)
    two = _direct_columns(lambda name: F.col(f"lifted.`{name}`"), strict)
    three = _deep_columns(F.col("food_xml"), strict)
    whole = F.col("lifted").isNotNull() & (F.col("fields") == direct("lifted"))
    return foods.select(
        *[
            F.when(F.col("plain"), one[c]).when(whole, two[c]).otherwise(three[c]).alias(c)
            for c in FOOD_COLUMNS
        ]
    )
