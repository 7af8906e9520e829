"""The test tables seen as the inputs the operators expect.

Every adaptation works row by row on a whole table: a reading, a session, a
ticket or a document is one row of a source table, so nothing is collected per
group to build an input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from millrace.session import pin_semantics, shared_dir
from millrace.sources.tables import scan

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(pin_semantics(spark), folder, name)


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text and decimals as doubles, so that both engines
    hand back identical values."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            value = value.cast("string")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            value = F.date_format(value, TIME_TEXT)
        elif isinstance(f.dataType, DecimalType):
            value = value.cast("double")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def scratch_database(spark: SparkSession) -> str:
    """A new database in the shared folder, for queries that load tables."""
    name = f"millrace_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, name)}'")
    return name


def props_key() -> Column:
    """The number inside ``props``, a JSON text like ``{"k": 7}``."""
    return F.get_json_object("props", "$.k").cast("bigint")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as temperature readings."""
    return table(spark, folder, "events").select(
        F.col("ts").alias("noted_date"),
        F.col("value").alias("temp"),
        F.col("event_type").alias("out/in"),
        F.col("user_id"),
        F.col("event_id"),
    )


def text_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as a sensor file has them: messy headers, all text, some bad cells."""
    k = props_key()
    return table(spark, folder, "events").select(
        F.concat(F.lit("__export__.temp_log_"), F.col("event_id").cast("string"), F.lit("_"),
                 F.col("user_id").cast("string")).alias("ID"),
        F.lit("Room Admin").alias("Room_ID/ID"),
        F.when(k == 97, F.lit("not a date"))
        .otherwise(F.date_format("ts", "MM-dd-yyyy HH:mm")).alias(" Noted Date "),
        F.when(k == 89, F.lit("x")).otherwise(F.col("value").cast("string")).alias("Temp"),
        F.when(F.col("event_type") == "view", F.lit(" In "))
        .when(F.col("event_type") == "error", F.lit(None))
        .otherwise(F.lit("Out")).alias("Out/In"),
    )


def keyed_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Loadable readings with canonical names, no id for sign-ups, and a row position."""
    user = F.concat(F.lit("log_"), F.col("user_id").cast("string"))
    place = F.concat(F.lit(" "), F.col("event_type"), F.lit("_sensor"))
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") != "signup", user).alias("id"),
        F.when(props_key() < 50, F.lit("Room Admin")).alias("room_id_id"),
        F.date_format(F.date_trunc("HOUR", "ts"), "MM-dd-yyyy HH:mm").alias("noted_date"),
        F.col("value").cast("string").alias("temp"),
        F.when(F.col("event_type") != "error", place).alias("out_in"),
        F.col("event_id").alias("_row"),
    )


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as user sessions: ``value`` seconds long, pages and actions from the key.

    Pages are missing for errors and empty for a quarter of the rest.
    """
    k = F.col("k")
    pages = F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), (k % 4).cast("int")),
                    lambda i: F.concat(F.lit("/p"), ((k * i) % 7).cast("string")))
    )
    actions = F.transform(F.sequence(F.lit(1), (k % 3).cast("int") + 1),
                          lambda i: F.concat(F.col("event_type"), i.cast("string")))
    return (
        table(spark, folder, "events")
        .withColumn("k", props_key())
        .select(
            "event_id",
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
            F.col("ts").alias("start_time"),
            F.floor("value").cast("int").alias("session_duration_seconds"),
            F.when(F.col("event_type") != "error", pages).alias("pages_visited"),
            F.when(F.col("event_type") != "signup", actions).alias("actions"),
            F.col("event_type"),
        )
    )


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as support tickets, resolved at the last ship date of a finished order."""
    shipped = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("updated_at"))
    )
    status = F.when(F.col("o_orderstatus") == "F", "resolved").when(
        F.col("o_orderstatus") == "P", "in_progress"
    ).otherwise("open")
    seconds = F.timestamp_diff("SECOND", F.col("o_orderdate"), F.col("updated_at"))
    return (
        table(spark, folder, "orders")
        .join(shipped, "o_orderkey", "left")
        .select(
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderpriority").alias("issue_type"),
            status.alias("status"),
            F.when(status == "resolved", seconds).alias("resolution_time_seconds"),
        )
    )


def _iso(column, zone: str = "+00:00") -> Column:
    return F.concat(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(zone))


def session_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Session documents; three events share a session id, the lowest event is first."""
    rows = sessions(spark, folder)
    end = F.col("start_time") + F.make_dt_interval(secs=F.col("session_duration_seconds"))
    return rows.select(
        F.concat(F.lit("sess_"), F.floor(F.col("event_id") / 3).cast("string")).alias("session_id"),
        "user_id",
        _iso("start_time", "+02:00").alias("start_time"),
        _iso(end, "+02:00").alias("end_time"),
        "pages_visited",
        F.struct(
            F.col("event_type").alias("type"),
            F.lit("Linux").alias("os"),
            F.lit(None).cast("string").alias("browser"),
        ).alias("device"),
        "actions",
        F.col("event_id").alias("_ord"),
    )


def event_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("evt_"), F.floor(F.col("event_id") / 2).cast("string")).alias("event_id"),
        _iso("ts", "-03:30").alias("timestamp"),
        "event_type",
        F.col("props").alias("details"),
        F.col("event_id").alias("_ord"),
    )


def ticket_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as ticket documents, updated as many seconds later as they cost."""
    key = F.col("o_orderkey")
    updated = F.col("o_orderdate") + F.make_dt_interval(secs=F.floor("o_totalprice"))
    message = F.transform(
        F.sequence(F.lit(1), (key % 3).cast("int") + 1),
        lambda i: F.struct(
            F.when(i % 2 == 1, "user").otherwise("support").alias("sender"),
            F.concat(F.lit("message "), i.cast("string")).alias("message"),
            _iso("o_orderdate").alias("timestamp"),
        ),
    )
    status = F.when(F.col("o_orderstatus") == "F", F.when(key % 2 == 0, "resolved").otherwise("closed"))
    return table(spark, folder, "orders").select(
        F.concat(F.lit("ticket_"), F.floor(key / 2).cast("string")).alias("ticket_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        status.when(F.col("o_orderstatus") == "P", "in_progress").otherwise("open").alias("status"),
        F.col("o_orderpriority").alias("issue_type"),
        F.when(key % 5 != 0, message).alias("messages"),
        _iso("o_orderdate").alias("created_at"),
        _iso(updated).alias("updated_at"),
        key.alias("_ord"),
    )


def recommendation_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as recommendation documents, the earliest order of a customer first."""
    key = F.col("o_orderkey")
    products = F.transform(
        F.sequence(F.lit(1), (key % 4).cast("int") + 1),
        lambda i: F.concat(F.lit("prod_"), ((key * i) % 500).cast("string")),
    )
    return table(spark, folder, "orders").select(
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        products.alias("recommended_products"),
        _iso("o_orderdate").alias("last_updated"),
        F.struct("o_orderdate", "o_orderkey").alias("_ord"),
    )


def review_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews, moderated by their labels. Pairs share a review id."""
    labels = table(spark, folder, "labels")
    submitted = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=F.col("doc_id")
    )
    status = F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected")
    return (
        table(spark, folder, "documents")
        .join(labels, "doc_id", "left")
        .select(
            F.concat(F.lit("rev_"), F.floor(F.col("doc_id") / 2).cast("string")).alias("review_id"),
            F.col("source").alias("user_id"),
            F.col("lang").alias("product_id"),
            F.col("text").alias("review_text"),
            (F.col("n_chars") % 5 + 1).cast("int").alias("rating"),
            status.otherwise("pending").alias("moderation_status"),
            F.when(F.col("toxic") == 1, F.array(F.lit("toxicity_suspected")))
            .otherwise(F.array().cast("array<string>"))
            .alias("flags"),
            _iso(submitted).alias("submitted_at"),
            F.col("doc_id").alias("_ord"),
        )
    )


COLLECTION_DOCUMENTS = {
    "UserSessions": session_documents,
    "EventLogs": event_documents,
    "SupportTickets": ticket_documents,
    "UserRecommendations": recommendation_documents,
    "ModerationQueue": review_documents,
}


def pet_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON texts: errors hold no pets, purchases two, the others one."""
    k = props_key()

    def pet(name: Column) -> Column:
        return F.struct(
            name.alias("name"),
            F.col("event_type").alias("species"),
            F.when(k % 4 != 0, F.transform(
                F.sequence(F.lit(1), (k % 4).cast("int")),
                lambda i: F.concat(F.lit('<b>"é'), i.cast("string"), F.lit("\\</b>")))
            ).alias("favFoods"),
            F.when(k % 3 != 0, k + 1900).alias("birthYear"),
            F.concat(F.lit("https://example.org/"), F.col("event_id").cast("string")).alias("photo"),
        )

    first = pet(F.concat(F.lit("a"), F.col("event_id").cast("string")))
    second = pet(F.concat(F.lit("b"), F.col("event_id").cast("string")))
    pets = F.when(F.col("event_type") == "purchase", F.array(first, second)).when(
        F.col("event_type") != "error", F.array(first)
    )
    return table(spark, folder, "events").select(F.to_json(F.struct(pets.alias("pets"))).alias("json_data"))


def food_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as XML texts with one or two foods and a block that is no food."""
    def text(column: Column) -> Column:
        for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            column = F.replace(column, F.lit(raw), F.lit(entity))
        return column

    key = F.col("p_partkey")
    food = F.concat(
        F.lit("<food><name>"), text(F.col("p_name")), F.lit(" </name><mfr>"),
        F.when(key % 3 != 0, text(F.col("p_brand"))).otherwise(""),
        F.lit('</mfr><serving units="g">'), F.col("p_size").cast("string"),
        F.lit('</serving><calories total="'), (key % 700).cast("string"),
        F.lit('" fat="'), F.when(key % 2 == 0, (key % 90).cast("string")).otherwise(""),
        F.lit('"/><total-fat>'), F.col("p_retailprice").cast("string"),
        F.lit("</total-fat><saturated-fat>1</saturated-fat><cholesterol>5</cholesterol>"
              "<sodium>210</sodium><carb>2</carb><fiber>0</fiber><protein>1</protein>"),
        F.when(key % 4 != 0, F.concat(F.lit("<vitamins><a>"), (key % 50).cast("string"),
                                      F.lit("</a></vitamins>"))).otherwise(""),
        F.lit("<minerals><ca>8</ca><fe>"), (key % 11).cast("string"), F.lit("</fe></minerals></food>"),
    )
    extra = F.when(key % 5 == 0, F.lit("<food><name>extra</name><name>ignored</name></food>"))
    return table(spark, folder, "part").select(
        F.concat(
            F.lit("<nutrition><daily-values><carb>300</carb></daily-values>"),
            food,
            F.coalesce(extra, F.lit("")),
            F.lit("</nutrition>"),
        ).alias("xml_data")
    )
