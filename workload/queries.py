"""Every registered query: an operator or job on whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.coerce import length_or_zero, null_if_nan
from millrace.functions.headers import apply_aliases, canonical_for_load, standardise
from millrace.functions.identity import device_id_full, device_id_incremental, location
from millrace.functions.text import error_text, fixed_decimals, json_document, json_string_array
from millrace.operators import marts
from millrace.operators.dedupe import (
    duplicate_key_count,
    duplicate_keys,
    keep_first,
    keep_last,
)
from millrace.operators.flatten import (
    FOOD_FIELDS,
    flat_foods,
    flatten_foods,
    flatten_pets,
    food_elements,
)
from millrace.operators.merge import insert_ignore, known_keys, new_keys, upsert
from millrace.operators.profile import first_rows, load_quality, null_profile
from millrace.operators.quantiles import between, percentile_trim, quantiles, trim_report
from millrace.operators.ranking import extremes_of_type, temperature_extremes, top_days
from millrace.operators.recent import last_n_days
from millrace.operators.sampling import seeded_sample
from millrace.operators.summaries import (
    batch_days,
    batch_stats,
    daily_mean,
    daily_summary,
    date_range,
    day_span,
    first_seen_values,
    load_stats,
    table_stats,
)
from millrace.plans import flattening, loads, replication, temperature
from millrace.plans import marts as mart_plans
from millrace.session import materialize, shared_dir
from millrace.sinks import history as log
from millrace.sinks import tables as tb
from millrace.sinks.rejects import REJECTS
from millrace.sinks.reports import summary_lines
from millrace.sources.delimited import read_delimited, write_delimited
from millrace.sources.documents import read_xml_elements, xml_value
from millrace.sources.tables import existing_tables
from millrace.streaming.replicate import replicate_new
from workload import inputs
from workload.inputs import portable, rounded, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SPLIT_DAY = dt.date(2024, 1, 15)
TARGET_END = dt.date(2024, 1, 21)
FOODS_PER_FILE = 100_000  # about 50 MB
DOCUMENTS_PER_FILE = 500_000  # of a compressed file, which one task reads


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- readings: coercion, filters, statistics -------------------------------------


@query
def daily_temperature_summary(spark, folder):
    daily = daily_summary(inputs.readings(spark, folder))
    return portable(rounded(daily, "avg_temp"))


def _inside(spark, folder):
    rows = inputs.readings(spark, folder)
    rows = rows.withColumn("out/in", F.when(F.col("`out/in`") == "view", " In ").otherwise("Out"))
    return temperature.inside_readings(rows)


@query
def percentile_trim_daily(spark, folder):
    trimmed = percentile_trim(_inside(spark, folder))
    daily = daily_mean(trimmed.withColumn("noted_date", F.to_date("noted_date")))
    return portable(rounded(daily, "temp"))


@query
def percentile_trim_report(spark, folder):
    rows = _inside(spark, folder)
    report = trim_report(rows, quantiles(rows, "temp", temperature.TRIM))
    return rounded(report, "lower_percentile", "upper_percentile")


@query
def temperature_extreme_days(spark, folder):
    extremes = temperature_extremes(daily_summary(inputs.readings(spark, folder)))
    return portable(rounded(extremes, "temperature"))


@query
def hottest_days(spark, folder):
    rows = inputs.readings(spark, folder).withColumn("noted_date", F.to_date("noted_date"))
    return portable(rounded(top_days(daily_mean(rows)), "temp"))


@query
def coldest_days(spark, folder):
    rows = inputs.readings(spark, folder).withColumn("noted_date", F.to_date("noted_date"))
    return portable(rounded(top_days(daily_mean(rows), hottest=False), "temp"))


@query
def cold_days_report(spark, folder):
    extremes = temperature_extremes(daily_summary(inputs.readings(spark, folder)))
    return portable(rounded(extremes_of_type(extremes, "cold"), "temperature"))


@query
def text_summary_report(spark, folder):
    rows = _inside(spark, folder).withColumn("noted_date", F.to_date("noted_date"))
    bounds = quantiles(rows, "temp", temperature.TRIM)
    return summary_lines(trim_report(rows, bounds), daily_mean(between(rows, "temp", bounds)))


@query
def temperature_stats(spark, folder):
    stats = table_stats(inputs.readings(spark, folder))
    return portable(rounded(stats, "avg_temp"))


@query
def temperature_load_stats(spark, folder):
    stats = load_stats(inputs.readings(spark, folder), device="user_id", value="temp")
    return portable(rounded(stats, "avg_temperature"))


@query
def reading_date_range(spark, folder):
    return portable(date_range(inputs.readings(spark, folder)))


@query
def formatted_stats(spark, folder):
    stats = table_stats(inputs.readings(spark, folder))
    return stats.select(
        fixed_decimals("avg_temp", 1).alias("avg_1"),
        fixed_decimals("avg_temp", 2).alias("avg_2"),
        fixed_decimals("min_temp", 2).alias("min_2"),
        fixed_decimals("max_temp", 2).alias("max_2"),
    )


@query
def last_n_days_rows(spark, folder):
    return portable(last_n_days(inputs.readings(spark, folder), 7).drop("out/in"))


@query
def last_n_days_capped(spark, folder):
    """A wider request under the preparation step's seven days: rows per day."""
    rows = last_n_days(inputs.readings(spark, folder), 30, cap_days=loads.PREPARED_DAYS)
    return portable(batch_days(rows, newest=30))


@query
def batch_rows_per_day(spark, folder):
    return portable(batch_days(inputs.readings(spark, folder), newest=5))


@query
def batch_temperature_stats(spark, folder):
    rows = inputs.readings(spark, folder).withColumnRenamed("temp", "temperature")
    rows = rows.withColumn("batch_id", F.concat(F.lit("inc_"), F.to_date("noted_date").cast("string")))
    return rounded(batch_stats(rows, "inc_2024-01-10"), "avg_temp")


@query
def batch_day_span(spark, folder):
    return portable(day_span(last_n_days(inputs.readings(spark, folder), 7)))


@query
def first_distinct_values(spark, folder):
    return first_seen_values(table(spark, folder, "orders"), "o_custkey", "o_orderkey")


@query
def null_column_profile(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    return null_profile(rows).drop("data_type")


@query
def column_types(spark, folder):
    """Name, type, rows and missing values of each column of the orders."""
    return null_profile(table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"))


@query
def first_rows_by_key(spark, folder):
    return first_rows(table(spark, folder, "customer").select("c_custkey", "c_name").orderBy("c_custkey"), 7)


@query
def standardised_headers(spark, folder):
    """Lowercased, cleaned names, seen through the columns they label."""
    rows = table(spark, folder, "region").withColumnsRenamed(
        {"r_regionkey": " Region Key ", "r_name": "Name/Text"}
    )
    return standardise(rows, slash=True)


@query
def loose_headers_and_aliases(spark, folder):
    """Location by any column with ``in``, and fallback names where the wanted one is missing."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").alias("event_date"), F.col("event_type").alias("inside")
    )
    loose = canonical_for_load(events, loose=True)
    return portable(apply_aliases(loose, {"event_id": "id", "inside": "out_in"}))


@query
def nan_values_as_null(spark, folder):
    events = table(spark, folder, "events")
    value = F.when(F.col("event_id") % 3 == 0, F.lit("NaN").cast("double")).otherwise(F.col("value"))
    return events.select("event_id", null_if_nan(value).alias("value"))


@query
def shortened_error_texts(spark, folder):
    text = F.repeat(F.coalesce(F.col("props"), F.lit("")), 60)
    return table(spark, folder, "events").select("event_id", error_text(text).alias("error_message"))


@query
def stamped_and_keyed_rows(spark, folder):
    """Rows of a table that fills in load times and checks its key, and whether the catalog knows it."""
    database = inputs.scratch_database(spark)
    spec = tb.TableSpec(
        name=f"{database}.stamped",
        ddl="event_id BIGINT, user_id BIGINT, load_timestamp TIMESTAMP",
        key=("event_id",), defaults=loads.LOADED_NOW,
    )
    tb.create(spark, spec)
    tb.replace_all(table(spark, folder, "events").select("event_id", "user_id"), spec)
    known = existing_tables(spark, [spec.name, f"{database}.missing"])
    return tb.read(spark, spec).groupBy(F.pmod("user_id", F.lit(10)).alias("user_group")).agg(
        F.count("*").alias("rows"),
        F.count("load_timestamp").alias("stamped"),
        F.lit(len(known)).alias("known_tables"),
    )


# --- labels --------------------------------------------------------------------


@query
def device_ids_full(spark, folder):
    rows = inputs.keyed_readings(spark, folder)
    label = device_id_full("id", "room_id_id", "_row")
    return rows.select(F.col("_row").alias("event_id"), label.alias("device_id"))


@query
def device_ids_incremental(spark, folder):
    rows = inputs.keyed_readings(spark, folder)
    return rows.select(F.col("_row").alias("event_id"), device_id_incremental("id", "_row").alias("device_id"))


@query
def customer_device_ids(spark, folder):
    rows = table(spark, folder, "customer").withColumn("name", F.replace("c_name", F.lit("#"), F.lit("_")))
    return rows.select(
        "c_custkey",
        device_id_full("name", None, "c_custkey").alias("full_id"),
        device_id_incremental("name", "c_custkey").alias("incremental_id"),
    )


@query
def locations(spark, folder):
    rows = inputs.keyed_readings(spark, folder)
    return rows.select(F.col("_row").alias("event_id"), location("out_in").alias("location"))


# --- keys ----------------------------------------------------------------------


@query
def keep_first_event(spark, folder):
    return portable(keep_first(table(spark, folder, "events"), "user_id", "event_id"))


@query
def keep_last_event(spark, folder):
    rows = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    return portable(keep_last(rows, ("day", "user_id"), "event_id"))


@query
def duplicate_line_keys(spark, folder):
    return duplicate_keys(table(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber"))


@query
def duplicate_line_key_count(spark, folder):
    return duplicate_key_count(table(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber"))


@query
def load_quality_check(spark, folder):
    rows = inputs.readings(spark, folder).withColumn("device_id", F.col("user_id"))
    rows = rows.withColumn("noted_date", F.date_trunc("HOUR", "noted_date"))
    return load_quality(rows)


def _merge_sides(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    target = events.where(F.col("ts") < F.lit(TARGET_END).cast("timestamp_ntz"))
    source = events.where(F.col("ts") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))
    return target, source.withColumn("value", F.col("value") + 1)


@query
def upsert_events(spark, folder):
    target, source = _merge_sides(spark, folder)
    return portable(rounded(upsert(target, source, ["event_id"]), "value"))


@query
def upsert_events_keeping_columns(spark, folder):
    """Known rows take the new value but keep their own user."""
    target, source = _merge_sides(spark, folder)
    source = source.withColumn("user_id", -F.col("user_id"))
    merged = upsert(target, source, ["event_id"], keep=["user_id"])
    return portable(rounded(merged, "value"))


@query
def insert_ignore_events(spark, folder):
    target, source = _merge_sides(spark, folder)
    return portable(rounded(insert_ignore(target, source, ["event_id"]), "value"))


@query
def key_probe(spark, folder):
    """How many source rows would be updates, and how many inserts."""
    target, source = _merge_sides(spark, folder)
    known = known_keys(source, target, ["event_id"]).select(F.lit("update").alias("action"))
    added = new_keys(source, target, ["event_id"]).select(F.lit("insert").alias("action"))
    return known.unionByName(added).groupBy("action").agg(F.count("*").alias("records"))


@query
def seeded_event_sample(spark, folder):
    return portable(seeded_sample(table(spark, folder, "events"), 1000, 42, ["event_id"]))


# --- marts ---------------------------------------------------------------------


@query
def user_activity_mart(spark, folder):
    return portable(marts.user_activity(inputs.sessions(spark, folder)))


@query
def user_activity_mart_day(spark, folder):
    day = dt.date(2024, 1, 10)
    return portable(marts.user_activity(inputs.sessions(spark, folder), day))


@query
def user_activity_by_session(spark, folder):
    return portable(marts.user_activity(inputs.sessions(spark, folder), grain="session"))


@query
def support_efficiency_mart(spark, folder):
    run_date = dt.date(1999, 6, 30)
    return portable(marts.support_efficiency(inputs.tickets(spark, folder), run_date))


@query
def ticket_message_count(spark, folder):
    """Turns as tickets; the sentences of a turn are its messages."""
    sentences = F.when(F.col("role") != "system", F.split("text", r"\. "))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", "role", length_or_zero(sentences).alias("messages_count")
    )


# --- nested documents ------------------------------------------------------------


@query
def flatten_json(spark, folder):
    return flatten_pets(inputs.pet_documents(spark, folder))


@query
def flatten_xml(spark, folder):
    return flatten_foods(inputs.food_documents(spark, folder))


@query
def flatten_xml_files(spark, folder):
    """The same foods written as XML files and read back element by element."""
    path = shared_dir(spark, "foods-xml")
    foods = food_elements(inputs.food_documents(spark, folder))
    # A file is read by one task.
    writer = foods.select(xml_value("food_xml", FOOD_FIELDS).alias("food")).select("food.*").write
    writer = writer.option("maxRecordsPerFile", FOODS_PER_FILE)
    writer.option("rootTag", "nutrition").option("rowTag", "food").xml(path)
    return flat_foods(read_xml_elements(spark, path, "food", FOOD_FIELDS))


@query
def flatten_xml_nested(spark, folder):
    """The same foods one level deeper in every second document, with names inside a further element."""
    documents = inputs.food_documents(spark, folder)
    text = F.col("xml_data")
    deeper = F.regexp_replace(text, r"(?s)(<food.*</food>)", "<group><part>$1</part></group>")
    inside = F.regexp_replace(deeper, r"<name>(.*?)</name>", "<label><name>$1</name></label>")
    even = F.pmod(F.xxhash64(text), F.lit(2)) == 0
    return flatten_foods(documents.withColumn("xml_data", F.when(even, inside).otherwise(text)))


@query
def foods_in_foods_loaded(spark, folder):
    """Foods with a food deep inside them, appended to the flat table."""
    spec = flattening.FOODS.in_database(inputs.scratch_database(spark))
    inner = "</minerals><group><food><name>inner</name></food></group></food>"
    text = F.replace("xml_data", F.lit("</minerals></food>"), F.lit(inner))
    flattening.load_foods(spark, inputs.food_documents(spark, folder).withColumn("xml_data", text), spec)
    return tb.read(spark, spec).drop("processed_at")


@query
def json_text_columns(spark, folder):
    rows = inputs.sessions(spark, folder)
    device = F.struct(F.col("event_type").alias("type"), F.lit(None).cast("string").alias("os"))
    return rows.select(
        "event_id",
        json_string_array("pages_visited").alias("pages_json"),
        json_document(device).alias("device_json"),
    )


# --- replication -----------------------------------------------------------------


def _nested_as_text(df, *names):
    return df.withColumns({n: json_document(F.col(n)) for n in names})


@query
def replicate_user_sessions(spark, folder):
    rows = replication.transform(inputs.session_documents(spark, folder), replication.SESSIONS)
    rows = replication.typed(rows, replication.SESSIONS)
    return portable(_nested_as_text(rows, "pages_visited", "device", "actions"))


@query
def replicate_event_logs(spark, folder):
    return portable(replication.transform(inputs.event_documents(spark, folder), replication.EVENTS))


@query
def replicate_support_tickets(spark, folder):
    rows = replication.transform(inputs.ticket_documents(spark, folder), replication.TICKETS)
    rows = replication.typed(rows, replication.TICKETS)
    rows = rows.withColumn("resolution_time_seconds", F.col("resolution_time_seconds").cast("double"))
    return portable(_nested_as_text(rows, "messages"))


@query
def replicate_user_recommendations(spark, folder):
    documents = inputs.recommendation_documents(spark, folder)
    rows = replication.transform(documents, replication.RECOMMENDATIONS)
    return portable(_nested_as_text(rows, "recommended_products"))


@query
def replicate_moderation_queue(spark, folder):
    rows = replication.transform(inputs.review_documents(spark, folder), replication.MODERATION)
    rows = rows.withColumn("review_text", F.md5("review_text"))
    return portable(_nested_as_text(rows, "flags"))


@query
def replicate_streamed_files(spark, folder):
    """Documents of one key in different files, taken up one file at a time."""
    database, root = inputs.scratch_database(spark), shared_dir(spark, "collections")
    collection = replication.EVENTS
    documents = inputs.event_documents(spark, folder).withColumn(
        "_later", F.row_number().over(Window.partitionBy("event_id").orderBy("_ord"))
    )
    ordered = documents.repartitionByRange(6, "_later", "_ord").sortWithinPartitions("_later", "_ord")
    ordered.drop("_ord", "_later").write.json(f"{root}/{collection.name}")
    spec = collection.table.in_database(database)
    replicate_new(spark, root, collection, f"{root}/position", spec, max_files=1).awaitTermination()
    return portable(tb.read(spark, spec).drop("created_at", "updated_at"))


@query
def replicated_collections_upserted(spark, folder):
    """All collections loaded twice: rows, and how many kept ``created_at`` and moved ``updated_at``."""
    database = inputs.scratch_database(spark)

    def loaded_twice(session, collection):
        """The folder with key and times of each row after the first load."""
        documents = inputs.COLLECTION_DOCUMENTS[collection.name](session, folder)
        spec = collection.table.in_database(database)
        replication.replicate_documents(session, documents, collection, spec)
        path = shared_dir(session, "first-load")
        tb.read(session, spec).select(*spec.key, "created_at", "updated_at").write.parquet(path)
        replication.replicate_documents(session, documents, collection, spec)
        return path

    found = None
    for name, path in replication.at_once(spark, loaded_twice).items():
        collection = replication.COLLECTIONS[name]
        spec = collection.table.in_database(database)
        first = spark.read.parquet(path).withColumnsRenamed({"created_at": "_made", "updated_at": "_changed"})
        state = tb.read(spark, spec).join(first, list(spec.key)).select(
            F.lit(collection.name).alias("collection"),
            (F.col("created_at") == F.col("_made")).alias("kept"),
            (F.col("updated_at") > F.col("_changed")).alias("moved"),
        )
        found = state if found is None else found.unionByName(state)
    return found.groupBy("collection").agg(
        F.count("*").alias("rows"),
        F.count_if("kept").alias("created_kept"),
        F.count_if("moved").alias("updated_moved"),
    )


@query
def replicate_from_json_files(spark, folder):
    """Event documents written as a JSON-lines collection, read back, loaded twice."""
    database, root = inputs.scratch_database(spark), shared_dir(spark, "collections")
    collection = replication.EVENTS
    documents = inputs.event_documents(spark, folder).withColumn("_id", F.col("_ord"))
    # Files in position order, since the first document of a repeated key counts.
    ordered = documents.repartitionByRange("_ord").sortWithinPartitions("_ord").drop("_ord")
    ordered.write.json(f"{root}/{collection.name}")
    spec = collection.table.in_database(database)
    for _ in range(2):
        replication.replicate(spark, root, collection, spec)
    return portable(tb.read(spark, spec).drop("created_at", "updated_at"))


def _open_sessions(spark, folder):
    """Session documents whose devices have fields the collection does not name."""
    k = inputs.props_key()
    events = inputs.table(spark, folder, "events").select("event_id", k.alias("k"))
    screen = F.struct(F.col("k").alias("w"), F.array("k", F.col("k") + 1).alias("sizes"))
    documents = inputs.session_documents(spark, folder).join(events, F.col("_ord") == F.col("event_id"))
    more = F.when(F.col("k") % 2 == 0, screen)
    return documents.withColumn("device", F.col("device").withField("screen", more)).drop("event_id", "k")


@query
def open_documents_replicated(spark, folder):
    """Sessions read as JSON lines and loaded twice: the whole device as text, and a field of it."""
    database, root = inputs.scratch_database(spark), shared_dir(spark, "collections")
    collection = replication.SESSIONS
    ordered = _open_sessions(spark, folder).repartitionByRange("_ord").sortWithinPartitions("_ord")
    ordered.drop("_ord").write.json(f"{root}/{collection.name}")
    spec = collection.table.in_database(database)
    for _ in range(2):
        replication.replicate(spark, root, collection, spec)
    width = F.try_variant_get("device", "$.screen.sizes[1]", "BIGINT").alias("second_size")
    return tb.read(spark, spec).select("session_id", F.to_json("device").alias("device"), width)


@query
def document_shapes(spark, folder):
    """The fields and types that the devices of each type of event have."""
    rows = replication.transform(_open_sessions(spark, folder), replication.SESSIONS)
    kind = F.try_variant_get("device", "$.type", "STRING").alias("event_type")
    return rows.groupBy(kind).agg(F.schema_of_variant_agg("device").alias("shape"))


@query
def upserts_of_small_batches(spark, folder):
    """A load of all event documents, then twenty batches of a hundredth of the keys, each changed."""
    database = inputs.scratch_database(spark)
    collection = replication.EVENTS
    spec = collection.table.in_database(database)
    documents = inputs.event_documents(spark, folder)
    number = F.regexp_extract("event_id", r"\d+$", 0).cast("long") % 200
    replication.replicate_documents(spark, documents, collection, spec)
    for turn in range(20):
        some = documents.where(number.isin(turn, turn + 1))
        some = some.withColumn("event_type", F.concat("event_type", F.lit(f"_{turn}")))
        replication.replicate_documents(spark, some, collection, spec)
    return portable(tb.read(spark, spec).drop("created_at", "updated_at"))


@query
def all_collections_replicated_twice(spark, folder):
    """Five collections at the same time; then a third of their documents again, and copies with new keys."""
    database, root = inputs.scratch_database(spark), shared_dir(spark, "collections")
    found = None
    for turn in ("first", "second"):
        for name, documents in inputs.COLLECTION_DOCUMENTS.items():
            collection, rows = replication.COLLECTIONS[name], documents(spark, folder)
            key = collection.table.key[0]
            if turn == "second":
                third = F.regexp_extract(key, r"\d+$", 0).cast("long") % 3 == 0
                rows = rows.where(third)
                rows = rows.unionByName(rows.withColumn(key, F.concat(key, F.lit("_new"))))
            # Documents repeat their field names: compressed they are a fraction of their size.
            writer = rows.drop("_ord").write.option("compression", "gzip")
            writer.option("maxRecordsPerFile", DOCUMENTS_PER_FILE).json(f"{root}/{turn}/{name}")
        replication.replicate_all(spark, f"{root}/{turn}", database)
    for name, collection in replication.COLLECTIONS.items():
        rows = tb.read(spark, collection.table.in_database(database))
        moved = F.count_if(F.col("updated_at") > F.col("created_at"))
        state = rows.agg(
            F.lit(name).alias("collection"),
            F.count("*").alias("rows"),
            F.count_if(F.col(collection.table.key[0]).endswith("_new")).alias("new_rows"),
            (moved if collection.keep else F.lit(None).cast("bigint")).alias("moved"),
        )
        found = state if found is None else found.unionByName(state)
    return found


# --- loads and tables --------------------------------------------------------------


def _load_specs(spark):
    database = inputs.scratch_database(spark)
    named = [s.in_database(database) for s in (loads.FULL, loads.INCREMENTAL, log.HISTORY)]
    return database, *named


@query
def csv_scan_prepared(spark, folder):
    """Readings written as CSV with messy headers, read back and prepared for a load."""
    path = shared_dir(spark, "readings-csv")
    write_delimited(inputs.text_readings(spark, folder), path)
    prepared = loads.prepare(read_delimited(spark, path))
    return portable(loads.full_records(prepared, "full_1"))


@query
def temperature_processing(spark, folder):
    """The whole processing job from a CSV file: trimmed rows per day and extremes."""
    path = shared_dir(spark, "temperature-csv")
    write_delimited(inputs.text_readings(spark, folder), path)
    database = inputs.scratch_database(spark)
    specs = {k: s.in_database(database) for k, s in temperature.TABLES.items()}
    results = temperature.process(spark, read_delimited(spark, path), tables=specs)
    summary = results["summary"].select(
        "date", F.col("avg_temp").alias("temperature"), F.lit("day").alias("type"), "record_count"
    )
    extremes = results["extremes"].select(
        "date", "temperature", "type", F.col("rank").cast("bigint").alias("record_count")
    )
    return portable(rounded(summary.unionByName(extremes), "temperature"))


@query
def full_load_table(spark, folder):
    """Loaded twice; the second load replaces the first."""
    _, full, _, history = _load_specs(spark)
    rows = inputs.keyed_readings(spark, folder)
    for batch in ("full_1", "full_2"):
        loads.full_load(spark, rows, full, history, batch)
    return portable(tb.read(spark, full).drop("load_timestamp"))


@query
def incremental_load_table(spark, folder):
    """Three days, then seven days with changed values, then the three days again."""
    _, _, table_, history = _load_specs(spark)
    rows = inputs.keyed_readings(spark, folder)
    changed = rows.withColumn("temp", (F.col("temp").cast("double") + 1).cast("string"))
    loads.incremental_load(spark, rows, 3, table_, history, "inc_1")
    loads.incremental_load(spark, changed, 7, table_, history, "inc_2")
    loads.incremental_load(spark, rows, 3, table_, history, "inc_3")
    loaded = tb.read(spark, table_).drop("load_timestamp", "noted_day")
    return portable(rounded(loaded, "temperature"))


@query
def load_history_of_runs(spark, folder):
    """Audit rows left by a full and two incremental loads."""
    _, full, incremental, history = _load_specs(spark)
    rows = inputs.keyed_readings(spark, folder)
    loads.full_load(spark, rows, full, history, "full_1")
    loads.incremental_load(spark, rows, 3, incremental, history, "inc_1")
    loads.incremental_load(spark, rows, 7, incremental, history, "inc_2")
    newest = log.latest_loads(log.batches(spark, history), 3)
    return newest.select("load_type", "batch_id", "records_loaded", "load_status")


RULES = {"temperature below 150": "temperature < 150", "place is known": "location <> 'unknown'"}


def _runs_with_rejects(spark, folder):
    """Loads under rules that refuse some rows, all rows and none."""
    database, _, table_, history = _load_specs(spark)
    rejects = REJECTS.in_database(database)
    rows = inputs.keyed_readings(spark, folder)
    never = {"nothing is taken": "batch_id IS NULL"}
    for batch, rules, days in (("inc_1", RULES, 3), ("inc_2", never, 1), ("inc_3", {}, 3)):
        spec = replace(table_, checks=rules)
        job, run = {"last_n_days": 30}, {"last_n_days": days}
        loads.incremental_load(spark, rows, None, spec, history, batch, run=run, job=job, rejects=rejects)
    return history, rejects


@query
def load_outcomes_of_runs(spark, folder):
    history, _ = _runs_with_rejects(spark, folder)
    return log.batches(spark, history).select("batch_id", "records_loaded", "load_status")


@query
def rejected_readings(spark, folder):
    _, rejects = _runs_with_rejects(spark, folder)
    record = F.from_json("record", "noted_date TIMESTAMP_NTZ, device_id STRING, temperature DOUBLE")
    rows = tb.read(spark, rejects).select("batch_id", "table_name", "reason", record.alias("r"))
    rows = rows.select("batch_id", "table_name", "reason", "r.*")
    return portable(rounded(rows, "temperature"))


def _daily_batches(spark, folder):
    """One batch per day, with a started and a finished state."""
    day = F.to_date("ts")
    batches = table(spark, folder, "events").groupBy(day.alias("day")).agg(
        F.count("*").alias("records_loaded"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )
    base = batches.select(
        F.when(F.day("day") % 2 == 0, "incremental").otherwise("full").alias("load_type"),
        F.concat(F.lit("b_"), F.col("day").cast("string")).alias("batch_id"),
        F.col("day").cast("timestamp").alias("created_at"),
        F.col("day").cast("timestamp").alias("start_date"),
        F.lit(None).cast("timestamp").alias("end_date"),
        F.col("day").cast("timestamp").alias("changed_at"),
        F.lit(None).cast("bigint").alias("records_loaded"),
        F.lit(log.STARTED).alias("load_status"),
        F.col("records_loaded").alias("_n"),
        F.col("errors").alias("_errors"),
    )
    done = F.col("changed_at") + F.expr("INTERVAL 1 HOUR")
    finished = base.withColumns(
        {
            "changed_at": done,
            "end_date": done,
            "records_loaded": F.col("_n"),
            "load_status": log.outcome("changed_at", "_n", "_n", "_errors"),
        }
    )
    return base.unionByName(finished).drop("_n", "_errors")


@query
def load_history_latest(spark, folder):
    newest = log.latest_loads(log.current_state(_daily_batches(spark, folder)), 3, "incremental")
    return portable(newest.drop("start_date"))


@query
def load_outcomes(spark, folder):
    """Status of one batch per user: newest date, rows of the last day, usable rows, errors."""
    last_day = F.col("ts") >= F.lit("2024-01-30").cast("timestamp_ntz")
    per_user = table(spark, folder, "events").groupBy("user_id").agg(
        F.max(F.when(inputs.props_key() < 3, F.col("ts"))).alias("newest"),
        F.count_if(last_day).alias("in_window"),
        F.count_if(last_day & (F.col("event_type") != "signup")).alias("valid"),
        F.count_if(last_day & (F.col("event_type") == "error")).alias("errors"),
    )
    return per_user.select("user_id", log.outcome("newest", "in_window", "valid", "errors").alias("status"))


@query
def replaced_slice(spark, folder):
    """Two days of the activity mart; the second day is rebuilt from no sessions."""
    database = inputs.scratch_database(spark)
    mart = mart_plans.ACTIVITY.in_database(database)
    tb.create(spark, mart)
    rows = inputs.sessions(spark, folder)
    first, second = dt.date(2024, 1, 10), dt.date(2024, 1, 11)
    for day, source in ((first, rows), (second, rows), (second, rows.where("false")), (first, rows)):
        tb.replace_slice(marts.user_activity(source, day), mart, day)
    return portable(tb.read(spark, mart))


@query
def marts_of_run_date(spark, folder):
    """Raw tables replicated from documents, then one ticket snapshot built twice."""
    database = inputs.scratch_database(spark)
    raw = replication.TICKETS.table.in_database(database)
    mart = mart_plans.SUPPORT.in_database(database)
    documents = inputs.ticket_documents(spark, folder)
    replication.replicate_documents(spark, documents, replication.TICKETS, raw)
    for _ in range(2):
        mart_plans.build_support_efficiency(spark, dt.date(1998, 12, 31), raw, mart)
    return portable(tb.read(spark, mart))


@query
def appended_twice(spark, folder):
    """Flat pets appended by two runs: every row is there twice."""
    database = inputs.scratch_database(spark)
    pets = flattening.PETS.in_database(database)
    for _ in range(2):
        flattening.load_pets(spark, inputs.pet_documents(spark, folder), pets)
    counted = tb.read(spark, pets).groupBy("species").agg(
        F.count("*").alias("pets"), F.count("fav_foods").alias("with_foods")
    )
    return counted


@query
def inserted_missing_rows(spark, folder):
    """A keyed table that takes only unknown keys from the second load."""
    database = inputs.scratch_database(spark)
    spec = tb.TableSpec(
        name=f"{database}.events", ddl="event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE",
        key=("event_id",), required=("ts",),
    )
    tb.create(spark, spec)
    target, source = _merge_sides(spark, folder)
    tb.append(target, spec)
    tb.insert_missing(source, spec)
    loaded = tb.read(spark, spec)
    return portable(rounded(daily_summary(loaded, "ts", "value"), "avg_temp"))


@query
def inserted_first_of_repeated_keys(spark, folder):
    """Two source rows of one new key: the first by order is inserted."""
    database = inputs.scratch_database(spark)
    spec = tb.TableSpec(
        name=f"{database}.pairs", ddl="pair BIGINT, event_id BIGINT, user_id BIGINT", key=("pair",)
    )
    tb.create(spark, spec)
    events = table(spark, folder, "events").select(
        F.floor(F.col("event_id") / 2).alias("pair"), "event_id", "user_id"
    )
    tb.append(events.where("event_id % 10 = 1"), spec)
    tb.insert_missing(events, spec, "event_id")
    return portable(tb.read(spark, spec))


@query
def table_of_an_older_spec(spark, folder):
    """A table made and filled by a spec of two columns, then used by one of four."""
    name = f"{inputs.scratch_database(spark)}.events"
    older = tb.TableSpec(name, "event_id BIGINT, value DOUBLE", key=("event_id",))
    newer = replace(older, ddl="event_id BIGINT, kind STRING, value DOUBLE, user_id BIGINT")
    rows = table(spark, folder, "events").withColumn("kind", F.col("event_type"))
    tb.create(spark, older)
    tb.append(rows.where("event_id % 3 = 0"), older)
    tb.create(spark, newer)
    tb.append(rows.where("event_id % 3 = 1"), newer)
    changed = rows.where("event_id % 6 < 2").withColumn("value", -F.col("value"))
    tb.upsert_all(changed, newer)
    return tb.read(spark, newer).select("event_id", "kind", "value", "user_id")


@query
def csv_inferred_types(spark, folder):
    """Events written as CSV and typed by their cells; one late cell makes a column text."""
    path = shared_dir(spark, "typed-csv")
    k = inputs.props_key()
    rows = table(spark, folder, "events")
    last = F.col("event_id") == rows.agg(F.max("event_id")).scalar()
    rows = rows.select(
        "event_id",
        F.when(k % 7 != 0, F.col("user_id")).alias("user_id"),
        "value",
        (F.col("event_type") == "error").alias("is_error"),
        F.when(last, F.lit("n.a.")).otherwise(F.col("value").cast("string")).alias("mixed"),
        F.when(last, F.lit("1e3")).otherwise(F.col("event_id").cast("string")).alias("widened"),
        F.lit(None).cast("string").alias("nothing"),
    )
    write_delimited(rows, path)
    typed = read_delimited(spark, path, infer=True)
    return null_profile(typed)


@query
def csv_quoted_cells(spark, folder):
    """Cells with separators and doubled quotes, written and read back."""
    path = shared_dir(spark, "quoted-csv")
    events = table(spark, folder, "events")
    cells = F.concat(F.lit('kind "'), F.col("event_type"), F.lit('", user '), F.col("user_id"))
    write_delimited(events.select("event_id", cells.alias("note")), path)
    back = read_delimited(spark, path)
    return portable(back.select(F.col("event_id").cast("long").alias("event_id"), "note"))
