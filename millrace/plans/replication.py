"""Typed replication of document collections into ``raw`` tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType, VariantType

from millrace.functions.coerce import (
    iso_to_utc,
    length_or_zero,
    resolution_seconds,
    seconds_between,
)
from millrace.operators.dedupe import keep_first
from millrace.session import own_session, shuffles_sized_for
from millrace.sinks.arrivals import Merged, create, upsert
from millrace.sinks.tables import TableSpec
from millrace.sources.documents import read_collection

STAMPS = "created_at TIMESTAMP, updated_at TIMESTAMP"
NOW = {"created_at": "current_timestamp()", "updated_at": "current_timestamp()"}


@dataclass(frozen=True)
class Collection:
    """One document collection and the table it feeds.

    ``document`` is the DDL of a document as stored (dates are ISO text).
    ``columns`` gives table columns that are computed; others are taken as they
    are. ``keep`` and ``on_update`` are the columns an update leaves alone or
    sets to the current time. ``shapes`` are the fields usually found in a VARIANT
    column, which keeps whatever a document has.
    """

    name: str
    document: str
    table: TableSpec
    columns: Mapping[str, Callable[[], Column]]
    keep: tuple[str, ...] = ("created_at",)
    on_update: tuple[str, ...] = ("updated_at",)
    shapes: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.document)


SESSIONS = Collection(
    name="UserSessions",
    document=(
        "session_id STRING, user_id STRING, start_time STRING, end_time STRING, "
        "pages_visited ARRAY<STRING>, device VARIANT, actions ARRAY<STRING>"
    ),
    table=TableSpec(
        name="raw.user_sessions",
        ddl=(
            "session_id STRING, user_id STRING, start_time TIMESTAMP, end_time TIMESTAMP, "
            "session_duration_seconds INT, pages_visited ARRAY<STRING>, device VARIANT, "
            f"actions ARRAY<STRING>, {STAMPS}"
        ),
        key=("session_id",),
        required=("user_id", "start_time", "end_time", "session_duration_seconds"),
        defaults=NOW,
        sort_within=("start_time",),
    ),
    columns={
        "start_time": lambda: iso_to_utc("start_time"),
        "end_time": lambda: iso_to_utc("end_time"),
        "session_duration_seconds": lambda: seconds_between(
            iso_to_utc("start_time"), iso_to_utc("end_time")
        ),
    },
    shapes={"device": "STRUCT<type: STRING, os: STRING, browser: STRING>"},
)

EVENTS = Collection(
    name="EventLogs",
    document="event_id STRING, timestamp STRING, event_type STRING, details STRING",
    table=TableSpec(
        name="raw.event_logs",
        ddl=f"event_id STRING, timestamp TIMESTAMP, event_type STRING, details STRING, {STAMPS}",
        key=("event_id",),
        required=("timestamp", "event_type"),
        defaults=NOW,
        sort_within=("timestamp",),
    ),
    columns={"timestamp": lambda: iso_to_utc("timestamp")},
)

TICKETS = Collection(
    name="SupportTickets",
    document=(
        "ticket_id STRING, user_id STRING, status STRING, issue_type STRING, "
        "messages VARIANT, created_at STRING, updated_at STRING"
    ),
    table=TableSpec(
        name="raw.support_tickets",
        ddl=(
            "ticket_id STRING, user_id STRING, status STRING, issue_type STRING, "
            f"messages VARIANT, {STAMPS}, resolution_time_seconds INT, messages_count INT"
        ),
        key=("ticket_id",),
        required=("user_id", "status", "issue_type", "created_at", "updated_at"),
        sort_within=("created_at",),
    ),
    columns={
        "created_at": lambda: iso_to_utc("created_at"),
        "updated_at": lambda: iso_to_utc("updated_at"),
        "resolution_time_seconds": lambda: resolution_seconds(
            "status", iso_to_utc("created_at"), iso_to_utc("updated_at")
        ),
        "messages_count": lambda: length_or_zero(F.try_variant_get("messages", "$", "ARRAY<VARIANT>")),
    },
    keep=(),
    shapes={"messages": "ARRAY<STRUCT<sender: STRING, message: STRING, timestamp: STRING>>"},
)

RECOMMENDATIONS = Collection(
    name="UserRecommendations",
    document="user_id STRING, recommended_products ARRAY<STRING>, last_updated STRING",
    table=TableSpec(
        name="raw.user_recommendations",
        ddl=(
            "user_id STRING, recommended_products ARRAY<STRING>, "
            f"last_updated TIMESTAMP, {STAMPS}"
        ),
        key=("user_id",),
        required=("last_updated",),
        defaults=NOW,
    ),
    columns={"last_updated": lambda: iso_to_utc("last_updated")},
)

MODERATION = Collection(
    name="ModerationQueue",
    document=(
        "review_id STRING, user_id STRING, product_id STRING, review_text STRING, rating INT, "
        "moderation_status STRING, flags ARRAY<STRING>, submitted_at STRING"
    ),
    table=TableSpec(
        name="raw.moderation_queue",
        ddl=(
            "review_id STRING, user_id STRING, product_id STRING, review_text STRING, "
            "rating INT, moderation_status STRING, flags ARRAY<STRING>, "
            f"submitted_at TIMESTAMP, {STAMPS}"
        ),
        key=("review_id",),
        required=("user_id", "product_id", "submitted_at"),
        defaults=NOW,
        sort_within=("submitted_at",),
    ),
    columns={"submitted_at": lambda: iso_to_utc("submitted_at")},
)

COLLECTIONS = {c.name: c for c in (SESSIONS, EVENTS, TICKETS, RECOMMENDATIONS, MODERATION)}


# Where a document stood, for tables that are filled file by file.
PLACE = "_file STRING, _block BIGINT"


def merged(collection: Collection, table: TableSpec | None = None, first_by: str = "") -> Merged:
    return Merged(table or collection.table, collection.keep, collection.on_update, first_by)


def _whole(documents: DataFrame, name: str) -> Column:
    """A column as VARIANT, from a VARIANT, JSON text or nested value; JSON ``null`` is NULL."""
    kind = documents.schema[name].dataType
    if isinstance(kind, VariantType):
        value = F.col(name)
    elif isinstance(kind, StringType):
        value = F.parse_json(name)
    else:
        value = F.to_variant_object(name)
    return F.when(~F.is_variant_null(value), value)


def typed(rows: DataFrame, collection: Collection) -> DataFrame:
    """VARIANT columns as their usual shape: other fields are left out, what does not fit is NULL."""
    return rows.withColumns({c: F.try_variant_get(c, "$", shape) for c, shape in collection.shapes.items()})


def transform(
    documents: DataFrame, collection: Collection, order: str = "_ord", place: bool = False
) -> DataFrame:
    """Documents to typed rows, the first document of each key; ``place`` keeps its file and block.

    Rows are typed before they are chosen: a date that cannot be parsed fails
    the job even in a document that a repeated key would drop. Every expression
    reads the source row, so a computed column never sees another one.
    """
    types = collection.table.schema
    whole = {n: _whole(documents, n) for n in collection.shapes if n in documents.columns}
    documents = documents.withColumns(whole) if whole else documents
    names = [n for n in types.names if n in documents.columns or n in collection.columns]
    rows = documents.select(
        *[
            (collection.columns[n]() if n in collection.columns else F.col(n))
            .cast(types[n].dataType)
            .alias(n)
            for n in names
        ],
        F.col(order).alias("_place"),
    )
    if place:
        rows = rows.withColumns({"_file": F.col("_place.file"), "_block": F.col("_place.block")})
    return keep_first(rows, collection.table.key, "_place").drop("_place")


def replicate_documents(
    spark: SparkSession,
    documents: DataFrame,
    collection: Collection,
    table: TableSpec | None = None,
    order: str = "_ord",
) -> None:
    """Upsert documents. Only the batch is written, whatever the size of the table."""
    target = merged(collection, table)
    create(spark, target)
    with shuffles_sized_for(documents):
        upsert(transform(documents, collection, order), target, check_key=False)


def replicate_earlier(
    spark: SparkSession, documents: DataFrame, collection: Collection, table: TableSpec | None = None
) -> None:
    """Upsert documents; of each key, the one that stands first is the table's row.

    ``documents`` have a position ``_ord(file, block, row)``. The table keeps the file
    and block of its rows. However files are cut into runs, the first document of each
    key in the order of path and place wins, as in one run over all files. A batch that
    is repeated adds nothing to what the table shows but the time of its change.
    """
    target = merged(collection, table, PLACE)
    create(spark, target)
    with shuffles_sized_for(documents):
        upsert(transform(documents, collection, place=True), target, check_key=False)


def replicate(
    spark: SparkSession, root: str, collection: Collection, table: TableSpec | None = None
) -> None:
    """Read ``<root>/<collection>/`` (JSON lines) and upsert it into the raw table."""
    documents = read_collection(spark, f"{root.rstrip('/')}/{collection.name}", collection.schema)
    replicate_documents(spark, documents, collection, table)


def at_once(spark: SparkSession, work: Callable[[SparkSession, Collection], Any]) -> dict[str, Any]:
    """What ``work`` returns for each of the five collections; their jobs share the cluster at the same time.

    Each has a session of its own, so that none meets the settings of another.
    """
    with ThreadPoolExecutor(len(COLLECTIONS)) as pool:
        found = pool.map(lambda c: work(own_session(spark), c), COLLECTIONS.values())
        return dict(zip(COLLECTIONS, found, strict=True))


def replicate_all(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Replicate the five collections, all at the same time."""

    def one(session: SparkSession, collection: Collection) -> None:
        table = collection.table.in_database(database) if database else None
        replicate(session, root, collection, table)

    at_once(spark, one)
