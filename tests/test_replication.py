import datetime as dt
import glob
import json
import threading
from dataclasses import replace

import pytest

import __spark_entry__ as contract
from millrace.plans import replication
from millrace.plans.marts import ACTIVITY, SUPPORT, build_marts
from millrace.plans.replication import COLLECTIONS, replicate, transform
from millrace.sinks import tables as tb
from millrace.sources.documents import read_collection
from millrace.streaming.replicate import replicate_new

SESSION = {
    "_id": "5f", "session_id": "s1", "user_id": "u1",
    "start_time": "2024-03-01T10:00:00+03:00", "end_time": "2024-03-01T10:30:30+03:00",
    "pages_visited": ["/", "/cart"], "actions": [],
    "device": {"type": "mobile", "os": "iOS", "browser": "Safari"}, "extra": 1,
}
TICKET = {
    "_id": "1", "ticket_id": "t1", "user_id": "u1", "status": "resolved", "issue_type": "payment",
    "messages": [{"sender": "user", "message": "hi", "timestamp": "2024-03-01T10:00:00+00:00"}],
    "created_at": "2024-03-01T10:00:00+00:00", "updated_at": "2024-03-01T12:00:00+00:00",
}
SAMPLES = {
    "UserSessions": SESSION,
    "EventLogs": {"_id": "1", "event_id": "e1", "timestamp": "2024-03-01T10:00:00+00:00",
                  "event_type": "click", "details": {"path": "/", "info": {"n": [1, 2]}}},
    "SupportTickets": TICKET,
    "UserRecommendations": {"_id": "1", "user_id": "u1", "recommended_products": ["p1", "p2"],
                            "last_updated": "2024-03-01T10:00:00-01:00"},
    "ModerationQueue": {"_id": "1", "review_id": "r1", "user_id": "u1", "product_id": "p1",
                        "review_text": "ok", "rating": 4, "moderation_status": "pending",
                        "flags": [], "submitted_at": "2024-03-01T10:00:00+00:00"},
}


@pytest.fixture
def store(tmp_path):
    def write(collection, *documents, file="part-0.json"):
        folder = tmp_path / collection
        folder.mkdir(exist_ok=True)
        (folder / file).write_text("".join(json.dumps(d) + "\n" for d in documents))
        return str(tmp_path)

    return write


def loaded(spark, store, collection, *documents):
    root = store(collection.name, *documents)
    rows = transform(read_collection(spark, f"{root}/{collection.name}", collection.schema), collection)
    return replication.typed(rows, collection)


@pytest.mark.parametrize("name", list(COLLECTIONS))
def test_every_collection_replicates_twice(spark, database, store, name):
    collection = COLLECTIONS[name]
    spec = collection.table.in_database(database)
    root = store(name, SAMPLES[name])
    replicate(spark, root, collection, spec)
    first = tb.read(spark, spec).first()
    replicate(spark, root, collection, spec)
    second = tb.read(spark, spec).collect()
    assert len(second) == 1
    assert second[0].created_at == first.created_at
    assert second[0].updated_at > first.updated_at


def test_session_row(spark, store):
    row = loaded(spark, store, replication.SESSIONS, SESSION).first()
    assert "_id" not in row.asDict()
    assert row.start_time == dt.datetime(2024, 3, 1, 7)
    assert row.session_duration_seconds == 1830
    assert (row.pages_visited, row.actions, row.device.os) == (["/", "/cart"], [], "iOS")


def test_open_details_stay_json_text(spark, store):
    row = loaded(spark, store, replication.EVENTS, SAMPLES["EventLogs"]).first()
    assert json.loads(row.details) == {"path": "/", "info": {"n": [1, 2]}}


def test_first_document_of_a_key_wins(spark, store):
    later = {**SESSION, "user_id": "u2", "pages_visited": ["/x"]}
    first = {**SESSION, "pages_visited": None}
    got = loaded(spark, store, replication.SESSIONS, first, later, {**SESSION, "session_id": "s2"}).collect()
    row = next(r for r in got if r.session_id == "s1")
    assert (len(got), row.user_id, row.pages_visited) == (2, "u1", None)


def test_ticket_rules(spark, store):
    silent = {k: v for k, v in TICKET.items() if k != "messages"}
    got = loaded(
        spark, store, replication.TICKETS,
        TICKET,
        {**silent, "ticket_id": "t2", "status": "open"},
        {**TICKET, "ticket_id": "t3", "status": "closed", "messages": []},
    ).collect()
    assert {r.ticket_id: (r.resolution_time_seconds, r.messages_count) for r in got} == {
        "t1": (7200, 1), "t2": (None, 0), "t3": (7200, 0),
    }


def test_ticket_update_stamps_and_takes_creation_from_source(spark, database, store):
    spec = replication.TICKETS.table.in_database(database)
    replicate(spark, store("SupportTickets", TICKET), replication.TICKETS, spec)
    assert tb.read(spark, spec).first().updated_at == dt.datetime(2024, 3, 1, 12)
    moved = {**TICKET, "created_at": "2024-02-01T00:00:00+00:00"}
    replicate(spark, store("SupportTickets", moved), replication.TICKETS, spec)
    row = tb.read(spark, spec).first()
    assert row.created_at == dt.datetime(2024, 2, 1)
    assert row.updated_at > dt.datetime(2025, 1, 1)


def test_bad_time_fails_even_in_a_dropped_document(spark, store):
    with pytest.raises(Exception):
        loaded(spark, store, replication.SESSIONS, SESSION, {**SESSION, "end_time": "soon"}).collect()


def test_missing_required_field_fails(spark, database, store):
    spec = replication.EVENTS.table.in_database(database)
    document = {k: v for k, v in SAMPLES["EventLogs"].items() if k != "event_type"}
    with pytest.raises(Exception, match="must not be NULL"):
        replicate(spark, store("EventLogs", document), replication.EVENTS, spec)
    assert tb.read(spark, spec).count() == 0


def test_polling_takes_only_new_files(spark, database, store, tmp_path):
    collection = replication.EVENTS
    spec = collection.table.in_database(database)
    checkpoint = str(tmp_path / "position")

    def run(root):
        query = replicate_new(spark, root, collection, checkpoint, spec)
        query.awaitTermination()
        return {r.event_id: r.event_type for r in tb.read(spark, spec).collect()}, query.lastProgress

    event = SAMPLES["EventLogs"]
    root = store("EventLogs", event, {**event, "event_id": "e2"})
    state, _ = run(root)
    assert state == {"e1": "click", "e2": "click"}
    state, progress = run(root)
    assert state == {"e1": "click", "e2": "click"}
    assert progress is None or progress["numInputRows"] == 0
    store("EventLogs", {**event, "event_type": "view"}, file="part-1.json")
    state, _ = run(root)
    assert state == {"e1": "click", "e2": "click"}  # the first file's document stays


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_first_document_wins_however_files_are_cut(spark, database, store, tmp_path, max_files):
    collection, event = replication.EVENTS, SAMPLES["EventLogs"]
    for file, (key, kind) in enumerate([("e1", "a"), ("e2", "b"), ("e1", "c"), ("e2", "d"), ("e3", "e")]):
        root = store("EventLogs", {**event, "event_id": key, "event_type": kind}, file=f"part-{9 - file}.json")
    batch, stream = (
        replace(collection.table, name=f"{database}.{n}") for n in ("by_batch", "by_stream")
    )
    replicate(spark, root, collection, batch)
    checkpoint = str(tmp_path / "position")
    replicate_new(spark, root, collection, checkpoint, stream, max_files).awaitTermination()

    def state(spec):
        return {r.event_id: r.event_type for r in tb.read(spark, spec).collect()}

    assert state(stream) == state(batch) == {"e1": "c", "e2": "d", "e3": "e"}
    store("EventLogs", {**event, "event_type": "z"}, file="part-0.json")
    store("EventLogs", {**event, "event_id": "e2", "event_type": "late"}, file="part-99.json")
    replicate_new(spark, root, collection, checkpoint, stream, max_files).awaitTermination()
    replicate(spark, root, collection, batch)
    assert state(stream) == state(batch) == {"e1": "z", "e2": "d", "e3": "e"}


def test_upsert_leaves_the_base_alone(spark, database, store):
    spec, event = replication.EVENTS.table.in_database(database), SAMPLES["EventLogs"]
    many = [{**event, "event_id": f"e{i}"} for i in range(200)]
    replicate(spark, store("EventLogs", *many), replication.EVENTS, spec)
    root = tb.location(spark, f"{spec.name}_runs").removeprefix("file:")
    before = set(glob.glob(f"{root}/*/*.parquet"))
    made = {r.event_id: (r.created_at, r.updated_at) for r in tb.read(spark, spec).collect()}
    changed = {**event, "event_id": "e7", "event_type": "view"}
    documents = read_collection(
        spark, f"{store('Changed', changed)}/Changed", replication.EVENTS.schema
    )
    replication.replicate_documents(spark, documents, replication.EVENTS, spec)
    after = set(glob.glob(f"{root}/*/*.parquet"))
    assert before < after and len(after - before) == 1
    rows = {r.event_id: r for r in tb.read(spark, spec).collect()}
    assert len(rows) == 200 and rows["e7"].event_type == "view"
    assert rows["e7"].created_at == made["e7"][0] and rows["e7"].updated_at > made["e7"][1]
    assert (rows["e8"].created_at, rows["e8"].updated_at) == made["e8"]


def test_no_staged_copy_is_left(spark, database, store):
    pattern = f"{spark.conf.get('spark.checkpoint.dir')}/millrace/batch-*"
    before = glob.glob(pattern)
    spec = replication.EVENTS.table.in_database(database)
    replicate(spark, store("EventLogs", SAMPLES["EventLogs"]), replication.EVENTS, spec)
    with pytest.raises(Exception):
        broken = {**SAMPLES["EventLogs"], "timestamp": "soon"}
        replicate(spark, store("EventLogs", broken, file="b.json"), replication.EVENTS, spec)
    assert glob.glob(pattern) == before


def test_all_collections_and_marts(spark, store):
    for name, document in SAMPLES.items():
        root = store(name, document)
    replication.replicate_all(spark, root)
    day = dt.date(2024, 3, 1)
    for _ in range(2):
        build_marts(spark, day)
    activity = tb.read(spark, ACTIVITY).collect()
    assert [(r.user_id, r.sessions_count, r.unique_pages_visited) for r in activity] == [("u1", 2, 2)]
    support = tb.read(spark, SUPPORT).collect()
    assert [(r.status, r.tickets_count, float(r.avg_resolution_time_hours)) for r in support] == [
        ("resolved", 1, 2.0)
    ]


def test_fields_the_ddl_does_not_name_survive(spark, database, store):
    deep = {"type": "tv", "screen": {"w": 3, "sizes": [1, {"x": None}]}, "42": True}
    odd = [{"sender": "user", "note": "n", "score": 1.5}, "plain text"]
    store("UserSessions", {**SESSION, "device": deep}, {**SESSION, "session_id": "s2", "device": "none"},
          {**SESSION, "session_id": "s3", "device": None}, {k: v for k, v in SESSION.items() if k != "device"} | {"session_id": "s4"})
    root = store("SupportTickets", {**TICKET, "messages": odd}, {**TICKET, "ticket_id": "t2", "messages": {"a": 1}},
                 {**TICKET, "ticket_id": "t3", "messages": None})
    found = {}
    for name, column in (("UserSessions", "device"), ("SupportTickets", "messages")):
        collection = COLLECTIONS[name]
        spec = collection.table.in_database(database)
        for _ in range(2):
            replicate(spark, root, collection, spec)
        for r in tb.read(spark, spec).selectExpr(collection.table.key[0], f"to_json({column}) AS whole").collect():
            found[r[0]] = json.loads(r.whole) if r.whole else None
    assert found == {"s1": deep, "s2": "none", "s3": None, "s4": None, "t1": odd, "t2": {"a": 1}, "t3": None}
    tickets = tb.read(spark, COLLECTIONS["SupportTickets"].table.in_database(database))
    assert {r.ticket_id: r.messages_count for r in tickets.collect()} == {"t1": 2, "t2": 0, "t3": 0}
    sessions = replication.typed(tb.read(spark, COLLECTIONS["UserSessions"].table.in_database(database)), COLLECTIONS["UserSessions"])
    assert {r.session_id: r.device and r.device.type for r in sessions.collect()} == {"s1": "tv", "s2": None, "s3": None, "s4": None}


def test_written_collections_are_compressed_and_cut(spark, monkeypatch):
    """What a job writes for its own reading is no multiple of its input, and no file grows with it."""
    from workload import queries

    class Seen(Exception):
        pass

    def look(spark, root, database):
        files = spark.read.text(f"{root}/*").select("_metadata.file_path").groupBy("file_path").count().collect()
        raise Seen([(r["file_path"], r["count"]) for r in files])

    monkeypatch.setattr(queries.replication, "replicate_all", look)
    monkeypatch.setattr(queries, "DOCUMENTS_PER_FILE", 30)
    with pytest.raises(Seen) as seen:
        queries.all_collections_replicated_twice(spark, "/root/testdata/sf0.001")
    files = seen.value.args[0]
    assert len(files) > 5 and all(name.endswith(".json.gz") and n <= 30 for name, n in files)


def test_collections_upserted_share_the_cluster(spark, monkeypatch):
    """No collection's loads wait for those of another one."""
    together, load = threading.Barrier(5), replication.replicate_documents

    def when_all_are_there(*args):
        together.wait(60)
        load(*args)

    monkeypatch.setattr(replication, "replicate_documents", when_all_are_there)
    found = contract.queries()["replicated_collections_upserted"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == 5
    assert all(r["rows"] == r["created_kept"] == r["updated_moved"] > 0 for r in found)
