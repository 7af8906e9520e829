"""Keyed tables of a base and runs: cost of upserts, folds that stop, loads at the same time."""

import datetime as dt
import json
import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest

from millrace.plans import replication
from millrace.sinks import arrivals
from millrace.sinks import tables as tb
from millrace.sinks.arrivals import Merged
from millrace.session import own_session

DDL = "k INT, v STRING, made TIMESTAMP, changed TIMESTAMP"


@pytest.fixture
def table(spark, database):
    now = {"made": "current_timestamp()", "changed": "current_timestamp()"}
    spec = tb.TableSpec(f"{database}.t", DDL, ("k",), ("v",), now, sort_within=("k",))
    made = Merged(spec, keep=("made",), on_update=("changed",))
    arrivals.create(spark, made)
    return made


def frame(spark, values):
    return spark.createDataFrame(list(values.items()), "k INT, v STRING")


def shown(spark, table):
    return {r.k: r.v for r in tb.read(spark, table.spec).collect()}


def size(folder):
    folder = folder.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_runs_and_folds_show_what_upserts_one_by_one_would(spark, table, monkeypatch):
    monkeypatch.setattr(arrivals, "FOLD_RUNS", 3)
    rng, wanted, first, folds = random.Random(1), {}, {}, set()
    for turn in range(9):
        batch = {rng.randrange(30): f"{turn}-{i}" for i in range(8)}
        assert arrivals.upsert(frame(spark, batch), table) == len(batch)
        wanted.update(batch)
        state = {r.k: r for r in tb.read(spark, table.spec).collect()}
        assert {k: r.v for k, r in state.items()} == wanted
        for k, r in state.items():
            assert first.setdefault(k, r.made) == r.made
        folds.add(arrivals.base(spark, table))
    assert len(folds) > 2


def test_an_update_moves_its_time_alone(spark, table):
    arrivals.upsert(frame(spark, {1: "a", 2: "b"}), table)
    before = {r.k: r for r in tb.read(spark, table.spec).collect()}
    arrivals.upsert(frame(spark, {2: "B", 3: "c"}), table)
    for fold in (False, True):
        if fold:
            arrivals.fold(spark, table)
            assert arrivals.run_numbers(spark, table) == []
        after = {r.k: r for r in tb.read(spark, table.spec).collect()}
        assert after[1] == before[1]
        assert after[2].v == "B" and after[2].made == before[2].made and after[2].changed > before[2].changed
        assert after[3].changed == after[3].made


def test_twenty_upserts_of_a_hundredth_write_less_than_half_the_table(spark, table, monkeypatch):
    monkeypatch.setattr(arrivals, "FOLD_BYTES", 0)
    n = 40_000
    text = long_text(spark.range(n).selectExpr("CAST(id AS INT) AS k"), "first")
    arrivals.upsert(text, table)
    whole = size(arrivals.base(spark, table))
    for turn in range(20):
        some = spark.range(n).where(f"pmod(xxhash64(id, {turn}), 100) = 0").selectExpr("CAST(id AS INT) AS k")
        arrivals.upsert(long_text(some.coalesce(1), f"turn {turn}"), table)
    root = arrivals.root(spark, table)
    written = size(root) - whole
    assert 0 < written < 0.5 * whole
    assert len(arrivals.run_numbers(spark, table)) == 20
    expected = {}
    for turn in range(20):
        for r in spark.range(n).where(f"pmod(xxhash64(id, {turn}), 100) = 0").collect():
            expected[r.id] = f"turn {turn}"
    found = {r.k: r.v.split("|")[0] for r in tb.read(spark, table.spec).collect()}
    assert found == {k: expected.get(k, "first") for k in range(n)}


def long_text(df, word):
    return df.selectExpr("k", f"concat('{word}|', sha2(cast(k as string), 256), sha2(cast(-k as string), 256)) AS v")


@pytest.mark.parametrize("stop", ["written", "switched"])
def test_a_stopped_fold_loses_and_repeats_nothing(spark, table, monkeypatch, stop):
    for batch in ({1: "a", 2: "b"}, {2: "B", 3: "c"}, {3: "C"}):
        arrivals.upsert(frame(spark, batch), table)
    before = sorted(tb.read(spark, table.spec).collect())

    class Stopped(Exception):
        pass

    plain = type(spark).sql

    def sql(self, text, *args, **kw):
        point = "SET LOCATION" if stop == "written" else "DROP IF EXISTS"
        if point in text:
            raise Stopped
        return plain(self, text, *args, **kw)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", sql)
        with pytest.raises(Stopped):
            arrivals.fold(spark, table)
    assert sorted(tb.read(spark, table.spec).collect()) == before
    arrivals.upsert(frame(spark, {4: "d"}), table)
    arrivals.fold(spark, table)
    assert [r for r in sorted(tb.read(spark, table.spec).collect()) if r.k != 4] == before
    arrivals.upsert(frame(spark, {4: "D"}), table)
    arrivals.fold(spark, table)
    left = os.listdir(arrivals.root(spark, table).removeprefix("file:"))
    assert sum(name.startswith("state-") for name in left) == 2  # the base and the one before


def test_rows_the_table_refuses_change_nothing(spark, table):
    arrivals.upsert(frame(spark, {1: "a"}), table)
    with pytest.raises(Exception, match="must not be NULL"):
        arrivals.upsert(frame(spark, {2: None}), table)
    with pytest.raises(tb.KeyViolation):
        arrivals.upsert(frame(spark, {3: "x"}).union(frame(spark, {3: "y"})), table)
    assert shown(spark, table) == {1: "a"}
    assert arrivals.upsert(frame(spark, {}), table) == 0


def test_loads_at_the_same_time(spark, table):
    arrivals.upsert(frame(spark, {0: "base"}), table)

    def load(i):
        return arrivals.upsert(frame(own_session(spark), {0: f"{i}", i: f"{i}"}), table)

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(load, range(1, 9))) == [2] * 8
    found = shown(spark, table)
    assert sorted(found) == list(range(9)) and found[0] in {str(i) for i in range(1, 9)}


def test_first_by_keeps_the_row_that_stands_first(spark, database):
    spec = tb.TableSpec(f"{database}.p", "k INT, v STRING", ("k",))
    table = Merged(spec, first_by="_file STRING, _block BIGINT")
    arrivals.create(spark, table)
    batches = [[(1, "x", "f2", 0), (2, "y", "f2", 8)], [(1, "w", "f1", 0)], [(1, "z", "f3", 0), (2, "q", "f2", 0)]]
    for i, batch in enumerate(batches):
        for _ in range(1 + (i == 1)):  # one batch comes again
            arrivals.upsert(spark.createDataFrame(batch, "k INT, v STRING, _file STRING, _block BIGINT"), table)
        if i == 1:
            arrivals.fold(spark, table)
        assert tb.read(spark, spec).columns == ["k", "v"]
    assert shown(spark, table) == {1: "w", 2: "q"}


def test_filters_and_columns_reach_the_base(spark, table):
    arrivals.upsert(frame(spark, {i: str(i) for i in range(50)}), table)
    arrivals.upsert(frame(spark, {7: "seven"}), table)
    plan = tb.read(spark, table.spec).where("k > 40").select("k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k,40)" in plan


# --- all collections at the same time ---------------------------------------------------


KEYS = {
    "UserSessions": ("session_id", {"user_id": "u", "start_time": "2024-03-01T10:00:00Z", "end_time": "2024-03-01T10:01:00Z"}),
    "EventLogs": ("event_id", {"timestamp": "2024-03-01T10:00:00Z", "event_type": "click"}),
    "SupportTickets": (
        "ticket_id",
        {"user_id": "u", "status": "open", "issue_type": "x", "created_at": "2024-03-01T10:00:00Z", "updated_at": "2024-03-01T10:00:00Z"},
    ),
    "UserRecommendations": ("user_id", {"last_updated": "2024-03-01T10:00:00Z"}),
    "ModerationQueue": ("review_id", {"user_id": "u", "product_id": "p", "submitted_at": "2024-03-01T10:00:00Z"}),
}


def test_replicating_all_collections_loses_no_row(spark, database, tmp_path):
    """Twenty rounds: 200 documents each, then two new ones a round, one of them known."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)

    def write(ids):
        for name, (key, rest) in KEYS.items():
            (tmp_path / name).mkdir(exist_ok=True)
            (tmp_path / name / "part.json").write_text("".join(json.dumps({key: i, **rest}) + "\n" for i in ids))

    write([f"a{i}" for i in range(200)])
    replication.replicate_all(spark, str(tmp_path), database)
    for turn in range(20):
        write([f"b{turn}", f"a{turn}"])
        replication.replicate_all(spark, str(tmp_path), database)
    for collection in replication.COLLECTIONS.values():
        found = tb.read(spark, collection.table.in_database(database))
        assert found.count() == 220
        changed = found.where("updated_at > created_at").count()
        assert changed == 20 or collection.name == "SupportTickets"
    assert spark.conf.get(setting) == before


# --- slices -------------------------------------------------------------------------------


@pytest.mark.parametrize("step", ["written", "switched"])
def test_a_stopped_slice_is_old_or_new(spark, database, monkeypatch, step):
    spec = tb.TableSpec(f"{database}.s", "v INT, day DATE", partition="day")
    tb.create(spark, spec)
    day, other = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tb.replace_slice(spark.createDataFrame([(1,), (2,)], "v INT"), spec, day)
    tb.replace_slice(spark.createDataFrame([(9,)], "v INT"), spec, other)

    class Stopped(Exception):
        pass

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patched:
        patched.setattr(tb, "_switch_partition" if step == "written" else "remove", stop)
        with pytest.raises(Stopped):
            tb.replace_slice(spark.createDataFrame([(3,)], "v INT"), spec, day)
    found = sorted(r.v for r in tb.read(spark, spec).where("day = DATE'2024-01-01'").collect())
    assert found == ([1, 2] if step == "written" else [3])
    tb.replace_slice(spark.createDataFrame([], "v INT"), spec, day)
    assert [r.v for r in tb.read(spark, spec).collect()] == [9]
