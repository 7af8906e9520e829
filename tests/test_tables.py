import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from millrace.sinks import history as log
from millrace.sinks import tables as tb
from millrace.sources.tables import existing_tables


def spec_in(database, **changes):
    values = {
        "name": f"{database}.t",
        "ddl": "k INT, v STRING, made TIMESTAMP",
        "key": ("k",),
        "required": ("v",),
        "defaults": {"made": "current_timestamp()"},
        **changes,
    }
    return tb.TableSpec(**values)


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k INT, v STRING")


def test_create_is_idempotent_and_visible(spark, database):
    spec = spec_in(database)
    tb.create(spark, spec)
    tb.create(spark, spec)
    assert existing_tables(spark, [spec.name, f"{database}.absent"]) == [spec.name]
    spark.sql(f"INSERT INTO {spec.name} (k, v) VALUES (1, 'a')")
    assert tb.read(spark, spec).first().made is not None


def test_replace_all_reads_its_own_table(spark, database, rows):
    spec = spec_in(database)
    tb.create(spark, spec)
    tb.replace_all(frame(spark, (1, "a"), (2, "b")), spec)
    for _ in range(3):
        current = tb.read(spark, spec)
        tb.replace_all(current.withColumn("v", F.concat("v", F.lit("!"))), spec)
    assert rows(tb.read(spark, spec), "k", "v") == [(1, "a!!!"), (2, "b!!!")]
    tb.append(frame(spark, (3, "c")), spec)
    assert tb.read(spark, spec).count() == 3


def test_failed_replacement_keeps_the_rows(spark, database, rows):
    spec = spec_in(database)
    tb.create(spark, spec)
    tb.replace_all(frame(spark, (1, "a")), spec)
    with pytest.raises(Exception, match="must not be NULL"):
        tb.replace_all(frame(spark, (2, "b"), (3, None)), spec)
    assert rows(tb.read(spark, spec), "k", "v") == [(1, "a")]
    tb.replace_all(frame(spark, (4, "d")), spec)
    assert rows(tb.read(spark, spec), "k", "v") == [(4, "d")]


def test_key_checks(spark, database):
    spec = spec_in(database)
    tb.check_unique(frame(spark, (1, "a"), (2, "a")), spec)
    with pytest.raises(tb.KeyViolation):
        tb.check_unique(frame(spark, (1, "a"), (1, "b")), spec)
    with pytest.raises(Exception, match="must not be NULL"):
        tb.conform(frame(spark, (None, "a")), spec).collect()


def test_repeated_keys_never_become_the_table(spark, database, rows):
    spec = spec_in(database)
    tb.create(spark, spec)
    tb.upsert_all(frame(spark, (1, "a")), spec, check_key=True)
    with pytest.raises(tb.KeyViolation):
        tb.upsert_all(frame(spark, (2, "b"), (2, "c")), spec, check_key=True)
    assert rows(tb.read(spark, spec), "k", "v") == [(1, "a")]


def test_upsert_and_insert_missing(spark, database, rows):
    spec = spec_in(database)
    tb.create(spark, spec)
    tb.upsert_all(frame(spark, (1, "a"), (2, "b")), spec, keep=["made"])
    before = {r.k: r.made for r in tb.read(spark, spec).collect()}
    tb.upsert_all(frame(spark, (2, "B"), (3, "c")), spec, keep=["made"])
    after = {r.k: r.made for r in tb.read(spark, spec).collect()}
    assert rows(tb.read(spark, spec), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert after[1] == before[1] and after[2] == before[2]
    tb.insert_missing(frame(spark, (3, "x"), (4, "d")), spec)
    assert rows(tb.read(spark, spec), "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


@pytest.fixture
def by_day(spark, database):
    spec = tb.TableSpec(
        name=f"{database}.d",
        ddl="at TIMESTAMP_NTZ, device STRING, v INT, day DATE",
        key=("at", "device"),
        partition="day",
        partition_from="to_date(at)",
    )
    tb.create(spark, spec)
    return spec


def dated(spark, *items):
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, d, 6), dev, v) for d, dev, v in items], "at TIMESTAMP_NTZ, device STRING, v INT"
    )


def files(spark, spec, day):
    root = tb.partition_location(spark, spec, f"2024-01-{day:02d}").removeprefix("file:")
    return sorted(glob.glob(f"{root}/*.parquet"))


def test_partition_upsert_rewrites_touched_days_only(spark, by_day, rows):
    assert tb.upsert_partitions(dated(spark, (1, "a", 1), (1, "b", 2), (2, "a", 3)), by_day) == 3
    untouched = files(spark, by_day, 1)
    assert untouched
    assert tb.upsert_partitions(dated(spark, (2, "a", 30), (3, "a", 4)), by_day) == 2
    assert files(spark, by_day, 1) == untouched
    assert [r[1:] for r in rows(tb.read(spark, by_day), "at", "device", "v")] == [
        ("a", 1), ("b", 2), ("a", 30), ("a", 4),
    ]
    assert tb.upsert_partitions(dated(spark, (1, "a", 1)).where("false"), by_day) == 0
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_partitioned_tables_are_not_replaced_whole(spark, by_day):
    with pytest.raises(ValueError):
        tb.replace_all(dated(spark, (1, "a", 1)), by_day)


# --- load history ---------------------------------------------------------------------


def test_history_keeps_one_state_per_batch(spark, database):
    spec = log.HISTORY.in_database(database)
    tb.create(spark, spec)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    later = start + dt.timedelta(hours=1)
    log.record(spark, spec, "full", "b1", log.STARTED, start)
    log.record(spark, spec, "incremental", "b2", log.STARTED, later)
    log.record(spark, spec, "incremental", "b2", log.FAILED, later, error="x" * 900)
    log.record(spark, spec, "full", "b1", log.SUCCESS, start, 5)
    state = {r.batch_id: r for r in log.batches(spark, spec).collect()}
    assert (state["b1"].load_status, state["b1"].records_loaded) == ("success", 5)
    assert state["b1"].end_date is not None
    assert (state["b2"].load_status, len(state["b2"].error_message)) == ("failed", 500)
    newest = log.latest_loads(log.batches(spark, spec), 1).first()
    assert newest.batch_id == "b2"
    assert log.latest_loads(log.batches(spark, spec), 3, "full").count() == 1
    assert tb.read(spark, spec).count() == 4


def test_history_can_be_compacted(spark, database):
    spec = log.HISTORY.in_database(database)
    tb.create(spark, spec)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for status in (log.STARTED, log.FAILED, log.STARTED, log.SUCCESS):
        log.record(spark, spec, "full", "b1", status, start, 5)
    before = [r.asDict() for r in log.batches(spark, spec).collect()]
    log.compact(spark, spec)
    assert [r.asDict() for r in log.batches(spark, spec).collect()] == before
    assert tb.read(spark, spec).count() == 1


def test_a_slice_refuses_rows_of_another_date(spark, by_day):
    rows = dated(spark, (1, "a", 1), (2, "b", 2))
    with pytest.raises(Exception, match="is not of"):
        tb.replace_slice(rows, by_day, dt.date(2024, 1, 1))
    tb.replace_slice(dated(spark, (1, "a", 1)), by_day, dt.date(2024, 1, 1))
    assert tb.read(spark, by_day).count() == 1


def test_the_first_of_repeated_keys_is_inserted(spark, database, rows):
    spec = spec_in(database)
    tb.create(spark, spec)
    tb.insert_missing(frame(spark, (1, "b"), (1, "a"), (2, "x")), spec, "v")
    assert rows(tb.read(spark, spec), "k", "v") == [(1, "a"), (2, "x")]


def test_batch_names_and_outcomes(spark, rows):
    assert log.batch_name("inc", dt.datetime(2024, 1, 2, 3, 4, 5)) == "inc_20240102_030405"
    df = spark.createDataFrame(
        [(1, None, 0, 0, 0), (2, "d", 0, 0, 0), (3, "d", 2, 0, 2), (4, "d", 2, 2, 1), (5, "d", 2, 2, 0)],
        "n INT, newest STRING, w INT, v INT, e INT",
    )
    assert [r[1] for r in rows(df.select("n", log.outcome("newest", "w", "v", "e")))] == [
        "failed_no_date", "no_data", "no_valid_data", "partial", "success",
    ]
