import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from millrace.operators.profile import load_quality
from millrace.operators.sampling import seeded_sample
from millrace.plans import loads
from millrace.sinks import history as log
from millrace.sinks import tables as tb
from millrace.sinks.rejects import REJECTS, screened
from millrace.sources.delimited import read_delimited
from millrace.sources.position import with_row_number, with_source_position


@pytest.fixture
def specs(database):
    return [s.in_database(database) for s in (loads.FULL, loads.INCREMENTAL, log.HISTORY)]


@pytest.fixture
def csv(spark, tmp_path):
    def write(text):
        (tmp_path / "deep").mkdir(exist_ok=True)
        (tmp_path / "deep" / "readings.csv").write_text(text)
        (tmp_path / "deep" / "notes.txt").write_text("not,read\n1,2\n")
        return read_delimited(spark, str(tmp_path))

    return write


READINGS = """id,room_id/id,noted_date,temp,out/in
x_1_dev_a,Room Admin,08-12-2018 09:30,29,In
x_1_dev_a,Room Admin,13-12-2018 09:30,29,In
,Room Admin,08-12-2018 09:31,x,Out
NA,,08-12-2018 09:32,12.5,
plain,Room Admin,08-10-2018 09:30,30,  a location too long
x_1_dev_a,Room Admin,08-12-2018 09:30,31,in
"""


def test_csv_is_text_with_missing_cells(csv):
    raw = csv(READINGS)
    assert set(dict(raw.dtypes).values()) == {"string"}
    assert raw.where(F.col("id").isNull()).count() == 2
    assert raw.count() == 6


def test_full_load(spark, csv, specs, rows):
    full, _, history = specs
    raw = csv(READINGS)
    first = loads.full_load(spark, raw, full, history, "full_1")
    again = loads.full_load(spark, raw, full, history, "full_2")
    assert (first.status, first.rows, again.rows) == ("success", 5, 5)
    at = dt.datetime(2018, 8, 12, 9, 30)
    minute = dt.timedelta(minutes=1)
    loaded = tb.read(spark, full)
    assert rows(loaded, "noted_date", "temperature", "location", "device_id") == sorted(
        [
            (at, 29.0, "In", "device_a"),
            (at + minute, None, "Out", "room_Room Admin"),
            (at + 2 * minute, 12.5, "unknown", "default_2"),
            (dt.datetime(2018, 8, 10, 9, 30), 30.0, "a location", "device_plain"),
            (at, 31.0, "in", "device_a"),
        ],
        key=repr,
    )
    assert rows(loaded.select("batch_id").distinct()) == [("full_2",)]
    assert loaded.where("load_timestamp IS NULL").count() == 0


def test_failed_full_load_keeps_the_table(spark, csv, specs):
    full, _, history = specs
    raw = csv(READINGS)
    loads.full_load(spark, raw, full, history, "ok")
    with pytest.raises(Exception):
        loads.full_load(spark, raw, full, history, "bad", strict_numbers=True)
    state = {r.batch_id: r for r in log.batches(spark, history).collect()}
    assert state["bad"].load_status == "failed"
    assert 0 < len(state["bad"].error_message) <= 500
    assert tb.read(spark, full).count() == 5


def test_incremental_load_window_and_last_row(spark, csv, specs, rows):
    _, table, history = specs
    result = loads.incremental_load(spark, csv(READINGS), 1, table, history, "inc_1")
    assert (result.status, result.rows) == ("success", 3)
    assert rows(tb.read(spark, table), "device_id", "temperature", "location") == [
        ("dev_a", 31.0, "in"), ("row_1", None, "Out"), ("row_2", 12.5, "unknown"),
    ]


def test_fallback_rows_are_numbered_after_the_prepared_cut(spark, csv, specs, rows):
    _, table, history = specs
    text = "id,noted_date,temp,out/in\n,01-01-2018 00:00,1,In\n,01-20-2018 00:00,2,In\n"
    loads.incremental_load(spark, csv(text), 7, table, history, "inc_1", cap_days=loads.PREPARED_DAYS)
    assert rows(tb.read(spark, table), "device_id") == [("row_0",)]


def test_cap_limits_the_window(spark, csv, specs):
    _, table, history = specs
    text = "id,noted_date,temp\na,01-01-2018 00:00,1\nb,01-10-2018 00:00,2\n"
    raw = csv(text)
    assert loads.incremental_load(spark, raw, 30, table, history, cap_days=7).rows == 1
    assert loads.incremental_load(spark, raw, 30, table, history).rows == 2


@pytest.mark.parametrize(
    ("text", "status"),
    [
        ("id,temp\na,1\n", "failed_no_date_col"),
        ("id,noted_date,temp\na,junk,1\n", "failed_no_date"),
    ],
)
def test_loads_without_dates(spark, csv, specs, text, status):
    _, table, history = specs
    result = loads.incremental_load(spark, csv(text), 7, table, history, "inc_1")
    assert (result.status, result.rows) == (status, 0)
    assert log.batches(spark, history).first().load_status == status


def test_window_without_rows(spark, csv, specs):
    _, table, history = specs
    assert loads.incremental_load(spark, csv(READINGS), -1, table, history).status == "no_data"


def test_repeated_load_updates_in_place(spark, specs):
    """A full load, then samples of 1000 and 2000 rows, then the first sample again."""
    full, table, history = specs
    start = dt.datetime(2024, 1, 1)
    raw = spark.range(6000).select(
        F.concat(F.lit("d_"), (F.col("id") % 11).cast("string")).alias("id"),
        F.date_format(F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id") * 5),
                      "MM-dd-yyyy HH:mm").alias("noted_date"),
        (F.col("id") % 40).cast("string").alias("temp"),
        F.lit("In").alias("out/in"),
        F.col("id").alias("_row"),
    )
    assert loads.full_load(spark, raw, full, history, "full_1").rows == 6000
    small = seeded_sample(raw, 1000, 42, ["_row"])
    large = seeded_sample(raw, 2000, 123, ["_row"])
    first = loads.incremental_load(spark, small, 3, table, history, "inc_1")
    loads.incremental_load(spark, large, 7, table, history, "inc_2")
    before = tb.read(spark, table).count()
    third = loads.incremental_load(spark, small, 3, table, history, "inc_3")
    loaded = tb.read(spark, table)
    assert third.rows == first.rows
    assert loaded.count() == before
    assert load_quality(loaded).first().duplicate_keys == 0
    assert loaded.where("batch_id = 'inc_3'").count() == first.rows
    assert loaded.where("batch_id = 'inc_1'").count() == 0
    report = loads.load_summary(spark, table, history, "incremental")
    assert report["stats"].first().total_records == before
    assert report["devices"].first().device_count == 11
    assert report["last_load"].first().batch_id == "inc_3"
    batch = loads.batch_summary(spark, table, "inc_3")
    assert sum(r.records for r in batch["days"].collect()) == first.rows
    assert batch["span"].first().days == batch["days"].count()
    assert batch["stats"].first().min_temp >= 0
    check = loads.quick_check(spark, table, history)
    assert check["quality"].first().total_rows == before
    assert [r.batch_id for r in check["last_loads"].collect()] == ["inc_3", "inc_2", "inc_1"]


def test_run_parameters():
    assert loads.run_parameters() == {"last_n_days": 7}
    assert loads.run_parameters({"last_n_days": 2}, {"last_n_days": 5}) == {"last_n_days": 2}
    assert loads.run_parameters(job={"last_n_days": 5}) == {"last_n_days": 5}


def test_row_numbers_follow_the_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n" + "\n".join(str(i) for i in range(5000)))
    raw = spark.read.option("header", True).schema("v BIGINT").csv(str(tmp_path))
    got = with_row_number(raw.where("v % 7 <> 3"), "n").collect()
    kept = [i for i in range(5000) if i % 7 != 3]
    assert sorted((r.n, r.v) for r in got) == list(enumerate(kept))
    placed = with_source_position(raw).orderBy("_ord").select("v").collect()
    assert [r.v for r in placed] == list(range(5000))


def test_row_numbers_over_many_tasks(spark):
    got = with_row_number(spark.range(0, 1000, 1, 13), "n").collect()
    assert all(r.id == r.n for r in got)


def test_row_numbers_after_a_shuffle(spark):
    df = spark.range(3000).repartition(6).where("id % 5 <> 0")
    got = with_row_number(df, "n").collect()
    assert sorted(r.n for r in got) == list(range(2400))
    assert with_row_number(df.where("id < 0"), "n").count() == 0


def test_last_row_by_file_order_whatever_the_file_sizes(spark, database, tmp_path):
    """A short first file and a long second one that repeats its key: the second wins."""
    head = "id,noted_date,temp,out/in\n"
    (tmp_path / "a.csv").write_text(head + "d_k,01-01-2024 10:00,1,In\n")
    long = [f"d_{i},01-01-2024 11:{i:02d},2,In" for i in range(40)] + ["d_k,01-01-2024 10:00,7,In"]
    (tmp_path / "b.csv").write_text(head + "\n".join(long) + "\n")
    raw = read_delimited(spark, str(tmp_path), order="_ord")
    table = loads.INCREMENTAL.in_database(database)
    history = loads.log.HISTORY.in_database(database)
    result = loads.incremental_load(spark, raw, table=table, history=history, run={"last_n_days": 3})
    assert (result.status, result.rows) == ("success", 41)
    stored = {r.device_id: r.temperature for r in loads.read(spark, table).collect()}
    assert stored["dev_k"] == 7


def test_numbers_by_position_follow_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v\n1\n")
    (tmp_path / "b.csv").write_text("v\n" + "".join(f"{i}\n" for i in range(2, 60)))
    raw = read_delimited(spark, str(tmp_path), order="_ord")
    got = with_row_number(raw, "n", "_ord").collect()
    assert sorted((r.n, int(r.v)) for r in got) == [(i, i + 1) for i in range(59)]


def test_quotes_and_headers_of_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,temp\n1,"a ""q"", b"\n')
    assert [tuple(r) for r in read_delimited(spark, str(tmp_path)).collect()] == [("1", 'a "q", b')]
    (tmp_path / "b.csv").write_text("temp,id\nB,2\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(tmp_path)).collect()


# --- rows the table refuses --------------------------------------------------------------

RULES = {"temperature below 30": "temperature < 30", "place is known": "location <> 'unknown'"}


@pytest.fixture
def ruled(specs, database):
    _, table, history = specs
    return replace(table, checks=RULES), history, REJECTS.in_database(database)


def test_refused_rows_are_kept_and_the_others_loaded(spark, csv, ruled, rows):
    table, history, rejects = ruled
    result = loads.incremental_load(spark, csv(READINGS), 1, table, history, "inc_1", rejects=rejects)
    assert (result.status, result.rows) == ("partial", 1)
    assert rows(tb.read(spark, table), "device_id", "temperature") == [("row_1", None)]
    kept = tb.read(spark, rejects).collect()
    assert sorted((r.batch_id, r.table_name, r.reason) for r in kept) == [
        ("inc_1", table.name.rsplit(".")[-1], "place is known"),
        ("inc_1", table.name.rsplit(".")[-1], "temperature below 30"),
    ]
    record = next(json.loads(r.record) for r in kept if r.reason == "temperature below 30")
    assert (record["device_id"], record["temperature"]) == ("dev_a", 31.0)
    state = log.batches(spark, history).first()
    assert (state.load_status, state.records_loaded) == ("partial", 1)


def test_a_load_without_valid_rows(spark, csv, ruled):
    table, history, rejects = ruled
    never = replace(table, checks={"never": "device_id IS NULL"})
    result = loads.incremental_load(spark, csv(READINGS), 1, never, history, "inc_1", rejects=rejects)
    assert (result.status, result.rows) == ("no_valid_data", 0)
    assert tb.read(spark, table).isEmpty() and tb.read(spark, rejects).count() == 3


def test_judging_rows_reads_the_source_no_further_time(spark, csv, ruled):
    table, history, rejects = ruled
    plain = replace(table, checks={})
    reads = []
    for spec in (plain, table):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches, seen=seen):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        raw = csv(READINGS)
        loads.incremental_load(spark, raw.mapInArrow(counted, raw.schema), 1, spec, history, rejects=rejects)
        reads.append(seen.value)
    assert reads[0] == reads[1]


def test_values_of_a_wrong_type_are_a_reason(spark, database, rows):
    spec = tb.TableSpec(f"{database}.w", "k INT, at DATE", ("k",))
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", None), (None, "2024-01-02"), ("4", "soon")], "k STRING, at STRING")
    with screened(df, spec) as found:
        assert (found.rows, found.errors) == (4, 3)
        assert rows(found.taken) == [(1, dt.date(2024, 1, 1))]
        assert rows(found.refused, "_reason") == [("at is not DATE",), ("k is not INT",), ("k must not be NULL",)]
    with screened(df.limit(0), spec) as found:
        assert (found.rows, found.errors, found.taken.count()) == (0, 0, 0)
