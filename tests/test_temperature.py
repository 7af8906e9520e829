import datetime as dt

import pytest

from millrace.plans import temperature
from millrace.sinks.tables import read
from millrace.sources.delimited import read_delimited, write_delimited

HEADER = "id,room_id/id,noted_date,temp,out/in\n"


def lines(day, *temps, place="In"):
    return "".join(f"x,r,{day:02d}-05-2018 10:0{i},{t},{place}\n" for i, t in enumerate(temps))


@pytest.fixture
def raw(spark, tmp_path):
    def write(text, name="a"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.csv").write_text(HEADER + text)
        return read_delimited(spark, str(folder))

    return write


@pytest.fixture
def specs(database):
    return {k: s.in_database(database) for k, s in temperature.TABLES.items()}


def test_usable_rows(spark, raw, rows):
    text = lines(1, 10, "x", "NaN", 30) + lines(2, 99, place=" OUT ") + lines(3, 20, place=" IN ")
    text += "x,r,13-05-2018 10:00,5,In\nx,r,junk,5,In\n"
    usable = temperature.usable_readings(raw(text))
    assert rows(usable, "noted_date", "temp", "`out/in`") == [
        (dt.date(2018, 1, 5), 10.0, "in"),
        (dt.date(2018, 1, 5), 30.0, "in"),
        (dt.date(2018, 3, 5), 20.0, "in"),
    ]


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="temp"):
        temperature.usable_readings(spark.createDataFrame([("a", "b")], ["noted_date", "x"]))


def test_whole_job(spark, raw, specs, rows, tmp_path):
    # 21 values 1..21: the 5th percentile is 2 and the 95th is 20.
    text = "".join(lines(d, *range(3 * d - 2, 3 * d + 1)) for d in range(1, 8))
    results = temperature.process(spark, raw(text), tables=specs, output=str(tmp_path / "out"))
    limits = results["limits"].first()
    assert (limits.lower_percentile, limits.upper_percentile) == (2.0, 20.0)
    assert (limits.rows_before, limits.rows_after) == (21, 19)
    day = [dt.date(2018, d, 5) for d in range(1, 8)]
    assert rows(results["summary"], "date", "avg_temp", "record_count")[:2] == [
        (day[0], 2.5, 2), (day[1], 5.0, 3),
    ]
    hot = results["extremes"].where("type = 'hot'").orderBy("rank").collect()
    assert [(r.date, r.temperature) for r in hot][:2] == [(day[6], 19.5), (day[5], 17.0)]
    assert [r.noted_date for r in results["coldest"].collect()] == day[:5]
    stats = results["stats"].first()
    assert (stats.total_records, stats.total_days, stats.min_temp, stats.max_temp) == (19, 7, 2.0, 20.0)

    results_file = read_delimited(spark, str(tmp_path / "out" / "results"))
    assert results_file.columns == ["id", "room_id/id", "noted_date", "temp", "out/in"]
    assert results_file.count() == 19
    report = [r.value for r in spark.read.text(str(tmp_path / "out" / "summary")).collect()]
    assert report[2:5] == [
        "Всего записей после очистки: 19", "5-й процентиль: 2.00°C", "95-й процентиль: 20.00°C",
    ]
    assert report[7] == "2018-07-05: 19.50°C"
    assert report[14] == "2018-01-05: 2.50°C"
    assert len(report) == 19

    # A later run without the old days updates its own days; old days still rank.
    temperature.process(spark, raw(lines(9, 1, 1, 1), "b"), tables=specs)
    assert read(spark, specs["data"]).count() == 3
    assert read(spark, specs["summary"]).count() == 8
    cold = read(spark, specs["extremes"]).where("type = 'cold'").orderBy("rank").collect()
    assert [r.date for r in cold][:2] == [dt.date(2018, 9, 5), day[0]]


def test_results_as_csv(spark, tmp_path):
    df = spark.createDataFrame([("2018-01-05", 1.5)], "noted_date STRING, temp DOUBLE")
    write_delimited(df, str(tmp_path / "out"))
    back = read_delimited(spark, str(tmp_path / "out"))
    assert [tuple(r) for r in back.collect()] == [("2018-01-05", "1.5")]


def test_trim_needs_no_python(spark, raw):
    plan = temperature.clean_readings(raw(lines(1, 1, 2, 3)))._jdf.queryExecution().toString()
    assert "Python" not in plan
    assert plan.count("Exchange") == 0
