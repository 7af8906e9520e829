import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import dedupe, merge, profile, quantiles, ranking, recent, sampling, summaries

DAY = dt.datetime(2024, 1, 1)


# --- dedupe and merge ----------------------------------------------------------------


def test_first_row_wins_with_its_nulls(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "x", 2), ("b", "y", 4), ("b", "z", 3), (None, "n", 5), (None, "m", 6)],
        "k STRING, v STRING, o INT",
    )
    assert rows(dedupe.keep_first(df, "k", "o")) == rows(
        spark.createDataFrame([("a", None, 1), ("b", "z", 3), (None, "n", 5)], df.schema)
    )


def test_last_row_wins_for_a_pair_key(spark, rows):
    df = spark.createDataFrame([(1, "d", 10.0, 1), (1, "d", None, 2), (2, "d", 5.0, 3)],
                               "t INT, k STRING, v DOUBLE, o INT")
    assert rows(dedupe.keep_last(df, ("t", "k"), "o")) == [(1, "d", None, 2), (2, "d", 5.0, 3)]


def test_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    first = dedupe.keep_first(df, "k", "id")
    assert first.count() == 20_001
    assert first.where("k = 'hot'").first()["id"] == 0


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a INT, b INT")
    assert rows(dedupe.duplicate_keys(df, ("a", "b"))) == [(1, 1, 2), (None, 1, 2)]
    assert dedupe.duplicate_key_count(df, ("a", "b")).first()[0] == 2


@pytest.fixture
def sides(spark):
    ddl = "k INT, v STRING, made TIMESTAMP, changed TIMESTAMP"
    target = spark.createDataFrame([(1, "a", DAY, DAY), (2, "b", DAY, DAY)], ddl)
    new = dt.datetime(2024, 2, 1)
    source = spark.createDataFrame([(2, "B", new, new), (3, None, new, new)], ddl)
    return target, source


def test_upsert(spark, sides, rows):
    target, source = sides
    merged = merge.upsert(target, source, ["k"])
    assert merged.columns == target.columns
    assert rows(merged, "k", "v") == [(1, "a"), (2, "B"), (3, None)]


def test_upsert_keeps_and_stamps(spark, sides):
    target, source = sides
    merged = merge.upsert(target, source, ["k"], keep=["made"], on_update=["changed"])
    got = {r.k: r for r in merged.collect()}
    assert (got[2].v, got[2].made) == ("B", DAY)  # an update keeps the creation time
    assert got[2].changed > dt.datetime(2025, 1, 1)  # and stamps the change
    assert got[3].made == got[3].changed == dt.datetime(2024, 2, 1)  # an insert takes both
    assert (got[1].made, got[1].changed) == (DAY, DAY)


def test_insert_ignore_and_probes(spark, sides, rows):
    target, source = sides
    assert rows(merge.insert_ignore(target, source, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, None)]
    assert rows(merge.known_keys(source, target, ["k"]), "k") == [(2,)]
    assert rows(merge.new_keys(source, target, ["k"]), "k") == [(3,)]


# --- quantiles -----------------------------------------------------------------------


def doubles(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "temp DOUBLE")


def test_percentiles_interpolate(spark):
    df = doubles(spark, [1, 2, 3, 4, 10, None, float("nan")])
    assert quantiles.quantiles(df, "temp", (0.05, 0.95)) == pytest.approx([1.2, 8.8])
    assert quantiles.quantiles(doubles(spark, []), "temp", (0.5,)) == [None]


def test_trim_keeps_rows_at_the_bounds(spark, rows):
    df = doubles(spark, range(101))  # p05 = 5, p95 = 95 exactly
    kept = [r[0] for r in rows(quantiles.percentile_trim(df))]
    assert (min(kept), max(kept), len(kept)) == (5.0, 95.0, 91)
    report = quantiles.trim_report(df, quantiles.quantiles(df, "temp", (0.05, 0.95))).first()
    assert (report.rows_before, report.rows_after) == (101, 91)
    assert (report.min_before, report.max_before, report.min_after, report.max_after) == (0, 100, 5, 95)


def test_trim_of_nothing(spark):
    assert quantiles.percentile_trim(doubles(spark, [None])).count() == 0


@pytest.mark.parametrize(
    ("shape", "limit"),
    [("uniform", 40), ("uniform", 1), ("heavy_ties", 2), ("two_lumps", 10), ("exponents", 4), ("signs", 1)],
)
def test_rank_search_equals_numpy(spark, shape, limit):
    rng = np.random.default_rng(3)
    data = {
        "uniform": rng.uniform(-50, 50, 800),
        "heavy_ties": np.concatenate([np.full(500, 7.0), rng.uniform(0, 10, 300)]),
        "two_lumps": np.concatenate([np.full(400, 1.0), np.full(300, 9.0), rng.uniform(2, 8, 100)]),
        "exponents": np.exp(rng.uniform(-300, 300, 400)),
        "signs": np.concatenate([-np.exp(rng.uniform(-5, 600, 50)), [0.0, -0.0, 5e-324, 1.7e308]]),
    }[shape]
    probabilities = (0.0, 0.05, 0.5, 0.95, 1.0)
    got = quantiles.quantiles(doubles(spark, data), "temp", probabilities, row_limit=limit)
    assert got == pytest.approx(list(np.quantile(data, probabilities)), rel=1e-12)


# --- windows over time, ranking, statistics ----------------------------------------------


def stamped(spark, times):
    return spark.createDataFrame([(t,) for t in times], "noted_date TIMESTAMP_NTZ")


def test_last_n_days_includes_the_edge(spark, rows):
    newest = dt.datetime(2024, 1, 20, 12)
    edge = newest - dt.timedelta(days=7)
    df = stamped(spark, [newest, edge, edge - dt.timedelta(microseconds=1), None])
    assert rows(recent.last_n_days(df, 7)) == [(edge,), (newest,)]
    assert rows(recent.last_n_days(df, 7, newest=newest)) == [(edge,), (newest,)]
    assert rows(recent.last_n_days(df, 30, cap_days=7)) == [(edge,), (newest,)]
    assert recent.last_n_days(df, 30).count() == 3
    assert recent.last_n_days(df, -1).count() == 0
    assert recent.last_n_days(df.where("noted_date IS NULL"), 7).count() == 0


@pytest.fixture
def daily(spark):
    means = {1: 10.0, 2: 30.0, 3: 30.0, 4: 20.0, 5: 5.0, 6: 12.0, 7: 10.0}
    return spark.createDataFrame(
        [(dt.date(2024, 1, d), t) for d, t in means.items()], "date DATE, avg_temp DOUBLE"
    )


def test_extremes_break_ties_by_date(spark, daily, rows):
    extremes = ranking.temperature_extremes(daily, 3)
    assert [tuple(r) for r in ranking.extremes_of_type(extremes, "hot").collect()] == [
        (dt.date(2024, 1, 2), 30.0), (dt.date(2024, 1, 3), 30.0), (dt.date(2024, 1, 4), 20.0),
    ]
    assert [r.date.day for r in ranking.extremes_of_type(extremes, "cold").collect()] == [5, 1, 7]
    assert rows(extremes, "type", "rank") == [(t, n) for t in ("cold", "hot") for n in (1, 2, 3)]


def test_top_days_of_fewer_days(spark, daily):
    assert ranking.top_days(daily.limit(2), 5, "avg_temp", "date").count() == 2


@pytest.fixture
def readings(spark):
    return spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 1, 1), 10.0, "d1", "b1"),
            (dt.datetime(2024, 1, 1, 2), 20.0, "d2", "b1"),
            (dt.datetime(2024, 1, 2, 3), None, "d1", "b2"),
            (dt.datetime(2024, 1, 3, 4), 60.0, "d1", "b1"),
        ],
        "noted_date TIMESTAMP_NTZ, temperature DOUBLE, device_id STRING, batch_id STRING",
    )


def test_summaries(spark, readings, rows):
    day = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    assert rows(summaries.daily_summary(readings, value="temperature")) == [
        (day[0], 15.0, 10.0, 20.0, 2), (day[1], None, None, None, 1), (day[2], 60.0, 60.0, 60.0, 1),
    ]
    first, last = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 3, 4)
    assert tuple(summaries.table_stats(readings, value="temperature").first()) == (
        4, 3, first, last, 30.0, 10.0, 60.0,
    )
    assert tuple(summaries.load_stats(readings).first()) == (first, last, 2, 30.0)
    assert summaries.load_stats(readings, approximate=True).first().device_count == 2
    assert tuple(summaries.day_span(readings).first()) == (3, day[0], day[2])
    assert tuple(summaries.date_range(readings).first()) == (first, last)
    assert [tuple(r) for r in summaries.batch_days(readings, "b1", 1).collect()] == [(day[2], 1)]
    assert tuple(summaries.batch_stats(readings, "b1").first()) == (30.0, 10.0, 60.0)
    assert tuple(summaries.batch_stats(readings, "none").first()) == (None, None, None)


def test_stats_of_an_empty_table(spark, readings):
    got = summaries.table_stats(readings.where("false"), value="temperature").first()
    assert (got.total_records, got.total_days, got.avg_temp) == (0, 0, None)


def test_first_seen_values(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "v STRING, o INT")
    assert [r[0] for r in summaries.first_seen_values(df, "v", "o", 3).collect()] == ["b", "a", None]


# --- profile, checks, sample ------------------------------------------------------------


def test_null_profile(spark, readings):
    got = {r.column_name: (r.data_type, r.row_count, r.null_count) for r in profile.null_profile(readings).collect()}
    assert got["temperature"] == ("double", 4, 1)
    assert got["device_id"] == ("string", 4, 0)
    assert profile.first_rows(readings, 2).count() == 2


def test_load_quality(spark, readings):
    again = readings.unionByName(readings.where("batch_id = 'b2'"))
    assert tuple(profile.load_quality(readings).first()) == (4, 3, 2, 0)
    assert tuple(profile.load_quality(again).first()) == (5, 3, 2, 1)
    assert tuple(profile.load_quality(again, key=("device_id",)).first()) == (5, 3, 2, 1)


def test_sample_is_fixed_by_its_seed(spark, rows):
    df = spark.range(5000)
    first = rows(sampling.seeded_sample(df, 100, 42, ["id"]))
    assert first == rows(sampling.seeded_sample(df.repartition(7), 100, 42, ["id"]))
    assert len(set(first)) == 100
    assert first != rows(sampling.seeded_sample(df, 100, 123, ["id"]))
    assert sampling.seeded_sample(df, 9999, 42, ["id"]).count() == 5000
    everything = df.withColumn("d", F.md5(F.concat_ws("|", F.lit("42"), F.col("id").cast("string"))))
    assert first == rows(everything.orderBy("d").limit(100).select("id"))
