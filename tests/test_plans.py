"""What Catalyst makes of the queries: no Python, pruned scans, bounded sorts."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from millrace.operators import dedupe, marts, merge, quantiles, ranking, recent, summaries
from millrace.plans import replication
from millrace.sinks import tables as tb
from workload import inputs
from workload.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"

# These load tables as they run; the rest only describes a result.
LAZY = [
    n for n in REGISTRY
    if not re.search(r"load_table|_of_|processing|files|csv|slice|appended|inserted", n)
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{FOLDER}/events.parquet")


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(REGISTRY[name](spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_top_days_never_sort_everything(events):
    daily = summaries.daily_mean(events.select(F.to_date("ts").alias("noted_date"), F.col("value").alias("temp")))
    assert "TakeOrderedAndProject" in plan(ranking.top_days(daily))
    extremes = plan(ranking.temperature_extremes(summaries.daily_summary(events, "ts", "value")))
    assert extremes.count("TakeOrderedAndProject") == 2


def test_summary_reads_two_columns(events):
    text = plan(summaries.daily_summary(events, "ts", "value"))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text
    assert "partial_avg" in text


def test_day_filter_reaches_the_scan(events):
    sessions = events.select(
        F.col("ts").alias("start_time"), F.col("user_id").cast("string").alias("user_id"),
        F.lit(1).alias("session_duration_seconds"), F.array(F.lit("a")).alias("actions"),
        F.array("event_type").alias("pages_visited"),
    )
    text = plan(marts.user_activity(sessions, dt.date(2024, 1, 3)))
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00), LessThan(ts,2024-01-04T00:00)" in text


def test_trim_bounds_reach_the_scan(events):
    trimmed = quantiles.percentile_trim(events.withColumnRenamed("value", "temp"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(value,", plan(trimmed))


def test_cutoff_is_one_scalar(events):
    text = plan(recent.last_n_days(events, 7, "ts"))
    assert "Subquery" in text and "Join" not in text


def test_dedupe_combines_before_the_shuffle(events):
    text = plan(dedupe.keep_first(events, "user_id", "event_id"))
    assert "partial_min_by" in text and text.count("Exchange") == 1


def test_distinct_pages_are_grouped_by_page_first(events):
    sessions = events.select(
        F.col("ts").alias("start_time"), F.col("user_id").cast("string").alias("user_id"),
        F.lit(1).alias("session_duration_seconds"), F.array(F.lit("a")).alias("actions"),
        F.array("event_type").alias("pages_visited"),
    )
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(marts.user_activity(sessions)))
    assert any("_page" in e for e in exchanges)


def test_plain_upsert_moves_keys_of_the_source_only(events):
    merged = merge.upsert(events.where("event_id < 100"), events, ["event_id"])
    text = plan(merged)
    assert "LeftAnti" in text and "FullOuter" not in text
    kept = plan(merge.upsert(events, events, ["event_id"], keep=["ts"]))
    assert "FullOuter" not in kept and "LeftAnti" in kept


def test_replication_reads_and_shuffles_the_batch_alone(spark, database):
    collection = replication.SESSIONS
    spec = collection.table.in_database(database)
    documents = inputs.session_documents(spark, FOLDER)
    text = plan(tb.conform(replication.transform(documents, collection), spec))
    assert "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1
    replication.replicate_documents(spark, documents, collection, spec)
    replication.replicate_documents(spark, documents.limit(5), collection, spec)
    # Readers filter the base by the keys of the runs and group rows of those keys.
    text = plan(tb.read(spark, spec))
    assert "LeftAnti" in text and "LeftSemi" in text and "FullOuter" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_quality_counts_copy_no_rows(events):
    from millrace.operators.profile import load_quality

    text = plan(load_quality(events, ("ts", "user_id"), "ts", "user_id"))
    assert "Expand" not in text
