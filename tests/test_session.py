import pytest

from millrace.session import materialize, pin_semantics, shared_dir, shuffle_settings, shuffles_sized_for


def test_shuffle_sizes():
    name = "spark.sql.shuffle.partitions"
    assert shuffle_settings(0)[name] == "200"
    assert shuffle_settings(1 << 40)[name] == "4096"
    assert shuffle_settings(100 << 40)[name] == "100000"


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_a_written_table_has_no_lineage(spark):
    stored = materialize(spark.range(100).repartition(4), "t")
    assert stored.count() == 100
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_settings_that_change_results_are_pinned(spark):
    zone = "spark.sql.session.timeZone"
    spark.conf.set(zone, "Asia/Tokyo")
    pin_semantics(spark)
    assert spark.conf.get(zone) == "UTC"
    with pytest.raises(Exception):
        spark.sql("SELECT CAST('x' AS INT)").collect()


def test_shuffles_follow_the_size_of_the_sources(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    large = spark.range(20_000_000_000)  # 160 GB by its statistics
    with shuffles_sized_for(large):
        assert int(spark.conf.get(name)) > 500
    assert spark.conf.get(name) == before
    with shuffles_sized_for(spark.range(10)):
        assert spark.conf.get(name) == before
