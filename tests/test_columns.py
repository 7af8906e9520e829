import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import coerce, headers, identity, text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def frame(spark, items, ddl="x STRING"):
    return spark.createDataFrame([(i,) for i in items], ddl)


def test_strip_removes_what_python_strips(spark):
    items = [" In ", "\t\n x 　", " a b\x1f", "", "   ", None]
    got = values(frame(spark, items), text.strip("x"))
    assert got == [i.strip() if i is not None else None for i in items]


def test_normalised_equality(spark):
    assert values(frame(spark, [" In ", "OUT", None, "in"]), text.normalised("x")) == [
        "in", "out", None, "in",
    ]


def test_fixed_decimals_match_python(spark):
    numbers = [0.125, 0.375, 2.675, 27.411167512690355, -0.001, 12345.675, 1e6, 30.0]
    got = values(frame(spark, numbers, "x DOUBLE"), text.fixed_decimals("x", 2))
    assert got == [f"{n:.2f}" for n in numbers]
    assert values(frame(spark, numbers, "x DOUBLE"), text.fixed_decimals("x", 1)) == [
        f"{n:.1f}" for n in numbers
    ]


def test_error_text_is_cut_at_500(spark):
    assert values(frame(spark, ["e" * 600]), text.error_text("x")) == ["e" * 500]


def test_json_text_equals_python_dumps(spark):
    rng = random.Random(7)
    alphabet = 'ab "\\/\n\r\t\b\f\x00\x1f\x7fé我\U0001f600<> '
    lists = [["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(rng.randint(1, 4))]
             for _ in range(200)]
    lists += [[r"é literal", "\\u00ABC"], ["plain"], [None, "x"]]
    got = values(frame(spark, lists, "x ARRAY<STRING>"), text.json_string_array("x"))
    assert got == [json.dumps(i) for i in lists]


def test_json_text_of_empty_or_missing_list_is_null(spark):
    assert values(frame(spark, [[], None], "x ARRAY<STRING>"), text.json_string_array("x")) == [None, None]


def test_json_document_keeps_missing_fields(spark):
    df = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS STRING)) AS x UNION ALL SELECT NULL")
    assert set(values(df, text.json_document("x"))) == {'{"a":1,"b":null}', None}


# --- headers ---------------------------------------------------------------------


def named(spark, *columns):
    return spark.createDataFrame([("v",) * len(columns)], list(columns))


def test_standardise(spark):
    df = named(spark, " Noted Date ", "Out/In")
    assert headers.standardise(df).columns == ["noted_date", "out/in"]
    assert headers.standardise(df, slash=True).columns == ["noted_date", "out_in"]


def test_processing_names(spark):
    df = named(spark, "id", "my_noted_date", "temp_c", "out/in")
    assert headers.canonical_for_processing(df).columns == ["id", "noted_date", "temp", "out/in"]
    df = named(spark, "sensor_out_in")
    assert headers.canonical_for_processing(df).columns == ["out/in"]


def test_aliases_fill_missing_names_only(spark):
    assert headers.apply_aliases(named(spark, "date", "temperature")).columns == ["noted_date", "temp"]
    assert headers.apply_aliases(named(spark, "date", "noted_date")).columns == ["date", "noted_date"]


def test_load_names(spark):
    df = named(spark, "id", "room_id_id", "noted_date", "temperature", "out_in")
    assert headers.canonical_for_load(df).columns == ["id", "room_id_id", "noted_date", "temp", "out_in"]
    df = named(spark, "outside")
    assert headers.canonical_for_load(df).columns == ["outside"]
    assert headers.canonical_for_load(df, loose=True).columns == ["out_in"]


def test_two_columns_for_one_name_are_refused(spark):
    with pytest.raises(headers.HeaderCollision):
        headers.canonical_for_load(named(spark, "noted_date", "update"))
    with pytest.raises(headers.HeaderCollision):
        headers.canonical_for_processing(named(spark, "temp_c", "temp"))


# --- coercion --------------------------------------------------------------------


def test_reading_time_is_month_first(spark):
    df = frame(spark, ["13-12-2018 09:30", "08-12-2018 09:30", "junk", None])
    got = values(df, coerce.to_reading_time("x").cast("string"))
    assert got == [None, "2018-08-12 09:30:00", None, None]
    assert coerce.drop_bad_dates(df, "x").count() == 1


def test_numbers(spark):
    items = ["12.5", " 7 ", "-1e2", ".5", "5.", "x", "", "NaN", "1d", "0x1p3", "1_0", "inf", None]
    got = values(frame(spark, items), coerce.to_number("x"))
    assert got == [12.5, 7.0, -100.0, 0.5, 5.0] + [None] * 6 + [float("inf"), None]
    assert coerce.drop_bad_numbers(frame(spark, items), "x").count() == 6


def test_nan_becomes_null(spark):
    df = frame(spark, [float("nan"), 1.0, None], "x DOUBLE")
    assert values(df, coerce.null_if_nan("x")) == [None, 1.0, None]


def test_iso_times_are_utc_and_bad_ones_fail(spark):
    df = frame(spark, ["2024-01-01T10:00:00+03:00", "2024-01-01T07:00:00Z", "2024-01-01T07:00:00"])
    assert set(values(df, coerce.iso_to_utc("x").cast("string"))) == {"2024-01-01 07:00:00"}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        frame(spark, ["yesterday"]).select(coerce.iso_to_utc("x")).collect()


def test_durations_and_lengths(spark):
    df = spark.sql(
        "SELECT * FROM VALUES "
        "('resolved', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-01 01:00:00.9', array('a')),"
        "('open', TIMESTAMP'2024-01-01 00:00:00', TIMESTAMP'2024-01-02 00:00:00', NULL),"
        "('closed', NULL, TIMESTAMP'2024-01-02 00:00:00', array()) AS t(status, a, b, m)"
    )
    got = df.select(
        coerce.seconds_between("a", "b"), coerce.resolution_seconds("status", "a", "b"),
        coerce.length_or_zero("m"),
    ).collect()
    assert [tuple(r) for r in got] == [(3600, 3600, 1), (86400, None, 0), (None, None, 0)]


# --- labels ----------------------------------------------------------------------


def test_device_ids(spark):
    df = spark.createDataFrame(
        [
            ("__export__.temp_log_196134_bd201015", "Room Admin", 0),
            ("plain-identifier", None, 1),
            ("a_abcdefghijklmnopqrst", "r", 2),
            (None, "Room Administration", 3),
            (None, None, 4),
        ],
        "id STRING, room STRING, row BIGINT",
    )
    assert values(df, identity.device_id_full("id", "room", "row")) == [
        "device_bd201015", "device_plain-iden", "device_abcdefghij", "room_Room Admin", "default_4",
    ]
    assert values(df, identity.device_id_full("id", None, "row"))[3] == "default_3"
    assert values(df, identity.device_id_incremental("id", "row")) == [
        "dev_bd201015", "dev_plain-identifie", "dev_abcdefghijklmno", "row_3", "row_4",
    ]


def test_location(spark):
    df = frame(spark, [" In ", "a location too long", None, "  "])
    assert values(df, identity.location("x")) == ["In", "a location", "unknown", ""]


def test_text_helpers(spark):
    df = frame(spark, ["", "a", None])
    assert values(df, text.blank_to_null(F.col("x"))) == [None, "a", None]
