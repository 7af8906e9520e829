import datetime as dt
from decimal import Decimal

import pytest

from millrace.operators.marts import support_efficiency, user_activity
from millrace.plans import marts as plans
from millrace.sinks import tables as tb

DAY = dt.date(2024, 3, 5)
SESSION_DDL = (
    "session_id STRING, user_id STRING, start_time TIMESTAMP, session_duration_seconds INT, "
    "pages_visited ARRAY<STRING>, actions ARRAY<STRING>"
)


@pytest.fixture
def sessions(spark):
    at = dt.datetime(2024, 3, 5, 10)
    return spark.createDataFrame(
        [
            ("s1", "u1", at, 600, ["/a", "/b"], ["x", "y", "z"]),
            ("s2", "u1", dt.datetime(2024, 3, 5, 23, 59, 59), 1200, [], ["x", "y"]),
            ("s3", "u2", at, 60, None, None),
            ("s4", "u1", at + dt.timedelta(days=1), 5, ["/c"], ["x"]),
        ],
        SESSION_DDL,
    )


def test_activity_counts_page_rows(sessions, rows):
    assert rows(user_activity(sessions, DAY)) == [
        (DAY, "u1", 3, Decimal("800.00"), 8, 2),
        (DAY, "u2", 1, Decimal("60.00"), 0, 0),
    ]


def test_activity_by_session(sessions, rows):
    assert rows(user_activity(sessions, DAY, grain="session")) == [
        (DAY, "u1", 2, Decimal("900.00"), 5, 2),
        (DAY, "u2", 1, Decimal("60.00"), 0, 0),
    ]
    with pytest.raises(ValueError):
        user_activity(sessions, DAY, grain="user")


def test_activity_of_all_days(sessions, rows):
    assert len(rows(user_activity(sessions))) == 3


def test_average_is_rounded_half_up(spark, rows):
    df = spark.createDataFrame(
        [(f"s{i}", "u", dt.datetime(2024, 3, 5), s, [], []) for i, s in enumerate([1] + [0] * 7)],
        SESSION_DDL,
    )  # mean 0.125
    assert rows(user_activity(df, DAY))[0][3] == Decimal("0.13")


@pytest.fixture
def tickets(spark):
    at = dt.datetime(2024, 3, 1)
    return spark.createDataFrame(
        [
            ("payment", "resolved", at, 3600),
            ("payment", "resolved", dt.datetime(2024, 3, 5, 23, 59), 5400),
            ("payment", "open", at, None),
            ("payment", "resolved", dt.datetime(2024, 3, 6), 60),
            ("other", "in_progress", at, None),
        ],
        "issue_type STRING, status STRING, created_at TIMESTAMP, resolution_time_seconds INT",
    )


def test_support_efficiency(tickets, rows):
    assert rows(support_efficiency(tickets, DAY)) == [
        (DAY, "other", "in_progress", 1, None, 1),
        (DAY, "payment", "open", 1, None, 1),
        (DAY, "payment", "resolved", 2, Decimal("1.25"), 0),
    ]


def test_slices_are_replaced(spark, database, sessions, rows):
    source = tb.TableSpec(name=f"{database}.s", ddl=SESSION_DDL)
    mart = plans.ACTIVITY.in_database(database)
    tb.create(spark, source)
    tb.append(sessions, source)
    for day in (DAY, DAY + dt.timedelta(days=1), DAY):
        plans.build_user_activity(spark, day, source, mart)
    got = rows(tb.read(spark, mart), "activity_date", "user_id")
    assert got == [(DAY, "u1"), (DAY, "u2"), (DAY + dt.timedelta(days=1), "u1")]

    # A day that lost its sessions ends up empty, other days stay.
    tb.replace_all(sessions.where("session_id = 's4'"), source)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # must not matter
    plans.build_user_activity(spark, DAY, source, mart)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert rows(tb.read(spark, mart), "activity_date") == [(DAY + dt.timedelta(days=1),)]


def test_support_slice(spark, database, tickets, rows):
    source = tb.TableSpec(
        name=f"{database}.t",
        ddl="issue_type STRING, status STRING, created_at TIMESTAMP, resolution_time_seconds INT",
    )
    mart = plans.SUPPORT.in_database(database)
    tb.create(spark, source)
    tb.append(tickets, source)
    for _ in range(2):
        plans.build_support_efficiency(spark, DAY, source, mart)
    assert tb.read(spark, mart).count() == 3
