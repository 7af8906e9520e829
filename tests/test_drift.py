"""Tables made by an older spec, and column types inferred from cells."""

from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import infer
from millrace.sinks import arrivals
from millrace.sinks import tables as tb
from millrace.sources.delimited import read_delimited


def test_new_columns_are_added_and_filled_from_then_on(spark, database, rows):
    older = tb.TableSpec(f"{database}.t", "k INT, v STRING", ("k",))
    newer = replace(older, ddl="k INT, extra DOUBLE, v STRING, tags ARRAY<STRING>")
    tb.create(spark, older)
    tb.append(spark.createDataFrame([(1, "a")], "k INT, v STRING"), older)
    tb.create(spark, newer)
    tb.append(spark.createDataFrame([(2, 0.5, "b", ["x"])], newer.ddl), newer)
    assert rows(tb.read(spark, newer), "k", "extra", "v", "tags") == [(1, None, "a", None), (2, 0.5, "b", ["x"])]
    tb.upsert_all(spark.createDataFrame([(1, 1.5, "A", [])], newer.ddl), newer)
    assert rows(tb.read(spark, newer), "k", "extra", "v", "tags") == [(1, 1.5, "A", []), (2, 0.5, "b", ["x"])]


@pytest.mark.parametrize("ddl", ["k INT", "k INT, v INT", "k SMALLINT, v STRING", "k BIGINT, v STRING"])
def test_fewer_columns_and_other_types_are_refused(spark, database, ddl):
    older = tb.TableSpec(f"{database}.t", "k INT, v STRING", ("k",))
    tb.create(spark, older)
    with pytest.raises(tb.SchemaDrift):
        tb.create(spark, replace(older, ddl=ddl))
    tb.create(spark, replace(older, ddl="K INT, V STRING"))


def test_partitioned_and_merged_tables_get_columns_too(spark, database, rows):
    older = tb.TableSpec(f"{database}.p", "k INT, day DATE", ("k",), partition="day")
    tb.create(spark, older)
    newer = replace(older, ddl="k INT, v STRING, day DATE")
    tb.upsert_partitions(spark.sql("SELECT 1 AS k, DATE'2024-01-01' AS day"), older)
    tb.create(spark, newer)
    tb.upsert_partitions(spark.sql("SELECT 2 AS k, 'b' AS v, DATE'2024-01-01' AS day"), newer)
    assert rows(tb.read(spark, newer), "k", "v") == [(1, None), (2, "b")]
    merged = arrivals.Merged(tb.TableSpec(f"{database}.m", "k INT, v STRING", ("k",)))
    arrivals.create(spark, merged)
    arrivals.upsert(spark.sql("SELECT 1 AS k, 'a' AS v"), merged)
    wider = replace(merged, spec=replace(merged.spec, ddl="k INT, v STRING, w INT"))
    arrivals.create(spark, wider)
    arrivals.upsert(spark.sql("SELECT 2 AS k, 'b' AS v, 7 AS w"), wider)
    assert rows(tb.read(spark, wider.spec), "k", "v", "w") == [(1, "a", None), (2, "b", 7)]
    arrivals.fold(spark, wider)
    assert rows(tb.read(spark, wider.spec), "k", "v", "w") == [(1, "a", None), (2, "b", 7)]


CELLS = {
    "bigint": [["1", "-2", None], ["+7", " 8 "], ["9223372036854775807"]],
    "double": [["1", "2.5"], ["1e3"], ["inf", "1"], ["9223372036854775808", "1"], [None, None], []],
    "boolean": [["True", "false", None]],
    "string": [["1", "x"], ["True", "1"], ["1d"], ["0x1"], ["", "1"]],
}


@pytest.mark.parametrize(("kind", "cells"), [(k, c) for k, many in CELLS.items() for c in many])
def test_types_of_cells(spark, kind, cells):
    df = spark.createDataFrame([(c,) for c in cells], "c STRING")
    assert infer.inferred_types(df) == {"c": kind}


@given(st.permutations([infer.WHOLE, infer.NUMBER, infer.TRUTH, infer.TEXT, 0]), st.integers(0, 5))
@settings(deadline=None)
def test_kinds_add_up_in_any_order(kinds, cut):
    def merged(values):
        found = 0
        for v in values:
            found |= v
        return found

    assert infer.type_of(merged([merged(kinds[:cut]), merged(kinds[cut:])])) == infer.type_of(merged(kinds)) == "string"


def test_a_late_bad_cell_counts_for_any_partitioning(spark):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("a"), F.when(F.col("id") == 4999, "late").otherwise(F.col("id").cast("string")).alias("b")
    )
    for parts in (1, 7, 40):
        assert infer.inferred_types(df.repartition(parts)) == {"a": "bigint", "b": "string"}
    plan = df.agg(*[F.bit_or(infer.cell_kind(F.col(c))) for c in df.columns])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_files_are_typed_by_their_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,x,flag,name\n1,NA,True,a\n2,0.5,,b\n")
    (tmp_path / "b.csv").write_text("n,x,flag,name\n3,7,False,4\n")
    df = read_delimited(spark, str(tmp_path), order="_ord", infer=True)
    assert dict(df.drop("_ord").dtypes) == {"n": "bigint", "x": "double", "flag": "boolean", "name": "string"}
    assert sorted(map(tuple, df.drop("_ord").collect())) == [(1, None, True, "a"), (2, 0.5, None, "b"), (3, 7.0, False, "4")]
