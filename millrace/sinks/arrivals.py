"""Keyed tables kept as a base and the batches that arrived since.

An upsert costs what its batch costs: the batch is written as one run, a partition of
the table ``<name>_runs``, and appears in one catalog call. Run 0 is the base. The view
``<name>`` puts them together by key, so readers of any session see one table. Rows of
the base whose key is in no run come from a filter on the base; only keys of the runs
are grouped.

Runs are folded into the base when together they reach ``FOLD_SHARE`` of its bytes and
``FOLD_BYTES``, or ``FOLD_RUNS`` in number: the view's rows are written aside and one catalog call makes
them the base; then the folded runs are taken away. A row of the base knows the number
of the run it came from, and a run that is met again after its fold changes nothing, so
a fold that stops at any point loses and repeats nothing. A reader should be planned
before the switch or after it, and finish before the second fold after it started.

By default the newest run's row of a key holds. With ``first_by``, hidden columns that
say where a row stood, the row that stands first holds, whichever run brought it.
``keep`` columns stay those of the key's first arrival; ``on_update`` columns become the
time of the run when its row takes the place of an older one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import remove
from millrace.sinks import tables as tb
from millrace.sinks.tables import TableSpec

FOLD_SHARE = 0.5
FOLD_BYTES = 32 * 1024 * 1024
FOLD_RUNS = 64
RUN = "_run"
HIDDEN = "_seq BIGINT, _stamp TIMESTAMP"


@dataclass(frozen=True)
class Merged:
    """A table spec with a key, and how rows of one key are put together."""

    spec: TableSpec
    keep: tuple[str, ...] = ()
    on_update: tuple[str, ...] = ()
    first_by: str = ""  # DDL of the hidden columns

    @property
    def stored(self) -> TableSpec:
        """Layout of the runs: the table's columns and the hidden ones."""
        hidden = ", ".join(x for x in (self.spec.ddl, self.first_by, HIDDEN) if x)
        defaults = {**self.spec.defaults, "_stamp": "current_timestamp()"}
        return replace(self.spec, name=f"{self.spec.name}_runs", ddl=hidden, defaults=defaults)

    @property
    def place(self) -> list[str]:
        return StructType.fromDDL(self.first_by).names if self.first_by else []


def _list(names: Iterable[str], prefix: str = "") -> str:
    return ", ".join(f"{prefix}`{n}`" for n in names)


def merged_sql(table: Merged, hidden: bool = False, up_to: int | None = None) -> str:
    """The rows of base and runs by key; with their hidden columns for a fold of the runs ``up_to``."""
    spec, names = table.spec, table.spec.schema.names
    stored = [*names, *table.place, "_seq", "_stamp"]
    base = f"(SELECT * FROM {table.stored.name} WHERE {RUN} = 0)"
    newer = f"{RUN} > 0" if up_to is None else f"{RUN} BETWEEN 1 AND {up_to}"
    runs = f"(SELECT * FROM {table.stored.name} WHERE {newer})"
    same = " AND ".join(f"b.`{k}` = r.`{k}`" for k in spec.key)
    order = [f"`{c}`" for c in table.place] + ["-_base", "-_seq"] if table.first_by else ["-_seq", "-_base"]
    shown = []
    for name in names:
        if name in spec.key:
            value = f"`{name}`"
        elif name in table.keep:
            value = f"first.`{name}`"
        elif name in table.on_update:
            kind = spec.schema[name].dataType.simpleString()
            value = f"CASE WHEN won._seq > first._seq THEN CAST(won._stamp AS {kind}) ELSE won.`{name}` END"
        else:
            value = f"won.`{name}`"
        shown.append(f"{value} AS `{name}`")
    more = [*table.place, "_seq", "_stamp"] if hidden else []
    shown += [f"won.`{c}` AS `{c}`" for c in more]
    others = [c for c in stored if c not in spec.key]
    return f"""
SELECT {_list([*names, *more], "b.")} FROM {base} AS b LEFT ANTI JOIN {runs} AS r ON {same}
UNION ALL
SELECT {", ".join(shown)} FROM (
    SELECT {_list(spec.key)},
           min_by(struct({_list(others)}), struct({", ".join(order)})) AS won,
           min_by(struct({_list([*table.keep, "_seq"])}), struct(-_base, _seq)) AS first
    FROM (SELECT {_list(stored, "b.")}, 1 AS _base FROM {base} AS b LEFT SEMI JOIN {runs} AS r ON {same}
          UNION ALL
          SELECT {_list(stored)}, 0 AS _base FROM {runs})
    GROUP BY {_list(spec.key)})
"""


def create(spark: SparkSession, table: Merged) -> None:
    """Runs and view, where absent."""
    tb.check_warehouse(spark)
    database, _, name = table.stored.name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if not spark.catalog.tableExists(table.stored.name):
        place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored.schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.stored.name} ({columns}, {RUN} BIGINT) USING parquet "
            f"PARTITIONED BY ({RUN}) LOCATION '{place.rstrip('/')}/{name}'"
        )
    added = tb.reconcile(spark, table.stored.name, table.stored.schema, besides=(RUN,))
    if added or not spark.catalog.tableExists(table.spec.name):
        spark.sql(f"CREATE OR REPLACE VIEW {table.spec.name} AS {merged_sql(table)}")


def run_numbers(spark: SparkSession, table: Merged) -> list[int]:
    """The runs that are not folded."""
    shown = spark.sql(f"SHOW PARTITIONS {table.stored.name}").collect()
    return sorted(n for n in (int(r[0].split("=")[1]) for r in shown) if n)


def root(spark: SparkSession, table: Merged) -> str:
    return tb.location(spark, table.stored.name).rstrip("/")


def base(spark: SparkSession, table: Merged) -> str | None:
    """The folder of the base."""
    found = tb.partition_location(spark, replace(table.stored, partition=RUN), 0)
    return found and found.rstrip("/")


def _folders(spark: SparkSession, place: str) -> dict[str, int]:
    """Names of the folders there and the bytes they hold."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return {}
    found = store.listStatus(path)
    return {f.getPath().getName(): store.getContentSummary(f.getPath()).getLength() for f in found}


def _number(folder: str | None) -> int:
    """The run that a folder ``run-...`` holds, or the newest one in a folder ``state-...``."""
    return int(folder.rpartition("/")[2].split("-")[1]) if folder else 0


def upsert(df: DataFrame, table: Merged, check_key: bool = True) -> int:
    """Write ``df`` as a run and make it part of the table; returns its number of rows.

    ``df`` is read once. Its keys are unique, which is checked on the written keys
    unless the caller knows it. Rows that the spec refuses fail the job before anything
    is visible. Two loads of one table at the same time get different numbers.
    """
    spark, layout = df.sparkSession, table.stored
    rows, place = tb.conform(df, layout), root(spark, table)
    while True:
        numbers, state = run_numbers(spark, table), base(spark, table)
        number = max([_number(state), *numbers]) + 1
        folder = f"{place}/run-{number:012d}-{uuid.uuid4().hex}"
        tb.clustered(rows.withColumn("_seq", F.lit(number).cast("long")), layout).write.parquet(folder)
        stored = spark.read.schema(layout.schema).parquet(folder)
        count = stored.count()  # from the files' footers
        if not count:
            remove(spark, folder)
            return 0
        if check_key:
            tb.check_unique(stored, table.spec)
        try:
            # The first run of a table is its base as it stands.
            shown = number if state else 0
            spark.sql(f"ALTER TABLE {layout.name} ADD PARTITION ({RUN} = {shown}) LOCATION '{folder}'")
        except AnalysisException as error:  # another load took the number
            if "ALREADY_EXIST" not in (error.getCondition() or ""):
                raise
            rows = stored
            continue
        break
    if state and _due(spark, table, place, state, [*numbers, number]):
        fold(spark, table)
    return count


def _due(spark: SparkSession, table: Merged, place: str, state: str, numbers: list[int]) -> bool:
    if len(numbers) >= FOLD_RUNS:
        return True
    held, sizes = set(numbers), _folders(spark, place)
    arrived = sum(n for name, n in sizes.items() if name.startswith("run-") and _number(name) in held)
    return arrived >= max(FOLD_BYTES, FOLD_SHARE * sizes.get(state.rpartition("/")[2], 0))


def fold(spark: SparkSession, table: Merged) -> None:
    """Make base and runs the new base."""
    numbers, before = run_numbers(spark, table), base(spark, table)
    if not numbers:
        return
    layout, place = table.stored, root(spark, table)
    target = f"{place}/state-{numbers[-1]:012d}-{uuid.uuid4().hex}"
    merged = spark.sql(merged_sql(table, hidden=True, up_to=numbers[-1])).select(*layout.schema.names)
    tb.clustered(merged, layout).write.parquet(target)
    spark.sql(f"ALTER TABLE {layout.name} PARTITION ({RUN} = 0) SET LOCATION '{target}'")
    gone = ", ".join(f"PARTITION ({RUN} = {n})" for n in numbers)
    spark.sql(f"ALTER TABLE {layout.name} DROP IF EXISTS {gone}")
    _clean(spark, place, {target, before}, _number(before))


def _clean(spark: SparkSession, place: str, kept: set[str], folded: int) -> None:
    """Remove what the fold before the last one replaced, and folds that were stopped."""
    names = {k.rpartition("/")[2] for k in kept}
    for name in _folders(spark, place):
        if name.startswith(("run-", "state-")) and name not in names and _number(name) <= folded:
            remove(spark, f"{place}/{name}")
