"""Parquet tables in the catalog, and the ways jobs write them.

* Unpartitioned tables are replaced as a whole: the new rows go to the table's
  other folder, then ``ALTER TABLE ... SET LOCATION`` switches over in one
  catalog call. A failed write leaves the old rows in place, and a table can be
  rebuilt from itself. A reader should finish before the second replacement
  after it started, because two folders take turns.
* Partitioned tables are rewritten partition by partition: the new rows of a
  partition go to a folder of their own, then one catalog call makes it the
  partition's location. No session setting takes part, so loads of several tables,
  or of one session's threads, do not disturb each other.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.dedupe import duplicate_keys
from millrace.operators.merge import first_of_each, new_keys, upsert
from millrace.session import remove

FOLDERS = ("slot_a", "slot_b")


class KeyViolation(ValueError):
    """A table key would be held by more than one row."""


class SchemaDrift(ValueError):
    """A table in the catalog cannot hold what its spec declares."""


@dataclass(frozen=True)
class TableSpec:
    """What a table holds.

    ``defaults`` maps a column to the SQL of its default, ``checks`` the name of a rule
    to a condition that every row fulfils (one that is NULL counts as fulfilled).
    """

    name: str
    ddl: str
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    defaults: Mapping[str, str] = field(default_factory=dict)
    partition: str | None = None
    partition_from: str | None = None  # SQL over the other columns, if derived
    sort_within: tuple[str, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    def in_database(self, database: str) -> TableSpec:
        return replace(self, name=f"{database}.{self.name.rsplit('.', 1)[-1]}")


def check_warehouse(spark: SparkSession) -> None:
    """On a cluster the warehouse must be set: its default is a folder of the driver's machine."""
    context = spark.sparkContext
    if not (context.getConf().contains("spark.sql.warehouse.dir") or context.master.startswith("local")):
        raise ValueError("spark.sql.warehouse.dir must name a folder all executors share")


def create(spark: SparkSession, spec: TableSpec, location: str | None = None) -> None:
    """Create the table's database and the table, where absent."""
    if not location:
        check_warehouse(spark)
    database, _, _ = spec.name.rpartition(".")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = []
    for f in spec.schema.fields:
        column = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in spec.required or f.name in spec.key:
            column += " NOT NULL"
        if f.name in spec.defaults:
            column += f" DEFAULT {spec.defaults[f.name]}"
        columns.append(column)
    statement = f"CREATE TABLE IF NOT EXISTS {spec.name} ({', '.join(columns)}) USING parquet"
    if spec.partition:
        statement += f" PARTITIONED BY (`{spec.partition}`)"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)
    reconcile(spark, spec.name, spec.schema)


def reconcile(spark: SparkSession, name: str, declared: StructType, besides: Sequence[str] = ()) -> list[str]:
    """Give an older table the columns its spec has by now; the names of those added.

    Rows written before have NULL there. A table with a column that is not declared,
    or of another type, is refused: its rows would be cut or could not be read.
    ``besides`` are columns the table has apart from its spec.
    """
    held = {f.name.lower(): f for f in spark.table(name).schema.fields}
    wanted = {f.name.lower(): f for f in declared.fields}
    gone = [f.name for key, f in held.items() if key not in wanted and f.name not in besides]
    if gone:
        raise SchemaDrift(f"{name} has columns that are not declared: {', '.join(gone)}")
    for key, f in wanted.items():
        if key in held and held[key].dataType.simpleString() != f.dataType.simpleString():
            raise SchemaDrift(
                f"{name}.{f.name} is {held[key].dataType.simpleString()}, declared as {f.dataType.simpleString()}"
            )
    new = [f for key, f in wanted.items() if key not in held]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def read(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The table as it is now, also when another session has replaced its rows."""
    spark.catalog.refreshTable(spec.name)
    return spark.table(spec.name)


def _laid_out(df: DataFrame, spec: TableSpec, lenient: bool = False) -> list[Column]:
    """The table's columns from ``df``; a value that is not of its type is NULL if lenient, else an error."""
    derived = {spec.partition: spec.partition_from} if spec.partition_from else {}
    present = set(df.columns)
    columns: list[Column] = []
    for f in spec.schema.fields:
        if f.name in derived:
            value = F.expr(derived[f.name])
        elif f.name in present:
            value = F.col(f"`{f.name}`")
        else:
            value = F.expr(spec.defaults.get(f.name, "NULL"))
        same = f.name in present and df.schema[f.name].dataType == f.dataType
        typed = value.try_cast(f.dataType) if lenient and not same else value.cast(f.dataType)
        columns.append(typed.alias(f.name))
    return columns


def _refusals(spec: TableSpec) -> list[tuple[Column, str]]:
    """What the table refuses in a row that is laid out, each with its reason."""
    checked = [n for n in spec.schema.names if n in spec.required or n in spec.key]
    found = [(F.col(f"`{n}`").isNull(), f"{n} must not be NULL") for n in checked]
    return found + [(~F.expr(condition), name) for name, condition in spec.checks.items()]


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns in table order and type, defaults filled; rows the table refuses fail the job.

    The checks sit in a filter, so that key columns stay plain references and a
    merge can use the partitioning the rows already have.
    """
    rows = df.select(*_laid_out(df, spec))
    refusals = _refusals(spec)
    if not refusals:
        return rows
    refused = F.lit(None).cast("boolean")
    for condition, reason in refusals:
        found = F.when(condition, F.raise_error(F.lit(f"{spec.name}.{reason}")).cast("boolean"))
        refused = F.coalesce(refused, found)
    return rows.where(refused.isNull())


def with_reason(df: DataFrame, spec: TableSpec, reason: str = "_reason") -> DataFrame:
    """Rows as the table would hold them, and why it refuses them: NULL for those it takes.

    A value that is not of its column's type is a reason, too.
    """
    bad = []
    for f in spec.schema.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            value = F.col(f"`{f.name}`")
            wrong = value.isNotNull() & value.try_cast(f.dataType).isNull()
            bad.append(F.when(wrong, F.lit(f"{f.name} is not {f.dataType.simpleString().upper()}")))
    rows = df.select(*_laid_out(df, spec, lenient=True), F.coalesce(F.lit(None).cast("string"), *bad).alias("_untyped"))
    told = [F.when(condition, F.lit(text)) for condition, text in _refusals(spec)]
    return rows.withColumn(reason, F.coalesce("_untyped", *told)).drop("_untyped")


def check_unique(df: DataFrame, spec: TableSpec) -> None:
    if spec.key and duplicate_keys(df, spec.key).limit(1).count():
        raise KeyViolation(f"{spec.name}: key {spec.key} is not unique")


def location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE FORMATTED {name}")
    return described.where("col_name = 'Location'").first()["data_type"]


def clustered(df: DataFrame, spec: TableSpec) -> DataFrame:
    # A sort inside each task, no shuffle: row groups get narrow ranges, so
    # filters on these columns skip most of them.
    return df.sortWithinPartitions(*spec.sort_within) if spec.sort_within else df


def replace_all(df: DataFrame, spec: TableSpec, check_key: bool = True) -> None:
    """Replace every row of an unpartitioned table, all or nothing.

    The keys of the written files are counted before they become the table,
    reading the key columns only; ``check_key=False`` leaves that out.
    """
    if spec.partition:
        raise ValueError(f"{spec.name} is partitioned; replace its partitions")
    spark = df.sparkSession
    current = location(spark, spec.name).rstrip("/")
    root, _, last = current.rpartition("/")
    if last not in FOLDERS:
        root = current
    target = f"{root}/{FOLDERS[1] if last == FOLDERS[0] else FOLDERS[0]}"
    clustered(conform(df, spec), spec).write.mode("overwrite").parquet(target)
    if check_key:
        check_unique(spark.read.schema(spec.schema).parquet(target), spec)
    spark.sql(f"ALTER TABLE {spec.name} SET LOCATION '{target}'")


def append(df: DataFrame, spec: TableSpec) -> None:
    """Add rows without looking at keys; a repeated run adds them again."""
    # Columns a table got later stand behind the others there.
    held = read(df.sparkSession, spec).columns
    conform(df, spec).select(*held).write.mode("append").insertInto(spec.name)


def partition_location(spark: SparkSession, spec: TableSpec, value) -> str | None:
    """Where the rows of one partition are; None without the partition."""
    named = f"`{spec.partition}` = '{value}'"
    if not spark.sql(f"SHOW PARTITIONS {spec.name} PARTITION ({named})").take(1):
        return None
    described = spark.sql(f"DESCRIBE FORMATTED {spec.name} PARTITION ({named})")
    return described.where("col_name = 'Location'").first()["data_type"]


def _new_folder(spark: SparkSession, spec: TableSpec) -> str:
    # Names with an underscore are not taken for partitions of the table.
    return f"{location(spark, spec.name).rstrip('/')}/_written/{uuid.uuid4().hex}"


def _switch_partition(spark: SparkSession, spec: TableSpec, value, folder: str) -> None:
    """Make ``folder`` the content of a partition, in one catalog call; the old one is removed."""
    named = f"PARTITION (`{spec.partition}` = '{value}')"
    old = partition_location(spark, spec, value)
    if old is None:
        spark.sql(f"ALTER TABLE {spec.name} ADD {named} LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {spec.name} {named} SET LOCATION '{folder}'")
        remove(spark, old)


def replace_slice(df: DataFrame, spec: TableSpec, value: dt.date) -> None:
    """Make ``df`` the whole content of one date partition, even when it is empty.

    Rows that name another date are refused. The slice is switched in one step: a job
    stopped at any point leaves the old rows or the new ones. A reader that began
    before the switch may find its files gone.
    """
    spark = df.sparkSession
    kept = [c for c in spec.schema.names if c != spec.partition]
    rows = conform(df, spec)
    if spec.partition in df.columns or spec.partition_from:
        own = F.col(f"`{spec.partition}`")
        message = F.lit(f"{spec.name}: a row is not of {value.isoformat()}")
        other = F.when(own != F.lit(value), F.raise_error(message).cast("boolean"))
        rows = rows.where(other.isNull())
    folder = _new_folder(spark, spec)
    clustered(rows, spec).select(*kept).write.parquet(folder)
    _switch_partition(spark, spec, value.isoformat(), folder)


def upsert_all(
    df: DataFrame,
    spec: TableSpec,
    keep: Sequence[str] = (),
    on_update: Sequence[str] = (),
    check_key: bool = True,
) -> None:
    """Insert or update by key in an unpartitioned table. ``df`` has unique keys."""
    current = read(df.sparkSession, spec)
    merged = upsert(current, conform(df, spec), spec.key, keep, on_update)
    replace_all(merged, spec, check_key)


def upsert_partitions(
    df: DataFrame,
    spec: TableSpec,
    keep: Sequence[str] = (),
    on_update: Sequence[str] = (),
    check_key: bool = True,
) -> int:
    """Insert or update by key, rewriting only the partitions ``df`` touches.

    The partition value must follow from the key, so a known key can only be in
    a touched partition. ``df`` has unique keys, which is checked unless the caller
    knows it; it is read several times, so it should be a stored table. Returns its
    number of rows. The touched partitions pass through the driver with their row
    counts: one small row per partition, whatever the number of rows.

    The new partitions are written aside, then switched one by one. A job that is
    stopped in between leaves some partitions new and others old, none without its
    rows; running the same batch again completes it.
    """
    spark = df.sparkSession
    rows = conform(df, spec)
    touched = rows.groupBy(spec.partition).agg(F.count("*").alias("rows")).collect()
    if not touched:
        return 0
    if check_key:
        check_unique(rows, spec)
    current = read(spark, spec).where(F.col(spec.partition).isin([t[0] for t in touched]))
    # One shuffle by partition value would send a busy day to one task; the
    # rebalance splits large days over several files and merges small ones.
    merged = upsert(current, rows, spec.key, keep, on_update).hint("rebalance", spec.partition)
    folder = _new_folder(spark, spec)
    clustered(merged, spec).write.partitionBy(spec.partition).parquet(folder)
    for value, _ in touched:
        _switch_partition(spark, spec, value, f"{folder}/{spec.partition}={value}")
    return sum(t["rows"] for t in touched)


def insert_missing(
    df: DataFrame, spec: TableSpec, order: str | Sequence[str] | None = None
) -> None:
    """Append the first row of each key the table does not hold. Nothing is rewritten."""
    rows = conform(first_of_each(df, spec.key, order), spec)
    append(new_keys(rows, read(df.sparkSession, spec), spec.key), spec)
