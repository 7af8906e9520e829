"""Where a row stood in its source: the order that first-wins and last-wins need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize

# Row offsets are broadcast, one small row per scan task. Beyond this many
# tasks the offsets are joined with an ordinary shuffle instead.
BROADCAST_TASKS = 50_000

_ROW_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id


def source_position() -> Column:
    """Total order over file rows: file, block in the file, row in the block.

    Row ids grow in read order inside a task, and a block is never split over
    tasks, so the order does not depend on how blocks are packed into tasks.
    Must be selected directly on a file scan.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def with_source_position(df: DataFrame, name: str = "_ord") -> DataFrame:
    return df.withColumn(name, source_position())


def with_row_number(df: DataFrame, name: str = "_row", order: str | None = None) -> DataFrame:
    """Consecutive numbers from 0 in source order, without a global sort.

    With a source position in ``order``, rows are numbered within their block and
    blocks by file and place: small counts per block turn into offsets, nothing is
    written. Without one, the order is that of the tasks that read them.

    The rows are written once with their place in the task that read them, so
    the numbers stay the same whatever is recomputed later, and a text source
    is parsed a single time. Row counts per task (one row per task) then turn
    into offsets.
    """
    if order:
        return _numbered_by_position(df, name, order)
    tagged = materialize(df.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_place", 33)
    sizes = tagged.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    if sizes.count() <= BROADCAST_TASKS:
        offsets = F.broadcast(offsets)
    place = F.col("_place").bitwiseAND(F.lit(_ROW_BITS))
    return (
        tagged.withColumn("_task", task)
        .join(offsets, "_task")
        .withColumn(name, F.col("_offset") + place)
        .drop("_task", "_offset", "_place")
    )


def _numbered_by_position(df: DataFrame, name: str, order: str) -> DataFrame:
    block = [F.col(f"{order}.file").alias("_file"), F.col(f"{order}.block").alias("_block")]
    sizes = df.groupBy(*block).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_file", "_block").orderBy(F.col(f"{order}.row"))
    return (
        df.select("*", *block)
        .withColumn("_place", F.row_number().over(within) - 1)
        .join(offsets, ["_file", "_block"])
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_file", "_block", "_offset", "_place")
    )
