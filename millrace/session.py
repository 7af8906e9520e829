"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# UTC pins TIMESTAMP -> DATE casts; ANSI makes a bad strict cast fail the job
# instead of turning into NULL.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

SHUFFLE_BYTES = 256 * 1024 * 1024  # aimed size of one shuffle partition
MAX_SHUFFLE_PARTITIONS = 100_000


def shuffle_settings(input_bytes: int) -> dict[str, str]:
    """Shuffle partitions for an input size. AQE merges small ones afterwards."""
    wanted = math.ceil(input_bytes / SHUFFLE_BYTES)
    partitions = str(min(max(wanted, 200), MAX_SHUFFLE_PARTITIONS))
    return {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions,
    }


def input_bytes(df: DataFrame) -> int:
    """Estimated size of what a plan reads, from the statistics of its sources."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)  # larger ones are unknown


@contextmanager
def shuffles_sized_for(*frames: DataFrame) -> Iterator[None]:
    """Within the block, shuffles have enough partitions for the frames' sources.

    A session that already has more keeps its number. Results do not depend on it.
    """
    spark = frames[0].sparkSession
    wanted = shuffle_settings(sum(input_bytes(df) for df in frames))
    name = "spark.sql.shuffle.partitions"
    if int(wanted[name]) <= max(int(spark.conf.get(name)), 200):
        yield
        return
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def get_session(master: str | None = None, app: str = "millrace", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_semantics(spark: SparkSession) -> SparkSession:
    """Apply the two settings that change results to a session made elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        if spark.conf.get(key, None) != SETTINGS[key]:
            spark.conf.set(key, SETTINGS[key])
    return spark


def own_session(spark: SparkSession) -> SparkSession:
    """Another session with the same settings, for a thread that may change them."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and other.conf.get(key, None) != value:
            other.conf.set(key, value)
    return other


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is only accepted
    when the whole session runs on this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/millrace/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a shared Parquet table and return a scan of it.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
