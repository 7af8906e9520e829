"""Replication of newly arrived documents only.

The batch job reads a whole collection at every scheduled run. This form keeps
the read position in a checkpoint, so a run handles the files that arrived
since the last one and then stops. The first document of a key by path and place
in the file wins, whatever run or batch a file falls into, as in the batch job.
A batch that is repeated after a failure leaves the tables as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.plans.replication import Collection, replicate_earlier
from millrace.sinks.tables import TableSpec


def replicate_new(
    spark: SparkSession,
    root: str,
    collection: Collection,
    checkpoint: str,
    table: TableSpec | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Start one catch-up run over ``<root>/<collection>/``; await the returned query."""
    reader = spark.readStream.schema(collection.schema).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    documents = reader.json(f"{root.rstrip('/')}/{collection.name}").select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        # Row ids only exist in a batch plan; they grow in read order in a block,
        # and a block is read by one batch.
        place = F.struct(
            F.col("_path").alias("file"),
            F.col("_block").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        rows = batch.withColumn("_ord", place).drop("_path", "_block")
        replicate_earlier(batch.sparkSession, rows, collection, table)

    return (
        documents.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
