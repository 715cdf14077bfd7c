"""The same work as a stream.

Log files are read as they land. A run takes what is there when it starts, fixes
that as its end, and stops; the next run goes on from the query's checkpoint. An
idle run starts no batch and so writes no records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowtide.operators.shape import shape_changes


def tail_log(
    spark: SparkSession,
    log_dir: str,
    schema: StructType,
    out_dir: str,
    pk: Sequence[str],
    columns: Sequence[str] | None = None,
    files_per_batch: int | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
) -> int:
    """Shape every new change into records; returns the number of batches run.

    A batch may run twice after a failure: it overwrites its own directory, so its
    records are there once. Records are written before the batch's cursors, so a
    cursor never runs ahead of its records. ``on_batch`` gets the written records,
    for instance to fold them into a table.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    batches: list[int] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{out_dir}/records/batch={batch_id}"
        shape_changes(batch, pk, columns).write.mode("overwrite").parquet(path)
        written = batch.sparkSession.read.parquet(path)
        if on_batch is not None:
            on_batch(written, batch_id)
        written.groupBy("keyspace", "table", "shard").agg(
            F.max("seq").alias("seq"), F.max_by("position", "seq").alias("position")
        ).write.mode("overwrite").parquet(f"{out_dir}/cursors/batch={batch_id}")
        batches.append(batch_id)

    query = (
        reader.parquet(log_dir)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{out_dir}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(batches)


def streamed_records(spark: SparkSession, out_dir: str) -> DataFrame:
    """All records written so far."""
    return spark.read.parquet(f"{out_dir}/records").drop("batch")


def streamed_cursors(spark: SparkSession, out_dir: str) -> DataFrame:
    """The latest cursor of each shard."""
    return (
        spark.read.parquet(f"{out_dir}/cursors")
        .groupBy("keyspace", "table", "shard")
        .agg(F.max("seq").alias("seq"), F.max_by("position", "seq").alias("position"))
    )
