"""Incremental labelling of arriving rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def label_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    label: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    max_files: int = 1000,
) -> None:
    """Label every file that arrived since the last run, then stop.

    The label depends on its own row only, so nothing is kept in state and the
    parquet sink's commit list makes a restarted batch count once.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    query = (
        label(arriving).writeStream.format("parquet")
        .option("path", output).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).outputMode("append").start()
    )
    query.awaitTermination()


def resume_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    handle: Callable[[DataFrame], None],
    checkpoint: str,
    max_files: int = 1000,
) -> None:
    """Hand the files that arrived since the last run to ``handle`` in micro-batches.

    ``handle`` may see a batch twice after a failure, so it must be idempotent,
    as a batch run over pending cases with a keyed upsert is.
    """
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source)
    query = (
        arriving.writeStream.foreachBatch(lambda batch, _: handle(batch))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
