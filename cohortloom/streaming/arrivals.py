"""Streams with state over arriving files: repeated keys, late rows, label shares by time window.

Event time decides, never the order of arrival. A row whose time lies behind the watermark (the latest
time seen in earlier arrivals, less ``delay``) is late: state for it may be gone, so it is not counted
again and is reported by a batch query over what arrived and what was written. All streams stop when
the files at hand are done and go on from their checkpoint the next time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.settings import Settings

ON_TIME, LATE = "a_tiempo", "tarde"


def _run(rows: DataFrame, output: str, checkpoint: str) -> None:
    rows.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).outputMode("append").start().awaitTermination()


def _arriving(spark: SparkSession, source: str, schema: T.StructType, time: str, delay: str, max_files: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source).withWatermark(time, delay)


def distinct_stream(spark: SparkSession, source: str, schema: T.StructType, *, key: str, time: str, delay: str,
                    label: Callable[[DataFrame], DataFrame], output: str, checkpoint: str, max_files: int = 1000) -> None:
    """Label each ``key`` of the arriving files once, however often its row arrives.

    A key is remembered until the watermark passes its time by ``delay``; a copy that comes later than that
    is behind the watermark itself. State is one row a key within that span, spread over the shuffle
    partitions by key. The file sink commits by batch, so a batch that is run again changes nothing.
    """
    rows = _arriving(spark, source, schema, time, delay, max_files).dropDuplicatesWithinWatermark([key])
    _run(label(rows), output, checkpoint)


def with_late_rows(arrived: DataFrame, written: DataFrame, key: str, label: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``written`` and the rows of ``arrived`` that the stream left out as late, told apart by ``estado``. Copies of
    a key are folded before the join."""
    missed = label(arrived.dropDuplicates([key])).join(written.select(key), key, "left_anti")
    return written.withColumn("estado", F.lit(ON_TIME)).unionByName(missed.withColumn("estado", F.lit(LATE)))


def windowed_counts(spark: SparkSession, source: str, schema: T.StructType, *, time: str, width: str, delay: str,
                    label: Column, domain: list[str], output: str, checkpoint: str, max_files: int = 1000) -> None:
    """Rows and rows of each label of ``domain`` by event-time window, written once a window is closed by the watermark.

    State is one row a window and shuffle partition's share is folded before the shuffle, so a window with a third
    of all rows costs no more than others. Late are rows whose window was closed before they came.
    """
    rows = _arriving(spark, source, schema, time, delay, max_files)
    counts = [F.count_if(label == value).alias(f"n{at}") for at, value in enumerate(domain)]
    closed = rows.groupBy(F.window(time, width).alias("ventana")).agg(F.count(F.lit(1)).alias("total"), *counts)
    _run(closed.select(F.col("ventana.start").alias("inicio"), "total", *[f"n{at}" for at in range(len(domain))]),
         output, checkpoint)


def windowed_shares(counted: DataFrame, arrived: DataFrame, *, time: str, width: str, domain: list[str],
                    settings: Settings) -> DataFrame:
    """Shares of each closed window and label, with ``tardias``: rows that arrived for it too late."""
    all_rows = arrived.groupBy(F.window(time, width)["start"].alias("inicio")).agg(F.count(F.lit(1)).alias("llegadas"))
    shares = counted.join(all_rows, "inicio").select(
        "inicio", "total", (F.col("llegadas") - F.col("total")).alias("tardias"),
        F.inline(F.array(*[F.struct(F.lit(value).alias("label"), F.col(f"n{at}").alias("n"))
                           for at, value in enumerate(domain)])))
    share = F.col("n") / F.col("total")
    return shares.select(
        F.date_format("inicio", "yyyy-MM-dd HH:mm:ss").alias("inicio"), "label", "n", "total", "tardias",
        share.alias("proporcion"), share.between(settings.min_share, settings.max_share).alias("en_rango"))
