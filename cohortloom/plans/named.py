"""The table of named queries and what they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.plans.inputs import Inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TASKS = "spark.cohortloom.tasks"  # partitions that one-file tables are spread over; unset: no shuffle
RUN_COLUMNS = ("generado_ts", "clasificado_ts", "adaptation_ts", "aplicado_ts")


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register ``build`` under its own name; run timestamps stay out of compared outputs."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Inputs(spark, folder, tasks=int(spark.conf.get(TASKS, "0")))).drop(*RUN_COLUMNS)

    QUERIES[build.__name__] = run
    return build


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Optional whole numbers as text: clients disagree on how a null among integers is typed."""
    return df.withColumns({name: F.col(name).cast("string") for name in columns})
