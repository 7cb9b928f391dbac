"""Intermediate tables in the shared folder, and column names that may clash.

A stored table cuts lineage, survives a lost executor, and has a size Spark knows: a join with it
is broadcast only if its files are below ``spark.sql.autoBroadcastJoinThreshold``; beyond that the
same plan is a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.sources.workspace import new_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to a new folder of the shared place, and read back."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, taken: Iterable[str]) -> list[str]:
    """Columns of ``df`` that do not clash with ``taken``; Spark compares names without case."""
    lowered = {name.lower() for name in taken}
    return [name for name in df.columns if name.lower() not in lowered]
