"""Table scans, fixed-schema appends and the keyed upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, folder: str, table: str, *columns: str) -> DataFrame:
    """Parquet scan, pruned to ``columns`` when given. A table may be one file or a directory."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    return df.select(*columns) if columns else df


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name, order and type; null checks are the contract's job
    because parquet reads come back nullable."""
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields])


def append_table(df: DataFrame, path: str, schema: T.StructType) -> None:
    with_schema(df, schema).write.mode("append").parquet(path)


class DuplicateKeyError(ValueError):
    """An upsert source holds a key more than once."""


def reject_duplicate_keys(source: DataFrame, key: str) -> None:
    """One job over the key column; copies of a hot key are counted before the shuffle."""
    repeated = source.groupBy(key).count().where("count > 1").select(key).first()
    if repeated is not None:
        raise DuplicateKeyError(f"duplicate key in upsert source: {repeated[0]}")


def upsert(target: DataFrame, source: DataFrame, key: str, checked: bool = False) -> DataFrame:
    """Rows of ``target`` without a match, plus all of ``source``: matched keys take every
    column of the source, unmatched ones are inserted.

    ``source`` is read once for its keys and once for its rows, so it should be a
    stored table. Repeated source keys are rejected first (unless ``checked`` says that was
    done): an anti-join with a union would keep both.
    """
    if not checked:
        reject_duplicate_keys(source, key)
    return target.join(source.select(key), key, "left_anti").unionByName(source)
