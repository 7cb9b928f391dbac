"""Side-by-side run of a registered query and its SQL counterpart."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("cohortloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites cost more than the plans
        .getOrCreate()
    )


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(_plain(row[at]) for at in order) for row in rows)


def spark_side(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), multiset(df.columns, (tuple(r) for r in df.collect()))


def sql_side(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), multiset(columns, result.fetchall())
