"""Small constant tables as JVM-side literals."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def constant_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows of a fixed, code-defined table, safe to broadcast by construction.

    The whole table is one JSON literal that the optimizer folds while planning.
    """
    fields = T.StructType.fromDDL(schema)
    documents = json.dumps([dict(zip(fields.names, row)) for row in rows], ensure_ascii=False)
    return spark.range(1, numPartitions=1).select(
        F.inline(F.from_json(F.lit(documents), f"array<{fields.simpleString()}>")))
