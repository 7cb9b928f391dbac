"""Content comparison of two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_difference(left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows found on one side only (copies counted), as two counts; both 0 means equal content.

    Both sides are folded to (row, signed count) before the shuffle, so many copies
    of one row travel as one.
    """
    columns = [c for c in left.columns if c not in ignore]
    signed = left.select(*columns, F.lit(1).alias("signo")).unionByName(
        right.select(*columns, F.lit(-1).alias("signo")))
    balance = signed.groupBy(*columns).agg(F.sum("signo").alias("saldo"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest("saldo", F.lit(0))), F.lit(0)).alias("solo_izquierda"),
        F.coalesce(F.sum(F.greatest(-F.col("saldo"), F.lit(0))), F.lit(0)).alias("solo_derecha"),
    )
