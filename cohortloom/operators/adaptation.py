"""Demographic replacement, weighted by population."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions import draws
from cohortloom.functions.constants import constant_table
from cohortloom.settings import Settings

GEO_CELLS = 256


def department_shares() -> list[tuple[str, str, int, float, float, float]]:
    """(department, city, population, weight, from, to): half-open shares of [0, 1).

    Arithmetic on 33 constants, so it runs while the plan is built. The last
    range ends at exactly 1.
    """
    total = sum(row[2] for row in ref.DEPARTMENTS)
    upto = list(accumulate(row[2] for row in ref.DEPARTMENTS))
    return [
        (department, city, people, people / total, (end - people) / total, end / total)
        for (department, city, people), end in zip(ref.DEPARTMENTS, upto)
    ]


def department_weights(spark: SparkSession) -> DataFrame:
    return constant_table(
        spark, department_shares(),
        "departamento string, ciudad string, poblacion long, peso double, desde double, hasta double",
    )


def weighted_department(rows: DataFrame, u: Column) -> DataFrame:
    """Add ``departamento`` and ``ciudad`` for a draw ``u`` in [0, 1).

    A range join as an equi-join: [0, 1) is cut into equal cells, every range is
    listed under each cell it touches, and the exact range test runs among the
    few candidates of a cell. One broadcast hash lookup instead of comparing
    every row with all 33 ranges.
    """
    cells = department_weights(rows.sparkSession).select(
        "departamento", "ciudad", "desde", "hasta",
        F.explode(F.sequence(
            F.floor(F.col("desde") * GEO_CELLS).cast("int"),
            F.least(F.floor(F.col("hasta") * GEO_CELLS), F.lit(GEO_CELLS - 1)).cast("int"),
        )).alias("celda"),
    )
    drawn = rows.withColumn("u_geo", u).withColumn(
        "celda", F.coalesce(F.floor(F.col("u_geo") * GEO_CELLS).cast("int"), F.lit(0)))
    within = (drawn["celda"] == cells["celda"]) & (F.col("u_geo") >= F.col("desde")) & (F.col("u_geo") < F.col("hasta"))
    return drawn.join(F.broadcast(cells), within).drop("celda", "desde", "hasta", "u_geo")


def adapt_profiles(profiles: DataFrame, settings: Settings) -> DataFrame:
    """Reads nothing but ``paciente_id``; deterministic by id and seed."""
    keyed = profiles.select("paciente_id").select(
        "paciente_id",
        draws.digest("adapt_colombia", F.col("paciente_id"), settings.seed).alias("d"),
        draws.digest("adapt_colombia_nombre", F.col("paciente_id"), settings.seed).alias("n"),
    )
    d, n = draws.Draws("d"), draws.Draws("n")
    name = F.concat_ws(
        " ",
        n.pick(0, ref.FIRST_NAMES),
        n.pick(1, ref.SURNAMES),
        n.pick(2, ref.SURNAMES),
    )
    street = F.format_string(
        "%s %d # %d-%d",
        n.pick(3, ref.STREET_KINDS),
        n.int_between(4, 1, 170),
        n.int_between(5, 1, 120),
        n.int_between(6, 1, 99),
    )
    return weighted_department(keyed, d.uniform(0)).select(
        "paciente_id",
        name.alias("nombre_completo"),
        street.alias("direccion"),
        "ciudad",
        "departamento",
        (F.lit(ref.DOCUMENT_BASE) + d.int_between(1, 0, ref.DOCUMENT_SPAN))
        .cast("string").alias("documento_cc"),
        d.pick(2, ref.INSURERS).alias("eps"),
        F.lit("US").alias("source_country"),
        F.lit("CO").alias("adapted_country"),
        draws.constant_array(ref.ADAPTED_FIELDS).alias("adaptation_fields"),
        F.lit(settings.run_ts).alias("adaptation_ts"),
    )
