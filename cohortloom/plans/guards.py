"""Guards as data: which rows would be refused, and by which guard, instead of an error at the first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions.constants import constant_table
from cohortloom.functions.noise_text import INTENSITIES
from cohortloom.operators.profiles import CALIBRATION_SCHEMA


def noise_guards(kind: str = "tipo_ruido", level: str = "intensidad") -> dict[str, Column]:
    """What ``add_noise`` refuses, in its order."""
    return {
        "intensidad_invalida": ~F.coalesce(F.col(level).between(INTENSITIES[0], INTENSITIES[-1]), F.lit(False)),
        "tipo_estructural": F.col(kind).eqNullSafe(ref.THIRD_PARTY),
        "tipo_desconocido": ~F.coalesce(F.col(kind).isin(ref.TEXT_NOISE), F.lit(False)),
    }


def style_guards(style: str = "estilo_paciente") -> dict[str, Column]:
    return {"estilo_desconocido": ~F.coalesce(F.col(style).isin(ref.STYLES), F.lit(False))}


def refused_by(guards: dict[str, Column]) -> Column:
    """Name of the first guard that refuses the row, null if all let it pass."""
    return F.coalesce(*[F.when(condition, name) for name, condition in guards.items()])


def guard_outcomes(rows: DataFrame, guards: dict[str, Column]) -> DataFrame:
    """Refused rows per guard, and the passed ones (``guarda`` = ``pasa``)."""
    return rows.groupBy(F.coalesce(refused_by(guards), F.lit("pasa")).alias("guarda")).agg(F.count(F.lit(1)).alias("filas"))


def uncalibrated_modules(requested: DataFrame) -> DataFrame:
    """``modulo`` values of ``requested`` without calibration, with their rows; copies are folded before the join
    with the calibration (five rows, defined in code)."""
    known = constant_table(requested.sparkSession, ref.CALIBRATION, CALIBRATION_SCHEMA).select(
        F.col("modulo_synthea").alias("modulo"))
    return requested.groupBy("modulo").agg(F.count(F.lit(1)).alias("filas")).join(F.broadcast(known), "modulo", "left_anti")
