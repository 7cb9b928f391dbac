"""Patient profiles from any table of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions import draws
from cohortloom.functions.constants import constant_table
from cohortloom.settings import Settings

CALIBRATION_SCHEMA = (
    "modulo_synthea string, procedimiento string, edad_min int, edad_max int, "
    "pool array<string>, p_complicacion double"
)


def patient_id(index: Column, seed: int) -> Column:
    """``pac_{seed}_{index}``; the index is padded to five digits, never cut. A null or
    negative index fails the row. Never null, and padded without a formatter, which costs more than a digest."""
    valid = F.when(index >= 0, index).otherwise(
        F.raise_error(F.concat(F.lit("not an index of a patient: "), F.coalesce(index.cast("string"), F.lit("null")))).cast("long"))
    digits = valid.cast("string")
    padded = F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits)
    return F.coalesce(F.concat(F.lit(f"pac_{seed}_"), padded), F.lit(""))


def check_modules(modules: tuple[str, ...]) -> None:
    unknown = sorted(set(modules) - {row[0] for row in ref.CALIBRATION})
    if unknown:
        raise ValueError(f"modules without calibration: {unknown}")


def generate_profiles(entities: DataFrame, settings: Settings) -> DataFrame:
    """One profile per row of ``entities`` (column ``indice``: a whole number; an id beside it is kept, and
    with it the way the rows are dealt out).

    Patient i depends on i and the seed alone, so a larger population extends a
    smaller one. The calibration join broadcasts a code-defined five-row table.
    """
    check_modules(settings.modules)
    calibration = constant_table(entities.sparkSession, ref.CALIBRATION, CALIBRATION_SCHEMA)
    module = F.element_at(
        draws.constant_array(settings.modules), (F.col("indice") % len(settings.modules) + 1).cast("int"))
    own = "paciente_id" in entities.columns
    keyed = entities.select(
        F.col("paciente_id") if own else patient_id(F.col("indice"), settings.seed).alias("paciente_id"),
        F.coalesce(module, F.lit(settings.modules[0])).alias("modulo_synthea"),
    ).withColumn("d", draws.digest("perfil_paciente", F.col("paciente_id"), settings.seed))

    d = draws.Draws("d")
    return keyed.join(F.broadcast(calibration), "modulo_synthea").select(
        "paciente_id",
        F.concat(F.lit("bundle_"), "paciente_id").alias("bundle_id"),
        F.lit(ref.RUNTIME_TAG).alias("synthea_runtime"),
        "modulo_synthea",
        "procedimiento",
        F.date_add(
            F.lit(ref.FIRST_SURGERY_DATE).cast("date"),
            d.int_between(3, 0, ref.SURGERY_DATE_SPAN),
        ).alias("fecha_cirugia"),
        d.int_between(0, "edad_min", "edad_max").alias("edad"),
        d.pick(1, ["F", "M"]).alias("genero"),
        F.expr(f"filter(pool, (item, i) -> {d.uniform_sql('i + 4')} < {ref.COMORBIDITY_RATE}D)").alias("comorbilidades"),
        d.below(2, "p_complicacion").alias("complicacion_encounter"),
        F.lit(settings.run_ts).alias("generado_ts"),
    )
