"""Edge-case intake (layer 3): review of submissions and their turns as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.operators.labels import triage_of_columns


def _empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def review(submissions: DataFrame) -> DataFrame:
    """Add ``motivo_rechazo`` (null = accepted) and ``label_regla`` (null without symptoms)."""
    category_known = F.coalesce(F.col("categoria_caso_limite").isin(ref.EDGE_CATEGORIES), F.lit(False))
    return submissions.withColumns({
        "motivo_rechazo": F.when(~category_known, "categoria_caso_limite")
        .when(_empty("validado_por"), "validado_por")
        .when(_empty("criterio_clinico_ref"), "criterio_clinico_ref"),
        "label_regla": F.when(F.col("sintomas").isNotNull(), triage_of_columns("sintomas.")),
    })


def rejects(reviewed: DataFrame) -> DataFrame:
    return reviewed.where(F.col("motivo_rechazo").isNotNull()).select(
        "envio_id", "caso_id", "categoria_caso_limite", "motivo_rechazo")


def disagreements(reviewed: DataFrame) -> DataFrame:
    """Accepted submissions whose label is not the rule's: a warning, never a rejection."""
    differs = F.col("label_regla").isNotNull() & ~F.col("label_regla").eqNullSafe(F.col("label_ground_truth"))
    return reviewed.where(F.col("motivo_rechazo").isNull() & differs).select(
        "envio_id", "caso_id", "label_ground_truth", "label_regla")


def layer3_rows(reviewed: DataFrame, run_ts) -> DataFrame:
    """Turns of accepted submissions, one row each, submission columns repeated."""
    def optional(column: str, default: str) -> Column:
        return F.col(column) if column in reviewed.columns else F.lit(default)

    turns = reviewed.where(F.col("motivo_rechazo").isNull()).select(
        "caso_id", "paciente_id", "dia_postop", "label_ground_truth",
        optional("estilo_paciente", ref.EDGE_STYLE).alias("estilo_paciente"),
        optional("modelo_paciente", ref.EDGE_MODEL).alias("modelo_paciente"),
        optional("modelo_agente", ref.EDGE_MODEL).alias("modelo_agente"),
        "categoria_caso_limite", "validado_por", "criterio_clinico_ref",
        F.explode("turnos").alias("t"),
    )
    return turns.select(
        "t.dialogo_id", "caso_id", "paciente_id", "dia_postop", "t.turno_idx", "t.hablante", "t.texto",
        "label_ground_truth", "estilo_paciente", "modelo_paciente", "modelo_agente",
        F.lit(None).cast("int").alias("prompt_tokens"), F.lit(None).cast("int").alias("completion_tokens"),
        F.lit(run_ts).alias("generado_ts"),
        "categoria_caso_limite", "validado_por", "criterio_clinico_ref",
    )
