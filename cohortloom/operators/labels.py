"""Rule-based triage label, fixed before any text exists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.settings import Settings

GREEN, YELLOW, RED = ref.LABELS


def rule_label(
    red_any: Sequence[Column],
    yellow: Sequence[Column],
    min_yellow: int = 2,
    numeric_inputs: Sequence[Column] = (),
) -> Column:
    """Red on any red condition, yellow on at least ``min_yellow`` moderate ones, else green.

    A null condition or a NaN among ``numeric_inputs`` gives a NULL label: an
    incomplete case must show up as a contract violation, never as green.
    """
    unusable = [c.isNull() for c in (*red_any, *yellow)] + [c.isNull() | F.isnan(c) for c in numeric_inputs]
    signals = reduce(add, [c.cast("int") for c in yellow])
    return (
        F.when(reduce(or_, unusable), F.lit(None).cast("string"))
        .when(reduce(or_, red_any), RED)
        .when(signals >= min_yellow, YELLOW)
        .otherwise(GREEN)
    )


def triage_label(
    pain: Column, temperature: Column, mobility: Column, wound: Column, appetite: Column, sleep: Column
) -> Column:
    """The clinical rule; its thresholds and values are fixed values."""
    return rule_label(
        red_any=[
            temperature >= 38.5,
            wound.isin("dehiscencia", "secrecion_purulenta"),
            pain >= 8,
            mobility == "incapacitante_nueva",
        ],
        yellow=[
            temperature >= 37.8,
            pain >= 5,
            wound == "eritema_leve",
            appetite == "muy_disminuido",
            sleep == "muy_alterado",
        ],
        numeric_inputs=[temperature],
    )


def triage_of_columns(prefix: str = "") -> Column:
    return triage_label(*[F.col(prefix + name) for name in ref.SYMPTOMS])


def label_cases(trajectories: DataFrame, settings: Settings, kept: Sequence[str] = ()) -> DataFrame:
    """``kept`` are further columns that stay beside the case."""
    return trajectories.select(
        F.concat(F.lit("caso_"), "trayectoria_id").alias("caso_id"),
        "paciente_id",
        "trayectoria_id",
        "dia_postop",
        *ref.SYMPTOMS,
        triage_of_columns().alias("label"),
        F.lit(settings.rule_version).alias("regla_version"),
        F.lit(settings.run_ts).alias("clasificado_ts"),
        *kept,
    )
