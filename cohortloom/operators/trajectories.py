"""Symptom trajectories: one row per patient and call day.

The progress of a call is fixed by its position in the list of call days, so the
ranges of all draws are known before the job starts. They form a constant table
(archetype x position x flag) and a row only looks its ranges up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions import draws
from cohortloom.functions.constants import constant_table
from cohortloom.settings import Settings

SERIOUS = ref.ARCHETYPES[-1]
FLAGS = list(ref.RED_SIGNS)
RANGES_SCHEMA = (
    "dolor_lo int, dolor_hi int, dolor_tope int, fiebre_lo double, fiebre_hi double, fiebre_tope double, "
    "op_movilidad array<string>, op_herida array<string>, op_apetito array<string>, op_sueno array<string>"
)


ATTRIBUTES = ["pain_low", "pain_high", "pain_cap", "temp_low", "temp_high", "temp_cap", "mobility", "wound", "appetite", "sleep"]


def symptom_ranges(archetype: str, progress: float, flag: str) -> list:
    """What one call may draw, in the order of ``ATTRIBUTES``: the last rule that holds decides."""
    if archetype not in ref.COURSES:
        raise ValueError(f"unknown archetype: {archetype!r}")
    scales = {"progress": progress, "peak": 1 - abs(progress - 0.5) * 2}
    chosen = {}
    for attribute, scale, start, below, value in [*ref.NOTHING_UNUSUAL, *ref.COURSES[archetype]]:
        if start <= scales[scale] < below:
            chosen[attribute] = (value, scales[scale])
    if archetype == SERIOUS and progress >= ref.RED_FROM_PROGRESS:
        chosen.update({attribute: (value, progress) for attribute, value in ref.RED_SIGNS[flag].items()})

    def settled(attribute: str):
        value, at = chosen[attribute]
        if isinstance(value, list):
            return value
        moved = value[1] * at
        return max(value[2], value[0] + round(moved)) if attribute.startswith("pain") else value[0] + moved

    return [settled(attribute) for attribute in ATTRIBUTES]


def range_table(settings: Settings) -> list[tuple]:
    steps = len(settings.call_days) - 1
    rows = []
    for archetype in dict.fromkeys(settings.archetypes):
        for position in range(len(settings.call_days)):
            progress = position / steps if steps else 1.0
            for number, flag in enumerate(FLAGS):
                rows.append((archetype, position, number, *symptom_ranges(archetype, progress, flag)))
    return rows


def archetype_of(complication: Column, draw: draws.Draws, archetypes: tuple[str, ...]) -> Column:
    """A recorded complication always leads to the serious course (the last one listed
    if the serious one is not offered); otherwise an even choice among the others."""
    serious = SERIOUS if SERIOUS in archetypes else archetypes[-1]
    others = [a for a in archetypes if a != SERIOUS] or list(archetypes)
    return F.when(complication, F.lit(serious)).otherwise(draw.pick(0, others))


def with_archetype(profiles: DataFrame, settings: Settings) -> DataFrame:
    d = draws.digest("trayectoria_arquetipo", F.col("paciente_id"), settings.seed)
    return profiles.select("paciente_id", "complicacion_encounter", d.alias("d")).select(
        "paciente_id",
        archetype_of(F.col("complicacion_encounter"), draws.Draws("d"), settings.archetypes)
        .alias("arquetipo_trayectoria"),
    )


def generate_trajectories(profiles: DataFrame, settings: Settings) -> DataFrame:
    """Narrow plan: explode the call days, look ranges up in a broadcast constant
    table of archetypes x days x 4 rows, draw. No shuffle."""
    ranges = constant_table(
        profiles.sparkSession, range_table(settings),
        "arquetipo_trayectoria string, posicion int, bandera int, " + RANGES_SCHEMA,
    )
    calls = (
        with_archetype(profiles, settings)
        .select("*", F.posexplode(draws.constant_array(settings.call_days, "int")).alias("posicion", "dia_postop"))
        .withColumn("d", draws.digest("trayectoria_dia", F.col("paciente_id"), F.col("dia_postop"), settings.seed))
        .withColumn("bandera", draws.Draws("d").index(6, len(FLAGS)))
    )

    d = draws.Draws("d")
    temperature = f"least({d.real_sql(1, 'fiebre_lo', 'fiebre_hi')}, fiebre_tope)"
    return calls.join(F.broadcast(ranges), ["arquetipo_trayectoria", "posicion", "bandera"]).select(
        F.concat(F.lit("tray_"), "paciente_id", F.lit("_"), F.col("dia_postop").cast("string")).alias("trayectoria_id"),
        "paciente_id",
        "dia_postop",
        "arquetipo_trayectoria",
        F.least(d.int_between(0, "dolor_lo", "dolor_hi"), F.col("dolor_tope"))
        .alias("dolor_nrs"),
        F.expr(draws.one_decimal_sql(temperature)).alias("fiebre_c"),
        d.pick(2, "op_movilidad").alias("movilidad"),
        d.pick(3, "op_herida").alias("herida"),
        d.pick(4, "op_apetito").alias("apetito"),
        d.pick(5, "op_sueno").alias("sueno"),
        F.lit(settings.seed).alias("seed"),
        F.lit(settings.run_ts).alias("generado_ts"),
    )
