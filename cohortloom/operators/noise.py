"""Noisy copy of the dialogues (layer 2) and its change log.

Layer 1 is never changed. One annotated plan decides per turn what happens; the
layer-2 rows and the log rows are projections of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions import draws
from cohortloom.functions.draws import constant_array
from cohortloom.functions.noise_text import INTENSITIES, add_noise, key_sql

# Turns numbered within one window group; see dense_turn_index.
TURN_RANGE = 4096


def eligible_types(intensity: int) -> list[str]:
    return [name for name, low, high in ref.NOISE_RANGES if low <= intensity <= high]


def select_noise(turns: DataFrame, intensity: Column | int, seed: int) -> DataFrame:
    """Add ``d_sel`` and ``tipo_ruido`` (null = not affected), keyed by (dialogo_id, seed).

    An intensity without eligible types leaves every turn as it is. The digest is a generated column: a filter on
    the type would otherwise be moved below it and digest the rows a second time.
    """
    d = draws.Draws("d_sel")
    keyed = turns.select("*", F.explode(F.array(
        draws.digest("inject_noise_seleccion", F.col("dialogo_id"), seed))).alias("d_sel"))
    if isinstance(intensity, int):
        kind = d.choice(1, eligible_types(intensity)) if intensity in INTENSITIES else F.lit(None).cast("string")
        return keyed.withColumn("tipo_ruido", F.when(F.col("d_sel") < _limit(intensity), kind))
    known = intensity.between(INTENSITIES[0], INTENSITIES[-1])
    types = constant_array([eligible_types(i) for i in INTENSITIES], "array<string>")
    limits = constant_array([_limit(i) for i in INTENSITIES])
    affected = F.col("d_sel") < F.when(known, F.element_at(limits, intensity))
    return keyed.withColumn("elegibles", F.when(known, F.element_at(types, intensity))).withColumn(
        "tipo_ruido", F.when(affected, d.pick(1, "elegibles"))).drop("elegibles")


def _limit(intensity: int) -> str:
    """Digests that sort below it begin with a word that affects a turn."""
    return draws.hex_threshold(min(0.9, 0.15 * max(intensity, 0)))


def annotate_noise(
    turns: DataFrame, intensity: int, seed: int, idiom_map: dict[str, str] | None = None
) -> DataFrame:
    """Layer-1 turns with ``tipo_ruido``, ``texto_ruidoso`` and ``intensidad`` (null if untouched)."""
    selected = select_noise(turns, intensity, seed)
    kind = F.col("tipo_ruido")
    noisy = F.when(kind == ref.THIRD_PARTY, draws.Draws("d_sel").choice(2, ref.INTERJECTIONS))
    if intensity in INTENSITIES:
        selected = selected.withColumn("clave_ruido", F.when(
            kind != ref.THIRD_PARTY, F.expr(key_sql("texto", "tipo_ruido", str(intensity), str(seed)))))
        noisy = noisy.when(
            kind.isNotNull(), add_noise("texto", "tipo_ruido", intensity, seed, idiom_map, key="clave_ruido"))
    return selected.withColumn("texto_ruidoso", noisy).withColumn(
        "intensidad", F.when(kind.isNotNull(), F.lit(intensity))).drop("d_sel", "clave_ruido")


def _range_of(position: str) -> Column:
    return F.greatest((F.col(position) / TURN_RANGE).cast("int"), F.lit(0)).alias("tramo")


def range_starts(counted: DataFrame, group: list[str], position: str) -> DataFrame:
    """Rows before each range of a group; ``counted`` holds group, position and ``filas``.

    Only groups that reach beyond their first range are kept. Rows are folded to one
    per range before the ranges of a group meet, so a hot group stays small, and
    ``counted``, which may be costly, is read once.
    """
    before = Window.partitionBy(*group).orderBy("tramo").rowsBetween(Window.unboundedPreceding, -1)
    per_range = counted.groupBy(*group, _range_of(position)).agg(F.sum("filas").alias("n"))
    long_groups = per_range.withColumn("ultimo", F.max("tramo").over(Window.partitionBy(*group))).where("ultimo > 0")
    return long_groups.select(*group, "tramo", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inicio"))


def dense_turn_index(
    rows: DataFrame, starts: DataFrame | None, group: list[str], position: str, order: list[str],
    together: bool = False
) -> DataFrame:
    """Renumber ``position`` 0..n-1 within ``group``, whatever the size of a group.

    A group is cut into ranges of ``TURN_RANGE`` old positions. Numbering inside a
    range is a window over that range only and continues from the range's start.
    The old position is an INT, so a group has at most 2**31 / TURN_RANGE ranges to
    add up. The join uses the partitioning of the window: rows are shuffled once.

    ``together``: ``rows`` are dealt out by the first column of ``group``, few for each of its
    values. They then stay where they are, and as a whole group lies in one task anyway, it is numbered
    in one go: its ranges and their starts, which may be None, are not needed. The rows are sorted
    by a number first, as the keys are long and begin alike.
    """
    if together:
        whole = Window.partitionBy(F.xxhash64(*group), *group).orderBy(position, *order)
        return rows.select(*group, *[c for c in rows.columns if c not in group]).withColumn(
            position, (F.row_number().over(whole) - 1).cast("int"))
    parts = [*group, "tramo"]
    within = Window.partitionBy(*parts).orderBy(position, *order)
    ranged = rows.select("*", _range_of(position)).join(starts, parts, "left")
    return (
        ranged.withColumn(position, (F.row_number().over(within) - 1 + F.coalesce("inicio", F.lit(0))).cast("int"))
        .drop("tramo", "inicio")
    )


def layer2_rows(annotated: DataFrame, run_ts, together: bool = False) -> DataFrame:
    """All turns, noisy or copied; a third-party turn follows its untouched original.

    Label and metadata are inherited. Numbering restarts per case and day. ``together``: the turns
    are dealt out by patient, few for each, and a case belongs to one patient.
    """
    third = F.col("tipo_ruido").eqNullSafe(ref.THIRD_PARTY)
    copy_id = F.concat("dialogo_id", F.lit("_c2"))
    own = F.struct(
        copy_id.alias("id2"), F.lit(0).alias("insertado"), F.col("hablante").alias("habla"),
        F.when(third, F.col("texto")).otherwise(F.coalesce("texto_ruidoso", "texto")).alias("dicho"),
        F.when(~third, F.col("intensidad")).alias("nivel"),
    )
    guest = F.struct(
        F.concat(copy_id, F.lit("_tercero")).alias("id2"), F.lit(1).alias("insertado"), F.lit("tercero").alias("habla"),
        F.col("texto_ruidoso").alias("dicho"), F.col("intensidad").alias("nivel"),
    )
    spoken = annotated.select("*", F.inline(F.when(third, F.array(own, guest)).otherwise(F.array(own))))
    kept = spoken.select(
        F.col("id2").alias("dialogo_id"), F.col("dialogo_id").alias("dialogo_id_capa1"),
        "caso_id", "paciente_id", "dia_postop", "turno_idx",
        F.col("habla").alias("hablante"), F.col("dicho").alias("texto"),
        "label_ground_truth", "estilo_paciente", "modelo_paciente", "modelo_agente",
        F.col("nivel").alias("intensidad_ruido"), "insertado",
    )
    group = ["caso_id", "dia_postop"]
    order = ["dialogo_id_capa1", "insertado"]
    if together:
        numbered = dense_turn_index(kept, None, ["paciente_id", *group], "turno_idx", order, together)
        numbered = numbered.select(*group, *[c for c in kept.columns if c not in group])
    else:
        counted = annotated.select(*group, "turno_idx", F.when(third, 2).otherwise(1).alias("filas"))
        numbered = dense_turn_index(kept, range_starts(counted, group, "turno_idx"), group, "turno_idx", order)
    return numbered.drop("insertado").withColumn("generado_ts", F.lit(run_ts))


def noise_log_rows(annotated: DataFrame, seed: int, run_ts, *kept: str) -> DataFrame:
    """Exactly one row per affected output row, with layer-1 turn numbers; ``kept`` are further columns of the turn."""
    third = F.col("tipo_ruido") == ref.THIRD_PARTY
    id2 = F.concat("dialogo_id", F.when(third, F.lit("_c2_tercero")).otherwise(F.lit("_c2")))
    return annotated.where(F.col("tipo_ruido").isNotNull()).select(
        F.concat(F.lit("map_"), id2, F.lit("_"), F.col("turno_idx").cast("string"), F.lit("_"), "tipo_ruido")
        .alias("mapping_id"),
        F.col("dialogo_id").alias("dialogo_id_capa1"),
        id2.alias("dialogo_id_capa2"),
        F.col("turno_idx").alias("turno_idx_afectado"),
        "tipo_ruido", "intensidad",
        F.col("texto").alias("texto_original"),
        "texto_ruidoso",
        F.lit(seed).alias("seed"),
        F.lit(run_ts).alias("aplicado_ts"),
        *kept,
    )


def _linked(rows: DataFrame, turns: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``rows`` with their ``turns`` of equal ``key``, if any. ``by`` names a column that both are dealt out by and that
    a key has one value of: the sides meet by it alone where they lie, and the key is told from its hash.

    The key is no join column then, since Spark deals both sides out anew by all columns of a join.
    """
    if not by:
        return rows.join(turns, key, "left")
    other = turns.select(*[F.col(name).alias(f"{name}_otro") if name in (key, *by) else F.col(name) for name in turns.columns],
                         F.xxhash64(key).alias("marca_otro"))
    marked = rows.withColumn("marca", F.xxhash64(key))
    alike = lambda name: (F.col(name) <= F.col(f"{name}_otro")) & (F.col(name) >= F.col(f"{name}_otro"))
    met = [F.col(name) == F.col(f"{name}_otro") for name in by]
    return marked.join(other.hint("shuffle_hash"), [*met, alike("marca"), alike(key)], "left").drop(
        "marca", "marca_otro", f"{key}_otro", *[f"{name}_otro" for name in by])


def noise_lineage(layer1: DataFrame, layer2: DataFrame, log: DataFrame, together: bool = False) -> DataFrame:
    """Every log row with the layer-1 and layer-2 turns it links, joined by id: layer 2 is
    renumbered, the log keeps layer-1 numbers.

    ``together``: all three are dealt out by patient, few turns for each, the log has ``paciente_id`` too, and an id
    belongs to one patient. No row is moved then.
    """
    by = ["paciente_id"] if together else []
    clean = layer1.select(
        *by, F.col("dialogo_id").alias("dialogo_id_capa1"), F.col("turno_idx").alias("turno_capa1"),
        F.col("hablante").alias("hablante_capa1"), F.col("texto").alias("texto_capa1"),
        F.col("label_ground_truth").alias("label_capa1"))
    noisy = layer2.select(
        *by, F.col("dialogo_id").alias("dialogo_id_capa2"), F.col("turno_idx").alias("turno_capa2"),
        F.col("hablante").alias("hablante_capa2"), F.col("texto").alias("texto_capa2"),
        F.col("label_ground_truth").alias("label_capa2"))
    linked = _linked(_linked(log, noisy, "dialogo_id_capa2", by), clean, "dialogo_id_capa1", by)
    return linked.select(
        "mapping_id", "dialogo_id_capa1", "dialogo_id_capa2", "tipo_ruido", "turno_idx_afectado", "turno_capa1",
        "turno_capa2", "hablante_capa1", "hablante_capa2",
        F.col("texto_original").eqNullSafe(F.col("texto_capa1")).alias("original_igual"),
        F.col("texto_ruidoso").eqNullSafe(F.col("texto_capa2")).alias("ruidoso_igual"),
        F.col("label_capa1").eqNullSafe(F.col("label_capa2")).alias("label_igual"),
    )
