"""Summaries over the generated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions.constants import constant_table
from cohortloom.functions.text import word_count_sql
from cohortloom.operators.adaptation import department_weights
from cohortloom.operators.profiles import CALIBRATION_SCHEMA
from cohortloom.settings import Settings


def complication_rate(profiles: DataFrame) -> DataFrame:
    """Observed against calibrated complication rate per module."""
    calibration = constant_table(profiles.sparkSession, ref.CALIBRATION, CALIBRATION_SCHEMA)
    observed = profiles.groupBy("modulo_synthea").agg(
        F.count(F.lit(1)).alias("pacientes"),
        F.sum(F.col("complicacion_encounter").cast("long")).alias("complicados"))
    rate = F.col("complicados") / F.col("pacientes")
    return observed.join(F.broadcast(calibration), "modulo_synthea").select(
        "modulo_synthea", "pacientes", "complicados", rate.alias("tasa"), "p_complicacion",
        (F.abs(rate - F.col("p_complicacion")) <= 0.04).alias("en_tolerancia"))


def comorbidity_rate(profiles: DataFrame) -> DataFrame:
    """Patients with each comorbidity of their module's pool, and their share."""
    calibration = constant_table(profiles.sparkSession, ref.CALIBRATION, CALIBRATION_SCHEMA)
    seen = profiles.groupBy("modulo_synthea").agg(F.count(F.lit(1)).alias("pacientes"))
    held = profiles.select("modulo_synthea", F.explode("comorbilidades").alias("comorbilidad")).groupBy(
        "modulo_synthea", "comorbilidad").agg(F.count(F.lit(1)).alias("con"))
    items = calibration.select("modulo_synthea", F.explode("pool").alias("comorbilidad"))
    holders = F.coalesce("con", F.lit(0))
    return items.join(held, ["modulo_synthea", "comorbilidad"], "left").join(seen, "modulo_synthea").select(
        "modulo_synthea", "comorbilidad", "pacientes", holders.alias("con"), (holders / F.col("pacientes")).alias("tasa"))


def geo_weights(adapted: DataFrame) -> DataFrame:
    """Weight, share range and observed patients of all 33 departments."""
    seen = adapted.groupBy("departamento").agg(F.count(F.lit(1)).alias("pacientes"))
    return department_weights(adapted.sparkSession).join(seen, "departamento", "left").select(
        "departamento", "ciudad", "poblacion", "peso", "desde", "hasta",
        F.coalesce("pacientes", F.lit(0)).alias("pacientes"))


def geo_distribution(adapted: DataFrame) -> DataFrame:
    """Concentration: share of the capital, its weight, number of departments that occur."""
    capital, _, people = ref.DEPARTMENTS[0]
    weight = people / sum(row[2] for row in ref.DEPARTMENTS)
    per_department = adapted.groupBy("departamento").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n_capital") / F.col("pacientes")
    return per_department.agg(
        F.sum("n").alias("pacientes"),
        F.coalesce(F.sum(F.when(F.col("departamento") == capital, F.col("n"))), F.lit(0)).alias("n_capital"),
        F.count(F.lit(1)).alias("departamentos"),
    ).select(
        "pacientes", "n_capital", "departamentos", share.alias("proporcion_capital"),
        (share < 2.5 * weight).alias("concentracion_ok"), (F.col("departamentos") >= 10).alias("dispersion_ok"))


def archetype_mix(trajectories: DataFrame, first_day: int) -> DataFrame:
    """Patients per archetype. A patient keeps one archetype, so counting the rows of the
    first call day counts patients without a distinct shuffle."""
    return trajectories.where(F.col("dia_postop") == first_day).groupBy("arquetipo_trayectoria").agg(
        F.count(F.lit(1)).alias("pacientes"))


def noise_summary(annotated: DataFrame) -> DataFrame:
    """Affected turns per type and intensity with subtotals, inserted rows, share of all turns.

    One pass: turns without noise are counted beside the others, so the total is that of the grand
    total row, which the last step hands to the at most 40 rows of the summary.
    """
    third = (F.col("tipo_ruido") == ref.THIRD_PARTY).cast("long")
    per_type = annotated.groupBy("tipo_ruido", "intensidad").agg(
        F.count(F.lit(1)).alias("filas"), F.coalesce(F.sum(third), F.lit(0)).alias("n_insertadas"))
    touched = F.when(F.col("tipo_ruido").isNotNull(), F.col("filas")).otherwise(0)
    summed = per_type.withColumn("n", touched).rollup("tipo_ruido", "intensidad").agg(
        F.sum("n").alias("afectados"), F.sum("n_insertadas").alias("insertadas"), F.sum("filas").alias("filas"),
        F.grouping_id().cast("int").alias("nivel"))
    whole = Window.partitionBy(F.lit(0))
    return summed.withColumn("turnos", F.max("filas").over(whole)).where("nivel = 3 or tipo_ruido is not null").select(
        F.coalesce("tipo_ruido", F.lit("TOTAL")).alias("tipo_ruido"),
        F.coalesce("intensidad", F.lit(0)).alias("intensidad"), "nivel", "afectados", "insertadas",
        (F.col("afectados") / F.col("turnos")).alias("proporcion"))


AUDIT_SETS = {"tipo_ruido": ("tipo_ruido",), "hablante": ("hablante",), "estilo": ("estilo_paciente",),
              "label": ("label_ground_truth",), "tipo_y_label": ("tipo_ruido", "label_ground_truth"), "total": ()}


def noise_audit(annotated: DataFrame) -> DataFrame:
    """Turns, noise and tokens by type, by speaker, by style, by label, by type and label, and in all.

    One pass over the annotated turns, folded to one row per combination of the four values before the
    shuffle; the grouping sets are taken of those few rows. Tokens are those of a conversation, counted on
    its first patient turn only.
    """
    keys = ["tipo_ruido", "hablante", "estilo_paciente", "label_ground_truth"]
    words = lambda name: F.sum(F.expr(word_count_sql(name)).cast("long"))
    touched = F.col("tipo_ruido").isNotNull()
    first = F.col("turno_idx") == 1
    folded = annotated.groupBy(F.coalesce("tipo_ruido", F.lit("ninguno")).alias("tipo_ruido"), *keys[1:]).agg(
        F.count(F.lit(1)).alias("turnos"), F.count_if(touched).alias("afectados"),
        F.count_if(F.col("tipo_ruido") == ref.THIRD_PARTY).alias("insertados"),
        words("texto").alias("palabras"),
        F.coalesce(words("texto_ruidoso"), F.lit(0)).alias("palabras_ruidosas"),
        F.coalesce(F.sum(F.when(first, F.col("prompt_tokens").cast("long"))), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum(F.when(first, F.col("completion_tokens").cast("long"))), F.lit(0)).alias("completion_tokens"))
    measures = ["turnos", "afectados", "insertados", "palabras", "palabras_ruidosas", "prompt_tokens", "completion_tokens"]
    sets = [[F.col(name) for name in names] for names in AUDIT_SETS.values()]
    # the grouping id has a bit for each key that is left out, the first key's highest
    ids = {name: sum(2 ** (len(keys) - 1 - at) for at, key in enumerate(keys) if key not in names)
           for name, names in AUDIT_SETS.items()}
    audited = folded.groupingSets(sets, *keys).agg(
        *[F.sum(name).alias(name) for name in measures], F.grouping_id().alias("gid"))
    which = F.coalesce(*[F.when(F.col("gid") == gid, name) for name, gid in ids.items()])
    return audited.select(
        which.alias("conjunto"), *[F.coalesce(key, F.lit("-")).alias(key) for key in keys], *measures,
        (F.col("afectados") / F.col("turnos")).alias("proporcion"))


SKETCH_BITS = 14  # relative standard error 1.04 / sqrt(2 ** SKETCH_BITS): 0.8%
SKETCH_SIGMAS = 4


def daily_sketches(cases: DataFrame, identity: str) -> DataFrame:
    """Mergeable state of the distinct ids of each call day (at most some 16 KB a day, whatever the rows)."""
    return cases.groupBy("dia_postop").agg(F.hll_sketch_agg(identity, SKETCH_BITS).alias("estado"))


def distinct_from_sketches(states: DataFrame, cases: DataFrame, identity: str) -> DataFrame:
    """Distinct ids per day and over all days (``dia_postop`` -1): ``exacto``, whether the estimate of the stored state lies
    within its stated error, and whether the merged states equal the state of one pass over all rows.

    The exact count is for reference; the estimate alone needs no further look at the rows.
    """
    merged = lambda column: F.hll_union_agg(column)
    per_day = states.groupBy("dia_postop").agg(merged("estado").alias("unido"))
    overall = states.agg(merged("estado").alias("unido")).select(F.lit(-1).alias("dia_postop"), "unido")
    fresh_day = daily_sketches(cases, identity).groupBy("dia_postop").agg(merged("estado").alias("nuevo"))
    fresh_all = cases.agg(F.hll_sketch_agg(identity, SKETCH_BITS).alias("estado")).agg(merged("estado").alias("nuevo")).select(
        F.lit(-1).alias("dia_postop"), "nuevo")
    exact = cases.groupBy("dia_postop").agg(F.countDistinct(identity).alias("exacto")).unionByName(
        cases.agg(F.countDistinct(identity).alias("exacto")).select(F.lit(-1).alias("dia_postop"), "exacto"))
    bound = SKETCH_SIGMAS * 1.04 / 2 ** (SKETCH_BITS / 2)
    # A state that was never merged also keeps an estimate that depends on the order of rows; merged with itself it
    # is estimated from its registers alone, as merged states are.
    estimate, fresh = (F.hll_sketch_estimate(F.hll_union(state, state)) for state in ("unido", "nuevo"))
    return per_day.unionByName(overall).join(fresh_day.unionByName(fresh_all), "dia_postop").join(exact, "dia_postop").select(
        "dia_postop", "exacto", (F.abs(estimate - F.col("exacto")) <= bound * F.col("exacto")).alias("en_error"),
        (estimate == fresh).alias("igual_a_una_pasada"))


def unchanged_noise(log: DataFrame) -> DataFrame:
    """Log rows whose noise left the text as it was.

    The test is a generated column: as a plain filter it would be moved below the noise, with the whole noise
    written out again for each place where it names the text, the type or a draw.
    """
    same = F.explode(F.array(F.col("texto_original").eqNullSafe(F.col("texto_ruidoso")))).alias("igual")
    return log.select("mapping_id", "tipo_ruido", "turno_idx_afectado", same).where("igual").drop("igual")


def token_projection(totals: DataFrame, pending: DataFrame, price_prompt: float, price_completion: float) -> DataFrame:
    """Mean tokens per finished conversation x pending cases x price per million tokens."""
    done = totals.agg(
        F.count(F.lit(1)).alias("conversaciones"), F.sum("prompt_tokens").alias("p"), F.sum("completion_tokens").alias("c"))
    left = pending.agg(F.count(F.lit(1)).alias("pendientes")).scalar()
    mean_p, mean_c = F.col("p") / F.col("conversaciones"), F.col("c") / F.col("conversaciones")
    means = done.select("conversaciones", left.alias("pendientes"), mean_p.alias("prompt_medio"),
                        mean_c.alias("completion_medio"))
    planned_p, planned_c = F.col("prompt_medio") * F.col("pendientes"), F.col("completion_medio") * F.col("pendientes")
    return means.select(
        "*", planned_p.alias("prompt_previsto"), planned_c.alias("completion_previsto"),
        ((planned_p * price_prompt + planned_c * price_completion) / 1000000.0).alias("costo_previsto"))


def last_call(cases: DataFrame) -> DataFrame:
    return cases.groupBy("paciente_id").agg(
        F.max("dia_postop").alias("ultimo_dia"), F.max_by("label", "dia_postop").alias("ultimo_label"))


def red_persistence(cases: DataFrame) -> DataFrame:
    """First red call per patient and whether every later call is red too: the last call that
    is not red must come before it. One aggregation instead of a window."""
    red = F.col("label") == "rojo"
    return cases.groupBy("paciente_id").agg(
        F.min(F.when(red, F.col("dia_postop"))).alias("primer_rojo"),
        F.max(F.when(~red, F.col("dia_postop"))).alias("ultimo_no_rojo"),
        F.sum(red.cast("long")).alias("llamadas_rojas"),
    ).select(
        "paciente_id", F.coalesce("primer_rojo", F.lit(-1)).alias("primer_rojo"), "llamadas_rojas",
        F.coalesce(F.col("primer_rojo") > F.col("ultimo_no_rojo"), F.lit(True)).alias("persistente"))


def label_leak(texts: DataFrame) -> DataFrame:
    """Texts that contain their own label word, counted per source and label; ``texts`` has
    ``fuente, label, texto``."""
    leaks = F.contains(F.lower("texto"), F.col("label"))
    return texts.groupBy("fuente", "label").agg(
        F.count(F.lit(1)).alias("textos"), F.sum(leaks.cast("long")).alias("con_label"))
