"""Quality checks, the publication gate and the alert rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions.text import is_blank, percent_text
from cohortloom.operators.dialogues import AGENT, PATIENT
from cohortloom.settings import Settings

BLOCKING, ADVISORY = "bloqueante", "advertencia"
BALANCE_CHECK = "casos_clinicos_etiquetados_balance"


def _some_demographic_empty() -> Column:
    """Null or empty; a field of blanks passes."""
    return reduce(or_, [F.coalesce(F.col(c), F.lit("")) == "" for c in ref.ADAPTED_FIELDS])


def _other_country() -> Column:
    return ~F.col("adapted_country").eqNullSafe("CO")


def demographic_violations(adapted: DataFrame) -> DataFrame:
    """One row per patient and problem."""
    problems = F.array(
        F.when(_some_demographic_empty(), "campo_demografico_nulo"), F.when(_other_country(), "pais_distinto_de_CO"))
    return adapted.select("paciente_id", F.explode(F.array_compact(problems)).alias("problema"))


def blank_turns(layer1: DataFrame) -> DataFrame:
    return layer1.where(is_blank(F.col("texto"))).select("dialogo_id", "caso_id")


def speaker_coverage(layer1: DataFrame) -> DataFrame:
    """Per case: whether both speakers occur. Grouped with partial aggregation, so a case
    of any size reaches the reducer as one row per map task."""
    return layer1.groupBy("caso_id").agg(
        F.coalesce(F.bool_or(F.col("hablante") == PATIENT), F.lit(False)).alias("con_paciente"),
        F.coalesce(F.bool_or(F.col("hablante") == AGENT), F.lit(False)).alias("con_agente"),
        F.count(F.lit(1)).alias("turnos"),
        F.sum(is_blank(F.col("texto")).cast("long")).alias("turnos_vacios"),
    )


def silent_changes(layer2: DataFrame, log: DataFrame) -> DataFrame:
    """Ids of touched layer-2 rows that the change log does not know."""
    touched = layer2.where(F.col("intensidad_ruido").isNotNull()).select("dialogo_id").distinct()
    logged = log.select(F.col("dialogo_id_capa2").alias("dialogo_id"))
    return touched.join(logged, "dialogo_id", "left_anti")


def unreviewed_cases(layer3: DataFrame) -> DataFrame:
    return layer3.where(F.coalesce(F.col("validado_por"), F.lit("")) == "").select("dialogo_id", "caso_id")


def label_drift(layer1: DataFrame, layer2: DataFrame) -> DataFrame:
    """Layer-2 rows whose label is not that of their layer-1 turn."""
    clean = layer1.select(F.col("dialogo_id").alias("dialogo_id_capa1"), F.col("label_ground_truth").alias("label_capa1"))
    noisy = layer2.select("dialogo_id", "dialogo_id_capa1", F.col("label_ground_truth").alias("label_capa2"))
    return noisy.join(clean, "dialogo_id_capa1").where(~F.col("label_capa1").eqNullSafe(F.col("label_capa2")))


def label_balance(
    rows: DataFrame, settings: Settings, column: str = "label", domain: list[str] | None = None, by: tuple[str, ...] = (),
    weight: str | None = None,
) -> DataFrame:
    """Share of every domain value (absent = 0%); other values count in the total only.

    One aggregation with a conditional count per value. No rows, no shares. ``weight`` is the column that says how
    many rows a folded one stands for.
    """
    domain = list(ref.LABELS) if domain is None else domain
    filas = F.col(weight) if weight else F.lit(1).cast("long")
    counts = [F.sum(F.when(F.col(column) == value, filas).otherwise(0)).alias(f"n{at}")
              for at, value in enumerate(domain)]
    total = F.sum(filas) if weight else F.count(F.lit(1))
    totals = rows.groupBy(*by).agg(total.alias("total"), *counts).where(F.col("total") > 0)
    shares = totals.select(*by, "total", F.inline(F.array(*[
        F.struct(F.lit(at).alias("orden"), F.lit(value).alias("label"), F.col(f"n{at}").alias("n"))
        for at, value in enumerate(domain)
    ])))
    share = F.col("n") / F.col("total")
    return shares.select(
        *by, "orden", "label", "n", "total", share.alias("proporcion"),
        share.between(settings.min_share, settings.max_share).alias("en_rango"),
    )


def balance_details(balance: DataFrame, settings: Settings) -> DataFrame:
    """Out-of-range shares as messages (fixed wording), kept in reading order by ``orden``."""
    band = f"[{settings.min_share:.0%},{settings.max_share:.0%}]"
    message = F.concat(
        F.lit("casos_clinicos_etiquetados: label '"), "label", F.lit(f"' fuera de rango {band} ("),
        percent_text(F.col("n"), F.col("total")), F.lit(")"))
    return balance.where(~F.col("en_rango")).select("orden", message.alias("detalle"))


def alert_rows(details: DataFrame, settings: Settings, run_ts: datetime, order: list[str] | None = None) -> DataFrame:
    """Numbered alert rows of one run. The numbering window has no key: its input is bounded
    by the label domain (times the call days), never by the data."""
    order = order or ["orden"]
    key = F.lit(run_ts.strftime("%Y%m%dT%H%M%S%f"))
    number = F.row_number().over(Window.orderBy(*order)) - 1
    return details.select(
        F.concat(F.lit("alerta_"), key, F.lit("_"), number.cast("string")).alias("alerta_id"),
        F.lit(BALANCE_CHECK).alias("check_nombre"),
        "detalle",
        F.lit(ADVISORY).alias("severidad"),
        F.lit(settings.catalog).alias("catalog_run"),
        F.lit(run_ts).alias("generado_ts"),
    )


def _problem_count(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0))


def _report_rows(counts: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    return counts.select("filas", F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_nombre"), F.lit(severity).alias("severidad"),
                 problems.cast("long").alias("problemas"))
        for name, severity, problems in checks
    ])))


def quality_report(
    adapted: DataFrame, cases: DataFrame, layer1: DataFrame, layer2: DataFrame, log: DataFrame, layer3: DataFrame,
    settings: Settings,
) -> DataFrame:
    """Every check as one row: ``check_nombre, severidad, filas, problemas``.

    Each table is read in one aggregation; only the change-log check needs a join.
    """
    rows = F.count(F.lit(1)).alias("filas")
    empty = (F.col("filas") == 0).cast("long")
    n = F.col

    adapted_counts = adapted.agg(
        rows, _problem_count(_some_demographic_empty()).alias("nulos"), _problem_count(_other_country()).alias("pais"))
    case_counts = cases.agg(rows, *[_problem_count(F.col("label") == v).alias(v) for v in ref.LABELS])
    off_balance = [
        F.when(n("filas") > 0, (~(n(v) / n("filas")).between(settings.min_share, settings.max_share)).cast("long"))
        .otherwise(0) for v in ref.LABELS
    ]
    layer1_counts = speaker_coverage(layer1).agg(
        F.coalesce(F.sum("turnos"), F.lit(0)).alias("filas"),
        F.coalesce(F.sum("turnos_vacios"), F.lit(0)).alias("vacios"),
        _problem_count(~(F.col("con_paciente") & F.col("con_agente"))).alias("un_hablante"))
    silent = silent_changes(layer2, log).agg(F.count(F.lit(1)).alias("silenciosos"))
    layer2_counts = layer2.agg(rows)
    layer3_counts = layer3.agg(rows, _problem_count(F.coalesce("validado_por", F.lit("")) == "").alias("sin_revisor"))

    parts = [
        _report_rows(adapted_counts, [
            ("perfiles_co_vacia", BLOCKING, empty), ("perfiles_co_nulos", BLOCKING, n("nulos")),
            ("perfiles_co_pais", BLOCKING, n("pais"))]),
        _report_rows(case_counts, [
            ("casos_vacia", BLOCKING, empty), ("casos_balance", ADVISORY, off_balance[0] + off_balance[1] + off_balance[2])]),
        _report_rows(layer1_counts, [
            ("capa1_vacia", ADVISORY, empty), ("capa1_turno_vacio", BLOCKING, n("vacios")),
            ("capa1_un_hablante", BLOCKING, n("un_hablante"))]),
        _report_rows(layer2_counts, [("capa2_vacia", ADVISORY, empty)]),
        _report_rows(silent.withColumn("filas", n("silenciosos")), [
            ("capa2_cambio_silencioso", BLOCKING, (n("silenciosos") > 0).cast("long"))]),
        _report_rows(layer3_counts, [("capa3_sin_revisor", BLOCKING, n("sin_revisor"))]),
    ]
    return reduce(DataFrame.unionByName, parts).select("check_nombre", "severidad", "filas", "problemas")


class QualityGateError(RuntimeError):
    """A blocking check failed; nothing may be published."""


def gate(report: DataFrame) -> list[str]:
    """Raise on any blocking problem; return the failed advisory checks.

    Collects the report, which has one row per check.
    """
    failed = report.where(F.col("problemas") > 0).collect()
    blocking = [f"{r['check_nombre']}: {r['problemas']}" for r in failed if r["severidad"] == BLOCKING]
    if blocking:
        raise QualityGateError("; ".join(sorted(blocking)))
    return sorted(r["check_nombre"] for r in failed)
