"""Prompts of many templates: pieces as arrays, values as a map, one render expression for all of them.

A template is a row (``modulo``, ``rol``, ``plantilla``) with slots ``{{name}}``. All templates are data, so a
new one needs no new plan. A value that looks like a slot stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_pieces(templates: DataFrame) -> DataFrame:
    """``templates`` with ``piezas``: text and slot names in turn, starting and ending with text. A slot that is
    not closed is text."""
    opened = F.split("plantilla", r"\{\{(?=[^{}]*\}\})", -1)
    parts = F.transform(opened, lambda part, at: F.when(at == 0, F.array(part)).otherwise(F.array(
        F.trim(F.substring_index(part, "}}", 1)),
        F.substring(part, F.instr(part, "}}") + 2, F.length(part)))))
    return templates.withColumn("piezas", F.flatten(parts))


def slot_names(pieces: Column) -> Column:
    return F.filter(pieces, lambda _, at: at % 2 == 1)


def _joined(cases: DataFrame, templates: DataFrame) -> DataFrame:
    return cases.join(with_pieces(templates).drop("plantilla"), "modulo")


def render(cases: DataFrame, templates: DataFrame) -> DataFrame:
    """One row per case and template of its module: ``caso_id``, ``modulo``, ``rol``, ``prompt``, ``sin_valor`` (slots that
    have no value, which stay empty in the text). ``cases`` has ``caso_id``, ``modulo``, ``valores`` (a map of
    texts). A case whose module has no template gives no row; see ``unmatched``."""
    text = F.transform("piezas", lambda piece, at: F.when(at % 2 == 0, piece).otherwise(
        F.coalesce(F.try_element_at("valores", piece), F.lit(""))))
    missing = F.array_distinct(F.filter(slot_names(F.col("piezas")), lambda name: F.try_element_at("valores", name).isNull()))
    return _joined(cases, templates).select(
        "caso_id", "modulo", "rol", F.array_join(text, "").alias("prompt"), missing.alias("sin_valor"))


def unknown_slots(cases: DataFrame, templates: DataFrame) -> DataFrame:
    """Slots without a value: module, role, slot and how many cases lack it, so bad templates are rows and no error."""
    lacking = render(cases, templates).select("modulo", "rol", F.explode("sin_valor").alias("casilla"))
    return lacking.groupBy("modulo", "rol", "casilla").agg(F.count(F.lit(1)).alias("casos"))


def unmatched(cases: DataFrame, templates: DataFrame) -> DataFrame:
    """Modules of ``cases`` that no template knows, with their cases."""
    counted = cases.groupBy("modulo").agg(F.count(F.lit(1)).alias("casos"))
    return counted.join(templates.select("modulo").distinct(), "modulo", "left_anti")
