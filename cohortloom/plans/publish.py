"""Audience views over the dialogue layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.contracts import LAYER1
from cohortloom.plans.quality import gate
from cohortloom.sources.catalog import CatalogTable
from cohortloom.sources.layout import Layout

VIEW_COLUMNS = [
    "dialogo_id", "caso_id", "paciente_id", "dia_postop", "turno_idx", "hablante", "texto", "label_ground_truth",
    "estilo_paciente", "modelo_paciente", "modelo_agente",
]
VIEW_SCHEMA = T.StructType([
    *[LAYER1.schema[name] for name in VIEW_COLUMNS], T.StructField("capa", T.StringType(), False),
    LAYER1.schema["generado_ts"]])
PARTICIPANTS, COMMITTEE = "dataset_final", "dataset_final_completo"


def _tagged(layer: DataFrame, tag: str) -> DataFrame:
    return layer.select(*VIEW_COLUMNS, F.lit(tag).alias("capa"), "generado_ts")


def participant_view(layer1: DataFrame, layer2: DataFrame) -> DataFrame:
    return _tagged(layer1, "capa1_limpia").unionByName(_tagged(layer2, "capa2_ruidosa"))


def committee_view(layer1: DataFrame, layer2: DataFrame, layer3: DataFrame) -> DataFrame:
    layers = [_tagged(layer1, "capa1_limpia"), _tagged(layer2, "capa2_ruidosa"), _tagged(layer3, "capa3_limite")]
    return reduce(DataFrame.unionByName, layers)


def audience_leak(participants: DataFrame, layer3: DataFrame) -> DataFrame:
    """Count of participant rows that carry a layer-3 id; must be 0."""
    return participants.join(layer3.select("dialogo_id"), "dialogo_id", "left_semi").agg(
        F.count(F.lit(1)).alias("filas_capa3_visibles"))


def gold_tables(spark: SparkSession, layout: Layout) -> tuple[CatalogTable, CatalogTable]:
    """What participants and the committee read, each in the database of its audience."""
    return tuple(
        CatalogTable(spark, layout.session_name(layer, name), layout.path(layer, name), VIEW_SCHEMA)
        for layer, name in (("gold_participantes", PARTICIPANTS), ("gold_comite", COMMITTEE)))


def write_gold(spark: SparkSession, layout: Layout, layer1: DataFrame, layer2: DataFrame, layer3: DataFrame) -> None:
    """Write both audience tables, each visible by one switch. What has been published does not change while the
    layers are built again."""
    participants, committee = gold_tables(spark, layout)
    participants.replace(participant_view(layer1, layer2))
    committee.replace(committee_view(layer1, layer2, layer3))


def publish(spark: SparkSession, layout: Layout, report: DataFrame, layer1: DataFrame, layer2: DataFrame,
            layer3: DataFrame) -> list[str]:
    """``write_gold`` once the gate has passed; returns the advisory checks that failed."""
    advisories = gate(report)
    write_gold(spark, layout, layer1, layer2, layer3)
    return advisories
