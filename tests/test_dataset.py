from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_quality import SUBMISSION, submission

from cohortloom import Settings, contracts
from cohortloom.operators.sets import content_difference
from cohortloom.plans import publish
from cohortloom.plans.dataset import Dataset
from cohortloom.plans.quality import QualityGateError
from cohortloom.sources.layout import Layout
from cohortloom.sources.workspace import new_folder


def entities(spark, n):
    return spark.range(n).withColumnRenamed("id", "indice")


def test_build_publish_and_grow(spark):
    data = Dataset(spark, Layout(new_folder(spark, "dataset"), "prueba"), Settings(catalog="prueba"))
    data.build(entities(spark, 20))
    for contract in (contracts.PROFILES, contracts.TRAJECTORIES, contracts.ADAPTED, contracts.CASES, contracts.LAYER2,
                     contracts.NOISE_LOG, contracts.ALERTS):
        stored = data.table(contract)
        assert contracts.schema_differences(stored, contract) == []
        assert contracts.violations(stored, contract).agg(F.sum("n_violaciones")).first()[0] == 0
    layer1 = data.table(contracts.LAYER1).cache()
    assert layer1.count() == 20 * 4 * 12
    third = data.table(contracts.LAYER2).where("hablante = 'tercero'").count()
    other = spark.newSession()  # the audience tables are names of the catalog, not of one session
    names = [table.name for table in publish.gold_tables(spark, data.layout)]
    assert names == ["prueba_gold_participantes.dataset_final", "prueba_gold_comite.dataset_final_completo"]
    for name in names:
        assert other.table(name).count() == 2 * layer1.count() + third

    rejected, _ = data.add_edge_cases(spark.createDataFrame([submission(), submission(validado_por="")], SUBMISSION))
    assert rejected.count() == 1
    data.publish()
    assert other.table(names[1]).where("capa = 'capa3_limite'").count() == 2
    assert other.table(names[0]).where("dialogo_id = 't0'").isEmpty()

    alerts_before = data.table(contracts.ALERTS).count()
    later = Dataset(spark, data.layout, replace(data.settings, run_ts=datetime(2026, 2, 2)))
    later.build(entities(spark, 30))
    grown = later.table(contracts.LAYER1)
    assert grown.count() == 30 * 4 * 12
    old = grown.join(layer1.select("dialogo_id"), "dialogo_id", "left_semi")
    assert tuple(content_difference(old.select(*layer1.columns), layer1).first()) == (0, 0)  # finished cases untouched
    assert later.table(contracts.ALERTS).count() >= alerts_before


def test_a_broken_table_is_not_published(spark):
    data = Dataset(spark, Layout(new_folder(spark, "dataset"), "rota"), Settings())

    def speechless(context):
        from cohortloom.operators.dialogues import template_turns
        return template_turns(context, data.settings).withColumn(
            "texto", F.when(F.col("turno_idx") == 3, " ").otherwise(F.col("texto")))

    with pytest.raises(QualityGateError, match="capa1_turno_vacio"):
        data.build(entities(spark, 3), speechless)
    assert not any(table.exists() for table in publish.gold_tables(spark, data.layout))
