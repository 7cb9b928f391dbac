from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom import Settings, contracts
from cohortloom.operators import curation
from cohortloom.plans import publish, quality
from cohortloom.sources.layout import Layout
from cohortloom.sources.tables import with_schema
from cohortloom.sources.workspace import new_folder

RUN = datetime(2026, 7, 15, 1, 2, 3, 45)
TURN = ("caso_id", "paciente_id", "dia_postop", "turno_idx", "hablante", "texto", "label_ground_truth",
        "estilo_paciente", "modelo_paciente", "modelo_agente")


def table(spark, contract, rows):
    """Rows given as dicts; columns left out get a harmless value."""
    filler = {"string": "x", "int": 1, "double": 1.0, "timestamp": RUN, "boolean": True, "array<string>": ["x"]}
    names = contract.schema.names
    values = [tuple({**{f.name: filler[f.dataType.simpleString()] for f in contract.schema.fields}, **row}[n] for n in names)
              for row in rows]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in contract.schema.fields)
    return with_schema(spark.createDataFrame(values, schema), contract.schema)


def good(spark):
    both = [{"dialogo_id": f"d{i}", "caso_id": "c", "hablante": h, "turno_idx": i, "label_ground_truth": "verde"}
            for i, h in enumerate(("agente", "paciente"))]
    return {
        "adapted": table(spark, contracts.ADAPTED, [{"paciente_id": f"p{i}", "adapted_country": "CO"} for i in range(3)]),
        "cases": table(spark, contracts.CASES, [{"caso_id": f"c{i}", "label": x} for i, x in
                                                enumerate(["verde"] * 4 + ["amarillo"] * 3 + ["rojo"] * 3)]),
        "layer1": table(spark, contracts.LAYER1, both),
        "layer2": table(spark, contracts.LAYER2, [
            {**t, "dialogo_id": t["dialogo_id"] + "_c2", "dialogo_id_capa1": t["dialogo_id"],
             "intensidad_ruido": (None, 3)[at]} for at, t in enumerate(both)]),
        "log": table(spark, contracts.NOISE_LOG, [{"dialogo_id_capa1": "d1", "dialogo_id_capa2": "d1_c2", "intensidad": 3}]),
        "layer3": table(spark, contracts.LAYER3, [
            {"dialogo_id": "l1", "categoria_caso_limite": "alarma_real", "label_ground_truth": "rojo"}]),
    }


def problems(tables) -> dict[str, int]:
    report = quality.quality_report(**tables, settings=Settings())
    return {r["check_nombre"]: r["problemas"] for r in report.collect() if r["problemas"]}


def test_good_tables_pass_and_publish(spark):
    tables = good(spark)
    assert problems(tables) == {}
    report = quality.quality_report(**tables, settings=Settings())
    layout = Layout(new_folder(spark, "gold"), "buena")
    assert publish.publish(spark, layout, report, tables["layer1"], tables["layer2"], tables["layer3"]) == []
    participants, committee = publish.gold_tables(spark, layout)
    seen = participants.read()
    assert len(seen.columns) == 13 and seen.count() == 4
    assert committee.read().groupBy("capa").count().count() == 3
    assert publish.audience_leak(seen, tables["layer3"]).first()[0] == 0


@pytest.mark.parametrize("name, change, check", [
    ("adapted", lambda t: t.where("false"), "perfiles_co_vacia"),
    ("adapted", lambda t: t.withColumn("eps", F.lit(None).cast("string")), "perfiles_co_nulos"),
    ("adapted", lambda t: t.withColumn("ciudad", F.lit("")), "perfiles_co_nulos"),
    ("adapted", lambda t: t.withColumn("adapted_country", F.lit("US")), "perfiles_co_pais"),
    ("adapted", lambda t: t.withColumn("adapted_country", F.lit(None).cast("string")), "perfiles_co_pais"),
    ("cases", lambda t: t.where("false"), "casos_vacia"),
    ("layer1", lambda t: t.withColumn("texto", F.lit(" \t")), "capa1_turno_vacio"),
    ("layer1", lambda t: t.where("hablante = 'agente'"), "capa1_un_hablante"),
    ("log", lambda t: t.where("false"), "capa2_cambio_silencioso"),
    ("layer3", lambda t: t.withColumn("validado_por", F.lit(None).cast("string")), "capa3_sin_revisor"),
    ("layer3", lambda t: t.withColumn("validado_por", F.lit("")), "capa3_sin_revisor"),
])
def test_each_blocking_check(spark, name, change, check):
    tables = good(spark)
    tables[name] = change(tables[name])
    assert set(problems(tables)) == {check}
    with pytest.raises(quality.QualityGateError, match=check):
        quality.gate(quality.quality_report(**tables, settings=Settings()))


def test_blank_demographics_pass_and_empty_layers_only_warn(spark):
    tables = good(spark)
    tables["adapted"] = tables["adapted"].withColumn("eps", F.lit("  "))
    tables["layer1"], tables["layer2"] = tables["layer1"].where("false"), tables["layer2"].where("false")
    assert problems(tables) == {"capa1_vacia": 1, "capa2_vacia": 1}
    assert quality.gate(quality.quality_report(**tables, settings=Settings())) == ["capa1_vacia", "capa2_vacia"]


@pytest.mark.parametrize("counts, outside", [
    ((40, 30, 30, 0), []), ((95, 3, 2, 0), ["verde", "amarillo", "rojo"]), ((74, 20, 6, 0), []),
    ((76, 21, 3, 0), ["verde", "rojo"]), ((75, 20, 5, 0), []), ((60, 40, 0, 0), ["rojo"]), ((0, 0, 0, 0), []),
    ((40, 30, 4, 26), ["rojo"]),
])
def test_balance_band(spark, counts, outside):
    labels = [x for x, n in zip(("verde", "amarillo", "rojo", "otro"), counts) for _ in range(n)]
    balance = quality.label_balance(spark.createDataFrame([(x,) for x in labels], "label string"), Settings())
    assert [r["label"] for r in balance.where("NOT en_rango").orderBy("orden").collect()] == outside


def test_alerts(spark):
    labels = spark.createDataFrame([("verde",)] * 95 + [("amarillo",)] * 3 + [("rojo",)] * 2, "label string")
    details = quality.balance_details(quality.label_balance(labels, Settings()), Settings())
    rows = quality.alert_rows(details, Settings(catalog="corrida"), RUN).orderBy("alerta_id").collect()
    assert [r["alerta_id"] for r in rows] == [f"alerta_20260715T010203000045_{i}" for i in range(3)]
    assert rows[0]["detalle"] == "casos_clinicos_etiquetados: label 'verde' fuera de rango [5%,75%] (95.0%)"
    assert {(r["severidad"], r["catalog_run"], r["generado_ts"]) for r in rows} == {("advertencia", "corrida", RUN)}
    none = quality.alert_rows(details.where("false"), Settings(), RUN)
    assert none.isEmpty()


def test_contract_rules(spark):
    rows = [{"label_ground_truth": "verde", "intensidad_ruido": i} for i in (None, 1, 5, 6)]
    rows += [{"label_ground_truth": "azul", "intensidad_ruido": 1}]
    found = contracts.violations(table(spark, contracts.LAYER2, rows).withColumn(
        "texto", F.when(F.col("intensidad_ruido") == 5, None).otherwise(F.col("texto"))), contracts.LAYER2)
    assert {r["regla"]: r["n_violaciones"] for r in found.collect() if r["n_violaciones"]} == {
        "label_valido": 1, "intensidad_valida": 1, "no_nulo:texto": 1}
    assert contracts.schema_differences(table(spark, contracts.LAYER2, rows).drop("texto"), contracts.LAYER2) == [
        "missing column texto"]


def submission(**change):
    base = {"envio_id": "e", "caso_id": "c", "paciente_id": "p", "dia_postop": 1, "categoria_caso_limite": "alarma_real",
            "validado_por": "r", "criterio_clinico_ref": "k", "label_ground_truth": "rojo",
            "sintomas": (9, 36.5, "normal", "normal", "normal", "normal"),
            "turnos": [("t0", 0, "agente", "hola"), ("t1", 1, "paciente", "mal")]}
    return tuple({**base, **change}.values())


SUBMISSION = (
    "envio_id string, caso_id string, paciente_id string, dia_postop int, categoria_caso_limite string, "
    "validado_por string, criterio_clinico_ref string, label_ground_truth string, sintomas struct<dolor_nrs: int, "
    "fiebre_c: double, movilidad: string, herida: string, apetito: string, sueno: string>, "
    "turnos array<struct<dialogo_id: string, turno_idx: int, hablante: string, texto: string>>")


def test_curation(spark):
    given = [
        submission(), submission(envio_id="aviso", label_ground_truth="verde"), submission(envio_id="sin", sintomas=None),
        submission(envio_id="cat", categoria_caso_limite="otra"), submission(envio_id="catnula", categoria_caso_limite=None),
        submission(envio_id="rev", validado_por=""), submission(envio_id="crit", criterio_clinico_ref=None),
    ]
    reviewed = curation.review(spark.createDataFrame(given, SUBMISSION))
    reasons = {r["envio_id"]: r["motivo_rechazo"] for r in curation.rejects(reviewed).collect()}
    assert reasons == {"cat": "categoria_caso_limite", "catnula": "categoria_caso_limite", "rev": "validado_por",
                       "crit": "criterio_clinico_ref"}
    assert [r["envio_id"] for r in curation.disagreements(reviewed).collect()] == ["aviso"]
    rows = curation.layer3_rows(reviewed, RUN)
    assert contracts.schema_differences(rows, contracts.LAYER3) == []
    assert rows.count() == 6
    first = rows.first()
    assert (first["estilo_paciente"], first["modelo_paciente"], first["prompt_tokens"]) == ("n/a", "curado_manual", None)
