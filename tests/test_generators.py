from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortloom import Settings
from cohortloom import reference_data as ref
from cohortloom.operators.adaptation import adapt_profiles, department_shares
from cohortloom.operators.labels import label_cases, rule_label, triage_of_columns
from cohortloom.operators.profiles import generate_profiles
from cohortloom.operators.sets import content_difference
from cohortloom.operators.trajectories import generate_trajectories, symptom_ranges
from cohortloom.plans import reports

BASE = {"dolor_nrs": 0, "fiebre_c": 36.5, "movilidad": "normal", "herida": "normal", "apetito": "normal", "sueno": "normal"}


@pytest.fixture(scope="module")
def people(entities, settings):
    return generate_profiles(entities, settings).cache()


@pytest.fixture(scope="module")
def cases(people, settings):
    walks = generate_trajectories(people, settings)
    labelled = label_cases(walks, settings).join(walks.select("trayectoria_id", "arquetipo_trayectoria"), "trayectoria_id")
    return labelled.cache()


def test_a_larger_population_extends_a_smaller_one(people, spark, settings):
    few = generate_profiles(spark.range(300).withColumnRenamed("id", "indice").repartition(7), settings)
    same = people.join(few.select("paciente_id"), "paciente_id", "left_semi")
    assert tuple(content_difference(few, same.select(*few.columns)).first()) == (0, 0)


def test_profiles_respect_their_calibration(people):
    limits = {m: (lo, hi, set(pool)) for m, _, lo, hi, pool, _ in ref.CALIBRATION}
    rows = people.collect()
    assert len({r["paciente_id"] for r in rows}) == len(rows) == 2000
    for r in rows:
        low, high, pool = limits[r["modulo_synthea"]]
        assert low <= r["edad"] <= high and set(r["comorbilidades"]) <= pool and r["genero"] in "FM"
        assert "2026-01-05" <= str(r["fecha_cirugia"]) <= "2026-07-04"
    assert {r["modulo_synthea"] for r in rows} == set(limits)


def test_rates_are_near_the_calibration(people):
    assert all(r["en_tolerancia"] for r in reports.complication_rate(people).collect())


def test_seed_changes_the_draws(people, entities, settings):
    other = generate_profiles(entities, replace(settings, seed=7))
    assert other.select("edad").exceptAll(people.select("edad")).count() > 0


@pytest.mark.parametrize("modules", [(), ("appendicitis", "modulo_inexistente")])
def test_bad_module_lists_fail(entities, modules):
    with pytest.raises(ValueError):
        generate_profiles(entities, Settings(modules=modules))


def test_trajectory_guarantees(cases):
    per_kind = {(r[0], r[1]): set(r[2]) for r in cases.groupBy("arquetipo_trayectoria", "dia_postop").agg(
        F.collect_set("label")).collect()}
    assert per_kind["recuperacion_normal", 14] == {"verde"}
    for day in (1, 3, 7, 14):
        assert "rojo" not in per_kind["complicacion_leve_vigilancia", day]
        assert "rojo" not in per_kind["recuperacion_normal", day]
        assert (per_kind["complicacion_real", day] == {"rojo"}) == (day >= 7)
    assert "rojo" not in per_kind["complicacion_real", 1] | per_kind["complicacion_real", 3]


def test_red_stays_red(cases):
    assert reports.red_persistence(cases).where(~F.col("persistente")).count() == 0
    assert reports.red_persistence(cases).where(F.col("primer_rojo") > 0).count() > 0


def test_complication_forces_the_archetype(people, cases):
    joined = cases.join(people.select("paciente_id", "complicacion_encounter"), "paciente_id")
    wrong = joined.where(F.col("complicacion_encounter") != (F.col("arquetipo_trayectoria") == "complicacion_real"))
    assert wrong.count() == 0


def test_one_call_day_is_the_end_of_the_course(people):
    only = generate_trajectories(people, Settings(call_days=(5,)))
    assert only.count() == 2000
    labels = label_cases(only, Settings()).join(only.select("trayectoria_id", "arquetipo_trayectoria"), "trayectoria_id")
    assert {tuple(r) for r in labels.select("arquetipo_trayectoria", "label").distinct().collect()
            if r[0] == "recuperacion_normal"} == {("recuperacion_normal", "verde")}


def test_order_of_the_day_list_decides_progress(people):
    walk = generate_trajectories(people, Settings(call_days=(14, 1)))
    last = walk.where((F.col("dia_postop") == 1) & (F.col("arquetipo_trayectoria") == "recuperacion_normal"))
    assert last.agg(F.max("dolor_nrs")).first()[0] <= 2


def test_without_the_serious_archetype_the_last_listed_is_used(people):
    walk = generate_trajectories(people, Settings(archetypes=("recuperacion_normal", "complicacion_leve_vigilancia")))
    joined = walk.join(people.select("paciente_id", "complicacion_encounter"), "paciente_id")
    assert {r[0] for r in joined.where("complicacion_encounter").select("arquetipo_trayectoria").distinct().collect()} == {
        "complicacion_leve_vigilancia"}


def test_unknown_archetype_fails():
    with pytest.raises(ValueError):
        symptom_ranges("otro", 0.5, "dolor")


@pytest.mark.parametrize("change, label", [
    ({}, "verde"), ({"fiebre_c": 38.5}, "rojo"), ({"fiebre_c": 38.49}, "verde"),
    ({"herida": "dehiscencia"}, "rojo"), ({"herida": "secrecion_purulenta"}, "rojo"),
    ({"dolor_nrs": 8}, "rojo"), ({"dolor_nrs": 7}, "verde"), ({"movilidad": "incapacitante_nueva"}, "rojo"),
    ({"fiebre_c": 37.8}, "verde"), ({"dolor_nrs": 5}, "verde"), ({"herida": "eritema_leve"}, "verde"),
    ({"fiebre_c": 37.8, "dolor_nrs": 5}, "amarillo"),
    ({"apetito": "muy_disminuido", "sueno": "muy_alterado"}, "amarillo"),
    ({"fiebre_c": 38.5, "dolor_nrs": 5, "herida": "eritema_leve"}, "rojo"),
    ({"fiebre_c": None}, None), ({"fiebre_c": float("nan")}, None), ({"herida": None}, None),
    ({"dolor_nrs": None, "movilidad": "incapacitante_nueva"}, None),
])
def test_triage_boundaries(spark, change, label):
    schema = "dolor_nrs int, fiebre_c double, movilidad string, herida string, apetito string, sueno string"
    row = spark.createDataFrame([tuple({**BASE, **change}.values())], schema)
    assert row.select(triage_of_columns()).first()[0] == label


def test_generic_rule_threshold(spark):
    df = spark.createDataFrame([(1, 1, 1, 0), (1, 1, 0, 0), (0, 0, 0, 1)], "a int, b int, c int, r int")
    flag = [F.col(c) == 1 for c in "abc"]
    label = rule_label([F.col("r") == 1], flag, min_yellow=3)
    assert [r[0] for r in df.select(label).collect()] == ["amarillo", "verde", "rojo"]


def test_adaptation(people, settings):
    adapted = adapt_profiles(people, settings).cache()
    rows = adapted.collect()
    places = {(d, c) for d, c, _ in ref.DEPARTMENTS}
    assert len(rows) == 2000
    for r in rows:
        assert (r["departamento"], r["ciudad"]) in places and r["eps"] in ref.INSURERS
        assert 900_000_000 <= int(r["documento_cc"]) <= 999_999_999
        assert (r["source_country"], r["adapted_country"], r["adaptation_fields"]) == ("US", "CO", ref.ADAPTED_FIELDS)
    spread = reports.geo_distribution(adapted).first()
    assert spread["concentracion_ok"] and spread["dispersion_ok"]


def test_department_shares_tile_the_unit_interval():
    shares = department_shares()
    assert len(shares) == len({row[0] for row in shares}) == 33
    assert shares[0][4] == 0 and shares[-1][5] == 1.0
    assert all(a[5] == b[4] for a, b in zip(shares, shares[1:]))
    assert abs(sum(row[3] for row in shares) - 1) < 1e-12
