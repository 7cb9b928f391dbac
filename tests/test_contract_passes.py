"""The contract checks derive a table once or twice, whatever the number of its rules, and count as before."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_large_plans import plan_of

from cohortloom import contracts
from cohortloom.operators import profiles
from cohortloom.plans import quality
from cohortloom.plans.inputs import LEAST_TASKS, Inputs
from cohortloom.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
CONTRACT = contracts.Contract(
    "tabla_a", contracts._schema("clave STRING NOT NULL, label STRING NOT NULL, nota STRING"), "clave",
    {"label_valido": "label IN ('verde', 'rojo')"})
OTHER = contracts.Contract("tabla_b", contracts._schema("otra STRING NOT NULL"), "otra")
ROWS = [("a", "verde", "x"), ("a", None, "x"), ("a", "azul", "x"), ("b", "rojo", "x"), (None, "azul", "y"), (None, "verde", None)]


def counts(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("rows", [ROWS, []])
def test_one_pass_counts_what_two_passes_count(spark, rows):
    df = spark.createDataFrame(rows, "clave string, label string, otra string")
    apart = contracts.violations(df, CONTRACT).unionByName(contracts.repeated_keys(df, CONTRACT))
    assert counts(contracts.checks(df, CONTRACT)) == counts(apart)
    assert dict((r.regla, r.n_violaciones) for r in apart.collect()) == (
        {"no_nulo:clave": 2, "no_nulo:label": 1, "label_valido": 2, "clave_unica:clave": 2} if rows else
        {"no_nulo:clave": 0, "no_nulo:label": 0, "label_valido": 0, "clave_unica:clave": 0})
    folded = df.groupBy(contracts.broken_rules(CONTRACT).alias("rotas")).agg(F.count(F.lit(1)).alias("filas"))
    assert counts(contracts.folded_violations(folded, CONTRACT, "rotas", "filas")) == counts(contracts.violations(df, CONTRACT))
    beside = contracts.repeated_keys(df, CONTRACT, OTHER)
    assert counts(beside) == [("tabla_a", "clave_unica:clave", 2 if rows else 0), ("tabla_b", "clave_unica:otra", 3 if rows else 0)]


def test_balance_of_folded_rows_is_that_of_the_rows(spark, settings):
    rows = spark.createDataFrame(
        [(1, "verde"), (1, "verde"), (1, "rojo"), (1, None), (3, "otra"), (3, "amarillo")], "dia int, label string")
    folded = rows.groupBy("dia", "label").agg(F.count(F.lit(1)).alias("filas"))
    apart = quality.label_balance(rows, settings, by=("dia",))
    assert counts(quality.label_balance(folded, settings, by=("dia",), weight="filas")) == counts(apart)


def test_trajectories_are_derived_twice_at_most(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan then shows which exchanges are read again
    try:
        assert plan_of(QUERIES["contract_violations"](spark, SMALL)).count("sha2(cast(concat_ws(|, trayectoria_dia") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_copies_of_an_entity_are_spread_over_the_tasks(spark, tmp_path):
    spark.range(3200).selectExpr("7L AS o_orderkey").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    sizes = Inputs(spark, str(tmp_path)).even_entities().groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 3200
    assert max(r["count"] for r in sizes) < 3 * 3200 / LEAST_TASKS


def test_patient_id_is_padded_like_a_formatted_number(spark):
    df = spark.createDataFrame([(n,) for n in (0, 7, 9999, 10000, 99999, 100000, 2 ** 40)], "n long")
    for seed in (42, -3):
        ids = df.select("n", profiles.patient_id(F.col("n"), seed).alias("id"))
        assert not ids.schema["id"].nullable
        assert {r.n: r.id for r in ids.collect()} == {r.n: f"pac_{seed}_{r.n:05d}" for r in df.collect()}
