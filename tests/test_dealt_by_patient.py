"""Steps over generated turns leave them in the task that made them, and give the rows of the general form."""

from __future__ import annotations

import contextlib
import hashlib
import io
import re

import pytest
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions.draws import Draws, digest
from cohortloom.operators import dialogues, noise
from cohortloom.operators.sets import content_difference
from cohortloom.plans.inputs import Inputs
from cohortloom.plans.registry import QUERIES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Orders of their own: the turns of some hundred patients, no id twice."""
    path = str(tmp_path_factory.mktemp("pocas"))
    spark.range(1, 1200, 7).withColumnRenamed("id", "o_orderkey").write.parquet(f"{path}/orders.parquet")
    return path


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def same(left, right) -> bool:
    return left.columns == right.columns and tuple(content_difference(left, right).first()) == (0, 0)


@pytest.mark.parametrize("name", ["noise_lineage_generated", "turn_history", "layer2_generated"])
def test_only_entities_are_dealt_out(spark, folder, name):
    """Every exchange carries the id of a patient and at most its index: no case, no turn, no text."""
    plan = plan_of(QUERIES[name](spark, folder))
    dealt = re.findall(r"Exchange (.*)\n[^A-Za-z]*(.*)", plan)
    assert dealt
    for exchange, below in dealt:
        assert exchange.startswith(("hashpartitioning(paciente_id", "SinglePartition")) or "Broadcast" in exchange
        assert "caso_" not in below and "texto" not in below


def test_lineage_is_that_of_joins_by_id(spark, folder):
    x = Inputs(spark, folder)
    layer1 = x.generated_layer1()
    by_id = noise.noise_lineage(layer1, x.layer2(layer1), x.log(layer1))
    met = noise.noise_lineage(layer1, x.layer2(layer1, together=True), x.log(layer1, "paciente_id"), together=True)
    assert same(by_id, met) and by_id.count() > 1000


def test_lineage_keeps_log_rows_without_turns_and_repeats(spark, folder):
    x = Inputs(spark, folder)
    layer1 = x.generated_layer1()
    layer2, log = x.layer2(layer1, together=True), x.log(layer1, "paciente_id")
    short, twice = layer1.where("turno_idx <> 3"), layer2.unionByName(layer2.where("turno_idx = 2"))
    by_id = noise.noise_lineage(short, twice, log)
    assert same(by_id, noise.noise_lineage(short, twice, log, together=True))
    assert not by_id.where("turno_capa1 is null").isEmpty() and by_id.count() > log.count()


def test_history_is_that_of_the_general_form(spark, folder):
    layer1 = Inputs(spark, folder).generated_layer1().where("turno_idx not in (2, 5)")
    assert same(dialogues.turn_history(layer1), dialogues.turn_history(layer1, together=True))


def test_layer2_is_that_of_the_general_form(spark, folder):
    x = Inputs(spark, folder)
    layer1 = x.generated_layer1()
    assert same(x.layer2(layer1), x.layer2(layer1, together=True))


def test_a_turn_is_digested_once_for_its_selection(spark, folder):
    plan = plan_of(QUERIES["unchanged_noise"](spark, folder))
    assert plan.count("inject_noise_seleccion") == 1 and plan.count("inject_noise_udf") == 1


@pytest.mark.parametrize("options", [["a"], ["a", "b", "a"], ref.STYLES, ["o'h", "\\", "c", "d", "e", "f", "g"]])
def test_a_choice_by_digits_is_the_pick(spark, options):
    rows = spark.range(3000).withColumn("d", digest("eleccion", F.col("id")))
    edges = [f"{at:08x}" for n in range(1, 8) for at in {n * 2 ** 32 // len(options) + by for by in (-1, 0, 1)}
             if 0 <= at < 2 ** 32]
    made = spark.createDataFrame([(-1, edge + hashlib.sha256(edge.encode()).hexdigest()[8:]) for edge in edges],
                                 "id long, d string")
    d = Draws("d")
    both = rows.unionByName(made).select(*[
        (d.choice(k, options).eqNullSafe(d.pick(k, options))).alias(f"k{k}") for k in (0, 1, 7)])
    assert both.where("not (k0 and k1 and k7)").isEmpty()


def test_levels_of_a_column_select_as_a_number_does(spark):
    rows = spark.range(400).select(F.concat(F.lit("dlg_"), F.col("id").cast("string")).alias("dialogo_id"))
    d = digest("inject_noise_seleccion", F.col("dialogo_id"), 42)
    for level in (0, 1, 2, 3, 4, 5, 6):
        fixed = noise.select_noise(rows, level, 42).select("dialogo_id", "tipo_ruido")
        assert same(fixed, noise.select_noise(rows, F.lit(level), 42).select("dialogo_id", "tipo_ruido"))
        hit = rows.withColumn("d", d).where(Draws("d").uniform(0) < min(0.9, 0.15 * level)).count()
        assert fixed.where("tipo_ruido is not null").count() == (hit if 1 <= level <= 5 else 0)
