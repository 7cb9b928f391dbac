"""Templates, responses and guards as data; unique keys; mergeable counts; the audit's plan."""

import io
from contextlib import redirect_stdout

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from cohortloom import contracts
from cohortloom import reference_data as ref
from cohortloom.functions.noise_text import add_noise
from cohortloom.operators import responses, templates
from cohortloom.plans import guards, reports
from cohortloom.plans.registry import QUERIES

CASES = "caso_id string, modulo string, valores map<string,string>"
TEMPLATES = "modulo string, rol string, plantilla string"


@pytest.mark.parametrize("template, pieces", [
    ("", [""]), ("plain", ["plain"]), ("{{a}}", ["", "a", ""]), ("x{{ a.b }}y{{c}}", ["x", "a.b", "y", "c", ""]),
    ("open {{a", ["open {{a"]), ("{{a}}{{b}}", ["", "a", "", "b", ""]), ("a}}b{{c}}", ["a}}b", "c", ""]),
    ("{{a}} then }} and {{b}}", ["", "a", " then }} and ", "b", ""]),
])
def test_template_pieces(spark, template, pieces):
    row = templates.with_pieces(spark.createDataFrame([("m", "r", template)], TEMPLATES)).first()
    assert list(row["piezas"]) == pieces


def test_rendering_by_template(spark):
    cases = spark.createDataFrame(
        [("1", "m", {"a": "{{b}}", "b": "B"}), ("2", "m", {"a": None}), ("3", "none", {}), ("4", None, {})], CASES)
    known = spark.createDataFrame([("m", "x", "<{{a}}|{{b}}|{{z}}>"), ("m", "y", "fixed")], TEMPLATES)
    got = {(r["caso_id"], r["rol"]): (r["prompt"], sorted(r["sin_valor"])) for r in templates.render(cases, known).collect()}
    assert got == {("1", "x"): ("<{{b}}|B|>", ["z"]), ("1", "y"): ("fixed", []),
                   ("2", "x"): ("<||>", ["a", "b", "z"]), ("2", "y"): ("fixed", [])}
    assert {(r["casilla"], r["casos"]) for r in templates.unknown_slots(cases, known).collect()} == {("a", 1), ("b", 1), ("z", 2)}
    assert {(r["modulo"], r["casos"]) for r in templates.unmatched(cases, known).collect()} == {("none", 1), (None, 1)}


@pytest.mark.parametrize("raw, expected", [
    ('{"content":[{"type":"text","text":"uno"}],"usage":{"input_tokens":7,"output_tokens":3}}', ("uno", 7, 3, None)),
    ('{"content":[{"type":"thinking","text":"x"},{"type":"text","text":"dos"}]}', ("dos", 0, 0, None)),
    ('{"choices":[{"message":{"content":"tres"}}],"usage":{"prompt_tokens":"5"},"new":{"field":[1]}}', ("tres", 5, 0, None)),
    ('{"output":{"text":"cuatro"},"tokens":{"salida":2}}', ("cuatro", 0, 2, None)),
    ('{"content":"not a list","output":{"text":"cinco"}}', ("cinco", 0, 0, None)),
    ('{"output":{"text":"x"}', (None, None, None, responses.BAD_JSON)),
    ("", (None, None, None, responses.BAD_JSON)), (None, (None, None, None, responses.BAD_JSON)),
    ('[1, 2]', (None, None, None, responses.NO_TEXT)), ('{"content":[]}', (None, None, None, responses.NO_TEXT)),
    ('{"output":{"text":"x"},"tokens":{"salida":"many"}}', (None, None, None, responses.BAD_TOKENS)),
    ('{"output":{"text":"x"},"tokens":{"salida":-1}}', (None, None, None, responses.BAD_TOKENS)),
])
def test_responses_of_changing_shape(spark, raw, expected):
    row = responses.parse_variants(spark.createDataFrame([(1, raw)], "n int, respuesta string")).first()
    assert tuple(row)[1:] == expected


def test_guards_refuse_what_add_noise_refuses(spark):
    rows = spark.createDataFrame(
        [(kind, level) for kind in [*ref.TEXT_NOISE, ref.THIRD_PARTY, "eco", None] for level in (0, 1, 5, 6, None)],
        "tipo_ruido string, intensidad int").withColumn("texto", F.lit("me duele un poco"))
    judged = rows.withColumn("guarda", guards.refused_by(guards.noise_guards())).collect()
    for row in judged:
        one = rows.where(F.col("tipo_ruido").eqNullSafe(row["tipo_ruido"])).where(
            F.col("intensidad").eqNullSafe(row["intensidad"])).select(add_noise("texto", "tipo_ruido", "intensidad", 1).alias("t"))
        if row["guarda"] is None:
            assert one.first()["t"]
        elif row["tipo_ruido"] is not None and row["intensidad"] is not None:
            with pytest.raises(Exception, match="noise type|intensity"):
                one.collect()
    assert {r["guarda"] for r in judged} == {None, "intensidad_invalida", "tipo_estructural", "tipo_desconocido"}


def test_repeated_keys(spark):
    contract = contracts.ALERTS
    rows = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "alerta_id string")
    assert contracts.repeated_keys(rows, contract).first()["n_violaciones"] == 2
    assert contracts.repeated_keys(rows.where("false"), contract).first()["n_violaciones"] == 0


def test_merged_sketches_equal_one_pass(spark):
    cases = spark.range(60_000).select((F.col("id") % 4).cast("int").alias("dia_postop"), (F.col("id") % 17_000).alias("quien"))
    parts = reports.daily_sketches(cases.where("quien < 9000"), "quien").unionByName(
        reports.daily_sketches(cases.where("quien >= 9000"), "quien"))
    found = reports.distinct_from_sketches(parts, cases, "quien").collect()
    assert len(found) == 5 and all(r["en_error"] and r["igual_a_una_pasada"] for r in found)
    assert {r["dia_postop"]: r["exacto"] for r in found}[-1] == 17_000


def test_the_audit_scans_its_source_once(spark):
    shown = io.StringIO()
    with redirect_stdout(shown):
        QUERIES["noise_audit"](spark, SMALL).explain()
    plan = shown.getvalue()
    reads = plan.count("FileScan parquet")
    with redirect_stdout(shown := io.StringIO()):
        QUERIES["layer1_dialogues"](spark, SMALL).explain()
    assert reads == shown.getvalue().count("FileScan parquet")  # nothing is read beside the turns themselves
