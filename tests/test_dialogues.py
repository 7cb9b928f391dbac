from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom import Settings, contracts
from cohortloom import reference_data as ref
from cohortloom.functions.text import slots
from cohortloom.operators import dialogues
from cohortloom.operators.adaptation import adapt_profiles
from cohortloom.operators.labels import label_cases
from cohortloom.operators.profiles import generate_profiles
from cohortloom.operators.sets import content_difference
from cohortloom.operators.trajectories import generate_trajectories
from cohortloom.plans.reports import label_leak
from cohortloom.sources.workspace import new_folder


@pytest.fixture(scope="module")
def world(spark, settings):
    people = generate_profiles(spark.range(0, 25).withColumnRenamed("id", "indice"), settings).cache()
    adapted = adapt_profiles(people, settings).cache()
    cases = label_cases(generate_trajectories(people, settings), settings).cache()
    return people, adapted, cases


@pytest.fixture(scope="module")
def context(world, settings):
    people, adapted, cases = world
    return dialogues.assign_style(dialogues.case_context(cases, people, adapted), settings).cache()


def test_a_case_without_profile_fails(world):
    people, adapted, cases = world
    short = people.where("paciente_id <> 'pac_42_00003'")
    with pytest.raises(Exception, match="no profile for patient pac_42_00003"):
        dialogues.case_context(cases, short, adapted).collect()


def test_prompt_has_the_case_but_not_the_label(context):
    row = context.withColumn("p", dialogues.patient_prompt()).first()
    for value in (row["perfil_colombia"]["nombre_completo"], str(row["perfil_colombia"]["edad"]), row["procedimiento"],
                  row["estilo_paciente"], *[str(v) for v in row["vector_sintomas"]]):
        assert value in row["p"]
    assert "{{" not in row["p"] and row["perfil_colombia"]["documento_cc"] not in row["p"]
    assert "label" not in slots(dialogues.prompt_template("patient_prompt.md"))
    assert "{{" not in dialogues.agent_prompt()
    prompts = context.select(F.lit("x").alias("fuente"), "label", dialogues.patient_prompt().alias("texto"))
    assert label_leak(prompts).agg(F.sum("con_label")).first()[0] == 0


def test_no_pool_text_contains_a_label():
    texts = [*ref.OPENINGS, *sum(ref.QUESTIONS.values(), []), *sum(ref.ANSWERS.values(), []), dialogues.agent_prompt()]
    assert not [t for t in texts if any(label in t.lower() for label in ref.LABELS)]
    joined = " ".join(texts).lower()
    assert all(phrase in joined for phrase in ref.IDIOMS)


def test_unknown_style_fails(context):
    with pytest.raises(Exception, match="unknown patient style"):
        context.withColumn("estilo_paciente", F.lit("alegre")).select(dialogues.patient_prompt()).collect()


def test_out_of_domain_symptoms_are_spoken_generically(context, settings):
    odd = context.withColumn("vector_sintomas", F.col("vector_sintomas").withField("herida", F.lit("rara")))
    turns = dialogues.template_turns(odd, settings).where("turno_idx = 7")
    spoken = {r[0] for r in turns.select("texto").collect()}
    assert all(any(s.endswith(a) for a in ref.ANSWERS["herida"][:2]) for s in spoken)


def test_template_dialogue_shape(context, settings):
    rows = dialogues.layer1_rows(dialogues.template_turns(context, settings), settings).cache()
    assert rows.count() == 100 * 12 == rows.select("dialogo_id").distinct().count()
    assert contracts.schema_differences(rows, contracts.LAYER1) == []
    assert contracts.violations(rows, contracts.LAYER1).agg(F.sum("n_violaciones")).first()[0] == 0
    wrong = rows.where((F.col("hablante") == "paciente") != (F.col("turno_idx") % 2 == 1))
    assert wrong.isEmpty()
    tokens = rows.where("(hablante = 'agente') <> (prompt_tokens IS NULL)")
    assert tokens.isEmpty()
    case = rows.where(F.col("caso_id") == rows.first()["caso_id"]).orderBy("turno_idx").collect()
    words = [len(r["texto"].split(" ")) for r in case]
    assert case[1]["completion_tokens"] == sum(words)
    agent = sum(5 * (k + 1) + sum(words[0:2 * k:2]) for k in range(6))
    patient = sum(sum(words[0:2 * k + 1:2]) + sum(words[1:2 * k:2]) for k in range(6))
    assert case[1]["prompt_tokens"] == agent + patient
    assert dialogues.token_totals(rows).agg(F.count("*")).first()[0] == 100


def test_history_of_both_roles(context, settings):
    rows = dialogues.layer1_rows(dialogues.template_turns(context, settings), settings)
    case = rows.first()["caso_id"]
    said = {r["turno_idx"]: r["texto"] for r in rows.where(F.col("caso_id") == case).collect()}
    seen = {r["turno_idx"]: r["historial"] for r in
            dialogues.turn_history(rows.where(F.col("caso_id") == case)).collect()}
    assert seen[0] == [ref.AREA_CUE + "dolor"]
    assert seen[4] == [ref.AREA_CUE + "dolor", said[0], ref.AREA_CUE + "fiebre", said[2], ref.AREA_CUE + "movilidad"]
    assert seen[5] == [said[i] for i in range(5)]
    with pytest.raises(Exception, match="more turns than a generated case"):
        dialogues.turn_history(rows.withColumn("turno_idx", F.col("turno_idx") + 1)).collect()
    with pytest.raises(Exception, match="more turns than a generated case"):
        dialogues.turn_history(rows.unionByName(rows.where("turno_idx = 5"))).collect()


def test_outside_generator(context, settings):
    def fake_clients():
        def patient(prompt, log):
            assert prompt.startswith("Interpretas a") and log[-1]["role"] == "user"
            return f"respuesta {len(log)}", 10, 2

        def agent(prompt, log):
            assert not any("respuesta" in m["content"] for m in log)
            return f"pregunta {len(log)}", 100, 20

        return patient, agent

    turns = dialogues.layer1_rows(dialogues.generated_turns(context, fake_clients), settings).cache()
    assert turns.count() == 1200
    case = turns.where(F.col("caso_id") == turns.first()["caso_id"]).orderBy("turno_idx").collect()
    assert [r["texto"] for r in case][:4] == ["pregunta 1", "respuesta 1", "pregunta 3", "respuesta 3"]
    assert (case[1]["prompt_tokens"], case[1]["completion_tokens"], case[0]["prompt_tokens"]) == (660, 132, None)


def test_resumed_run_equals_a_single_run(spark, world, settings):
    people, adapted, cases = world
    once = dialogues.new_layer1(spark, new_folder(spark, "once"))
    dialogues.run_batch(once, cases, people, adapted, settings)
    twice = dialogues.new_layer1(spark, new_folder(spark, "twice"))
    dialogues.run_batch(twice, cases.where("dia_postop < 7"), people, adapted, settings)
    assert twice.read().count() == 600
    asked = []

    def generate(pending):
        asked.append(pending.count())
        return dialogues.template_turns(pending, settings)

    dialogues.run_batch(twice, cases, people, adapted, settings, generate)
    dialogues.run_batch(twice, cases, people, adapted, settings, generate)
    assert asked == [50, 0]
    assert tuple(content_difference(once.read(), twice.read()).first()) == (0, 0)


def test_a_batch_that_dies_keeps_its_finished_slices(spark, world, settings):
    people, adapted, cases = world
    table, asked = dialogues.new_layer1(spark, new_folder(spark, "dies")), []

    def generate(pending, dies_at=2):
        asked.append(pending.count())
        if len(asked) > dies_at:
            raise RuntimeError("service gone")
        return dialogues.template_turns(pending, settings)

    with pytest.raises(RuntimeError):
        dialogues.run_batch(table, cases, people, adapted, settings, generate, slices=4)
    kept = table.read().select("caso_id").distinct().count()
    assert kept == sum(asked[:2]) and 0 < kept < cases.count()
    asked.clear()
    dialogues.run_batch(table, cases, people, adapted, settings, lambda x: generate(x, 9), slices=4)
    assert sum(asked) == cases.count() - kept
    once = dialogues.new_layer1(spark, new_folder(spark, "once"))
    dialogues.run_batch(once, cases, people, adapted, settings)
    assert tuple(content_difference(once.read(), table.read()).first()) == (0, 0)


def test_pending_cases(spark):
    cases = spark.createDataFrame([("a",), ("b",), ("c",)], "caso_id string")
    pending = lambda ids: {r[0] for r in dialogues.pending_cases(
        cases, spark.createDataFrame([(i,) for i in ids], "caso_id string")).collect()}
    assert (pending([]), pending(["b", "b"]), pending(["a", "b", "c"])) == ({"a", "b", "c"}, {"a", "c"}, set())


def test_responses(spark):
    raw = [
        '{"content":[{"type":"thinking","text":"x"},{"type":"text","text":"uno"},{"type":"text","text":"dos"}],'
        '"usage":{"input_tokens":7,"output_tokens":3}}',
        '{"content":[{"type":"text","text":"solo"}]}',
        '{"choices":[{"message":{"content":"tres"}}],"usage":{"prompt_tokens":4,"completion_tokens":null}}',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "id int, respuesta string")
    assert [tuple(r) for r in dialogues.parse_responses(df).orderBy("id").collect()] == [
        (0, "uno", 7, 3), (1, "solo", 0, 0), (2, "tres", 4, 0)]
    bad = spark.createDataFrame([(1, '{"content":[{"type":"thinking","text":"x"}]}')], "id int, respuesta string")
    with pytest.raises(Exception, match="without a text block"):
        dialogues.parse_responses(bad).collect()


def test_run_timestamp_is_a_setting(context):
    then = datetime(2025, 5, 5)
    settings = Settings(run_ts=then)
    rows = dialogues.layer1_rows(dialogues.template_turns(context, settings), settings)
    assert rows.select("generado_ts").distinct().collect()[0][0] == then
