"""Dialogue turns: case context, prompts, generation, resumable batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from importlib import resources
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.contracts import LAYER1
from cohortloom.functions import draws, text
from cohortloom.functions.draws import constant_array
from cohortloom.settings import Settings
from cohortloom.sources.catalog import BUCKETS, CatalogTable, table_in

AGENT, PATIENT = "agente", "paciente"
TURNS_PER_CASE = 2 * len(ref.AREAS)
PROMPT_COLUMNS = {
    "perfil_colombia.nombre_completo", "perfil_colombia.edad", "procedimiento", "dia_postop", "estilo_paciente",
    *(f"vector_sintomas.{name}" for name in ref.SYMPTOMS),
}


def prompt_template(name: str) -> str:
    return text.first_block(resources.files("cohortloom.resources").joinpath(name).read_text(encoding="utf-8"))


def case_context(cases: DataFrame, profiles: DataFrame, adapted: DataFrame) -> DataFrame:
    """Case, procedure, demographic struct (with age) and symptom struct.

    Two equi-joins on the patient; a case without profile fails the job instead
    of disappearing.
    """
    return _checked_context(_with_people(cases, profiles, adapted), adapted.columns)


def _with_people(cases: DataFrame, profiles: DataFrame, adapted: DataFrame) -> DataFrame:
    return cases.join(profiles.select("paciente_id", "procedimiento", "edad"), "paciente_id", "left").join(
        adapted, "paciente_id", "left")


def _checked_context(joined: DataFrame, demographic: list[str]) -> DataFrame:
    person = F.struct(*[F.col(c) for c in demographic if c != "paciente_id"], F.col("edad"))
    missing = F.raise_error(F.concat(F.lit("no profile for patient "), F.col("paciente_id")))
    return joined.select(
        "caso_id", "paciente_id", "dia_postop", "label",
        F.when(F.col("procedimiento").isNull() | F.col("adapted_country").isNull(), missing)
        .otherwise(F.col("procedimiento")).alias("procedimiento"),
        person.alias("perfil_colombia"),
        F.struct(*ref.SYMPTOMS).alias("vector_sintomas"),
    )


def assign_style(cases: DataFrame, settings: Settings) -> DataFrame:
    """Style keyed by case, so a resumed run gives the same styles as a single one."""
    d = draws.digest("dialogo_estilo", F.col("caso_id"), settings.seed)
    return cases.withColumn("d", d).withColumn("estilo_paciente", draws.Draws("d").pick(0, ref.STYLES)).drop("d")


def valid_style(style: Column) -> Column:
    return F.when(style.isin(ref.STYLES), style).otherwise(
        F.raise_error(F.concat(F.lit("unknown patient style: "), F.coalesce(style, F.lit("NULL"))))
    )


def patient_prompt(template: str | None = None) -> Column:
    """Prompt of the patient role. The label is not among the available slots."""
    columns = {name: F.col(name) for name in PROMPT_COLUMNS}
    columns["estilo_paciente"] = valid_style(F.col("estilo_paciente"))
    return text.render(template or prompt_template("patient_prompt.md"), columns)


def agent_prompt() -> str:
    return prompt_template("agent_prompt.md")


def turn_grid(cases: DataFrame) -> DataFrame:
    """Case x six areas x two roles; the turn number is arithmetic, no window needed."""
    steps = F.array(*[
        F.struct(F.lit(2 * at + role).alias("turno_idx"), F.lit(area).alias("area"), F.lit(speaker).alias("hablante"))
        for at, area in enumerate(ref.AREAS) for role, speaker in enumerate((AGENT, PATIENT))
    ])
    return cases.select("*", F.inline(steps))


def _severity_sql() -> dict[str, str]:
    """Per area 0 for "cannot say", else 1 + band or position of the state in its domain."""
    def position(name: str, domain: list[str]) -> str:
        states = ", ".join(draws.sql_text(state) for state in domain)
        return f"coalesce(array_position(array({states}), vector_sintomas.{name}), 0)"

    pain, heat = "vector_sintomas.dolor_nrs", "vector_sintomas.fiebre_c"
    return {
        "dolor": f"CASE WHEN {pain} IS NULL THEN 0 WHEN {pain} >= 8 THEN 4 WHEN {pain} >= 5 THEN 3 "
                 f"WHEN {pain} >= 3 THEN 2 ELSE 1 END",
        "fiebre": f"CASE WHEN {heat} IS NULL THEN 0 WHEN {heat} >= 38.0D THEN 3 WHEN {heat} >= 37.5D THEN 2 ELSE 1 END",
        "movilidad": position("movilidad", ref.MOBILITY),
        "herida": position("herida", ref.WOUND),
        "apetito": position("apetito", ref.APPETITE),
        "sueno": position("sueno", ref.SLEEP),
    }


def _phrase_sql(pool: list[str], index: str) -> str:
    return f"element_at(array({', '.join(draws.sql_text(p) for p in pool)}), cast({index} AS INT))"


def _words_sql(pool: list[str], index: str) -> str:
    """Blank-separated words of the phrase that ``index`` (from 1) picks."""
    return f"element_at(array({', '.join(str(text.word_count(p)) for p in pool)}), cast({index} AS INT))"


def _starts_sql(pools: dict[str, list[str]]) -> str:
    """Phrases before each area's pool, when the pools of all areas stand in one list."""
    return ", ".join(str(n) for n in accumulate((len(pools[area]) for area in ref.AREAS[:-1]), initial=0))


def template_turns(context: DataFrame, settings: Settings) -> DataFrame:
    """Offline generator: texts from pools, chosen by style, symptoms and seed.

    A case is one row until its draws and token totals are known, so neither needs a shuffle; the row
    is then exploded into turns, and a turn looks its phrase up. No step is so large that the JVM
    would interpret its generated method instead of compiling it.
    """
    areas = len(ref.AREAS)
    questions = [phrase for area in ref.AREAS for phrase in ref.QUESTIONS[area]]
    answers = [phrase for area in ref.AREAS for phrase in ref.ANSWERS[area]]
    severity, d = _severity_sql(), draws.Draws("d")
    keyed = context.withColumns({
        "d": draws.digest("dialogo_plantilla", F.col("caso_id"), settings.seed),
        "estilo": (F.array_position(constant_array(ref.STYLES), valid_style(F.col("estilo_paciente"))) - 1).cast("int"),
        "gravedad": F.array(*[F.expr(severity[area]).cast("int") for area in ref.AREAS]),
    }).withColumn("sorteo", F.array(*[(d.word(at) % 12).cast("int") for at in range(areas)]))

    def question(draw: str, at: str) -> str:
        return f"1 + element_at(array({_starts_sql(ref.QUESTIONS)}), {at} + 1) + {draw} % 3"

    def opening(draw: str) -> str:
        return f"1 + estilo * 2 + ({draw} div 3) % 2"

    def answer(draw: str, at: str) -> str:
        return (f"1 + element_at(array({_starts_sql(ref.ANSWERS)}), {at} + 1) + element_at(gravedad, {at} + 1) * 2 "
                f"+ ({draw} div 6) % 2")

    # Tokens are blank-separated words. The history of an agent turn is its cues and its own
    # earlier questions; that of a patient turn is all earlier turns plus the question.
    # An answer is its opening, a blank and its phrase.
    cue_words = len(f"{ref.AREA_CUE}x".split(" "))
    words = F.expr(f"""transform(sorteo, (n_, at_) -> named_struct(
        'q', {_words_sql(questions, question('n_', 'at_'))},
        'a', {_words_sql(ref.OPENINGS, opening('n_'))} + {_words_sql(answers, answer('n_', 'at_'))}))""")
    measured = keyed.withColumn("palabras", words).withColumns({
        "total_prompt": F.expr(f"""aggregate(
            transform(palabras, (w_, at_) -> w_.q * (2 * ({areas - 1} - at_) + 1) + w_.a * ({areas - 1} - at_)),
            {cue_words * areas * (areas + 1) // 2}, (s_, n_) -> s_ + n_)"""),
        "total_completion": F.expr("aggregate(palabras, 0, (s_, w_) -> s_ + w_.q + w_.a)"),
    })
    kept = [*[F.col(f"`{name}`") for name in context.columns], "total_prompt", "total_completion"]
    turns = measured.select(*kept, "estilo", "gravedad", "sorteo", F.explode(
        constant_array(range(TURNS_PER_CASE), "int")).alias("turno_idx"))
    at = "cast(turno_idx div 2 AS INT)"
    drawn = turns.withColumn("n", F.expr(f"element_at(sorteo, {at} + 1)"))
    said = f"""CASE WHEN turno_idx % 2 = 0 THEN {_phrase_sql(questions, question('n', at))}
        ELSE concat_ws(' ', {_phrase_sql(ref.OPENINGS, opening('n'))}, {_phrase_sql(answers, answer('n', at))}) END"""
    speaker = F.when(F.col("turno_idx") % 2 == 0, AGENT).otherwise(PATIENT)
    return drawn.select(*kept, "turno_idx", speaker.alias("hablante"), F.expr(said).alias("texto"))


# (system prompt, messages so far) -> (text, prompt tokens, completion tokens)
Reply = tuple[str, int, int]
ReplyFn = Callable[[str, list[dict]], Reply]


def _replies(reply: ReplyFn, prompt: str, openers: list[str]) -> list[Reply]:
    """One reply per opening message, each seeing the exchange so far."""
    log: list[dict] = []
    given = []
    for opener in openers:
        log.append({"role": "user", "content": opener})
        given.append(reply(prompt, list(log)))
        log.append({"role": "assistant", "content": given[-1][0]})
    return given


def generated_turns(context: DataFrame, make_clients: Callable[[], tuple[ReplyFn, ReplyFn]]) -> DataFrame:
    """Generator for an outside text service: ``make_clients`` runs once per task and
    returns the patient and the agent reply functions.

    Each case is one input row, so Spark spreads and retries the calls and nothing
    passes through the driver. Questions never depend on answers, hence two passes.
    The label travels beside the prompt; the reply functions never see it.
    """
    guide = agent_prompt()
    cues = [ref.AREA_CUE + area for area in ref.AREAS]
    carried = ["caso_id", "paciente_id", "dia_postop", "label", "estilo_paciente"]
    produced = ["total_prompt", "total_completion", "turno_idx", "hablante", "texto"]

    def converse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patient, agent = make_clients()
        for batch in batches:
            for case in batch.itertuples(index=False):
                questions = _replies(agent, guide, cues)
                answers = _replies(patient, case.prompt_paciente, [q[0] for q in questions])
                turns = [reply for pair in zip(questions, answers) for reply in pair]
                used = (sum(t[1] for t in turns), sum(t[2] for t in turns))
                yield pd.DataFrame(
                    [(*(getattr(case, c) for c in carried), *used, at, (AGENT, PATIENT)[at % 2], reply[0])
                     for at, reply in enumerate(turns)],
                    columns=carried + produced)

    return context.select(*carried, patient_prompt().alias("prompt_paciente")).mapInPandas(
        converse,
        "caso_id string, paciente_id string, dia_postop int, label string, estilo_paciente string, "
        "total_prompt int, total_completion int, turno_idx int, hablante string, texto string")


def layer1_rows(turns: DataFrame, settings: Settings) -> DataFrame:
    """Stored form of generated turns. The label joins the text only here. Token totals are
    those of the whole conversation, repeated on each patient row."""
    on_patient = F.col("hablante") == PATIENT
    return turns.select(
        F.concat(F.lit("dlg_"), "caso_id", F.lit("_"), F.col("turno_idx").cast("string")).alias("dialogo_id"),
        "caso_id", "paciente_id", "dia_postop", "turno_idx", "hablante", "texto",
        F.col("label").alias("label_ground_truth"),
        "estilo_paciente",
        F.lit(settings.model_name).alias("modelo_paciente"),
        F.lit(settings.model_name).alias("modelo_agente"),
        F.when(on_patient, F.col("total_prompt")).alias("prompt_tokens"),
        F.when(on_patient, F.col("total_completion")).alias("completion_tokens"),
        F.lit(settings.run_ts).alias("generado_ts"),
    )


def pending_cases(cases: DataFrame, done: DataFrame) -> DataFrame:
    """Cases without any stored turn. Repeated ids of ``done`` are folded before the join, and never broadcast: they are
    as many as the cases, however small their source files look to the planner."""
    return cases.join(done.select("caso_id").distinct().hint("merge"), "caso_id", "left_anti")


def finished_turns(layer1: DataFrame, done: DataFrame) -> DataFrame:
    """Turns of the cases in ``done``, whose ids are folded and not broadcast either."""
    return layer1.join(done.select("caso_id").distinct().hint("shuffle_hash"), "caso_id", "left_semi")


def run_batch(
    table: CatalogTable,
    cases: DataFrame,
    profiles: DataFrame,
    adapted: DataFrame,
    settings: Settings,
    generate: Callable[[DataFrame], DataFrame] | None = None,
    slices: int = 1,
) -> None:
    """Generate the pending cases only, slice after slice, and upsert each finished slice by ``dialogo_id``.

    ``slices`` divides the cases by a hash of their id; every slice is run. A batch that
    dies keeps what it has stored, and the next run asks for the rest only. Choose as
    many slices as bound the work that may be lost, above all with a paid text service.
    A case that another run has stored meanwhile is replaced, not stored twice.
    The cases are dealt out to the table's buckets once, before they have turns and before the
    finished ones are left out: the many turns of a case are written where they are made.
    """
    generate = generate or (lambda context: template_turns(context, settings))
    for number in range(slices):
        part = cases.where(F.pmod(F.xxhash64("caso_id"), F.lit(slices)) == number)
        by_case = table.key == "caso_id"
        joined = _with_people(part, profiles, adapted)
        if by_case:
            # The number, which no plan can do without, keeps the question for finished cases above this exchange: below
            # the joins by patient it would need two more, to the cases and back to the patients.
            joined = table.dealt(joined).withColumn("tarea", F.spark_partition_id())
        pending = pending_cases(joined, table.read())
        pending = pending.where("tarea >= 0") if by_case else pending
        context = assign_style(_checked_context(pending, adapted.columns), settings)
        table.merge(layer1_rows(generate(context), settings), "dialogo_id", dealt=by_case)


def new_layer1(spark, folder: str, buckets: int = BUCKETS) -> CatalogTable:
    """Bucketed by case, so neither the finished cases nor the histories need an exchange of the turns."""
    return table_in(spark, folder, LAYER1.schema, "caso_id", buckets)


def turn_history(layer1: DataFrame, together: bool = False) -> DataFrame:
    """Messages each turn was generated from.

    A patient turn saw every earlier turn; an agent turn saw its cues and its own
    earlier questions, never the answers. A generated case has twelve known slots, so
    its turns fold into one row of bounded size before the shuffle; a turn outside
    the slots or a repeated one fails the job. ``together``: the turns are dealt out by
    patient, and a case belongs to one patient, so no turn is moved.

    The messages of a case are listed once; a turn takes the first ones of a list.
    """
    slot = lambda at: F.max(F.when(F.col("turno_idx") == at, F.struct("dialogo_id", "hablante", "texto")))
    group = ["paciente_id", "caso_id"] if together else ["caso_id"]
    cases = layer1.groupBy(*group).agg(
        F.array(*[slot(at) for at in range(TURNS_PER_CASE)]).alias("turnos"), F.count("*").alias("filas"))
    present = F.size(F.filter("turnos", lambda m: m.isNotNull()))
    whole = F.when(F.col("filas") == present, F.col("turnos")).otherwise(
        F.raise_error(F.concat(F.lit("more turns than a generated case can have: "), F.coalesce("caso_id", F.lit("null")))))
    cue = lambda at: F.get(constant_array([ref.AREA_CUE + area for area in ref.AREAS for _ in (AGENT, PATIENT)]), at)
    numbered = F.filter(F.transform("turnos", lambda m, at: F.when(m.isNotNull(), F.struct(
        m["dialogo_id"].alias("dialogo_id"), m["hablante"].alias("hablante"), m["texto"].alias("texto"),
        at.alias("turno_idx")))), lambda m: m.isNotNull())
    listed = cases.select("caso_id", whole.alias("turnos")).withColumn("dichos", numbered).select(
        "caso_id", F.transform("dichos", lambda m: m["texto"]).alias("textos"),
        F.filter("dichos", lambda m: m["hablante"] == AGENT).alias("propios"), F.col("dichos")).select(
        "caso_id", "textos",
        F.flatten(F.transform("propios", lambda m: F.array(cue(m["turno_idx"]), m["texto"]))).alias("preguntas"),
        F.transform("propios", lambda m: m["turno_idx"]).alias("lugares"),
        F.posexplode("dichos").alias("previos", "turno"))
    at = F.col("turno.turno_idx")
    # its place among the questions says how many an agent turn had asked before
    asked = F.greatest(F.array_position("lugares", at).cast("int") - 1, F.lit(0))
    agent_view = F.concat(F.slice("preguntas", F.lit(1), asked * 2), F.array(cue(at)))
    patient_view = F.slice("textos", F.lit(1), F.col("previos"))
    return listed.select(
        F.col("turno.dialogo_id").alias("dialogo_id"), "caso_id", at.alias("turno_idx"),
        F.col("turno.hablante").alias("hablante"),
        F.when(F.col("turno.hablante") == AGENT, agent_view).otherwise(patient_view).alias("historial"),
    )


def token_totals(layer1: DataFrame) -> DataFrame:
    """Tokens per conversation: every patient row repeats the total, so take the maximum."""
    return layer1.groupBy("caso_id").agg(
        F.max("prompt_tokens").alias("prompt_tokens"), F.max("completion_tokens").alias("completion_tokens"))


RESPONSE_SCHEMA = (
    "content array<struct<type: string, text: string>>, "
    "choices array<struct<message: struct<content: string>>>, "
    "usage struct<input_tokens: int, output_tokens: int, prompt_tokens: int, completion_tokens: int>"
)


def parse_responses(responses: DataFrame, column: str = "respuesta") -> DataFrame:
    """Text and token usage of raw service responses.

    Takes the first ``text`` block (blocks of other types never reach a dialogue)
    or the first choice's message; missing usage counts as 0, a missing text fails.
    """
    body = F.from_json(column, RESPONSE_SCHEMA, {"mode": "FAILFAST"})
    parsed = responses.withColumn("r", body)
    visible = F.get(F.filter("r.content", lambda block: block["type"] == "text"), F.lit(0))["text"]
    message = F.get("r.choices", F.lit(0))["message"]["content"]
    return parsed.select(
        *[c for c in responses.columns if c != column],
        F.coalesce(visible, message, F.raise_error(F.lit("response without a text block"))).alias("texto"),
        F.coalesce("r.usage.input_tokens", "r.usage.prompt_tokens", F.lit(0)).alias("prompt_tokens"),
        F.coalesce("r.usage.output_tokens", "r.usage.completion_tokens", F.lit(0)).alias("completion_tokens"),
    )
