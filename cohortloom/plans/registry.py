"""Named queries over the driver's tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom import contracts
from cohortloom import reference_data as ref
from cohortloom.functions import draws
from cohortloom.functions.constants import constant_table
from cohortloom.functions.noise_text import add_noise
from cohortloom.operators import adaptation, curation, dialogues, labels, noise, responses, sets, templates
from cohortloom.plans import guards, publish, quality, reports
from cohortloom.plans import histories  # noqa: F401  registers the queries over time
from cohortloom.plans.inputs import LINKED_PER_TASK, Inputs, event_rule, stream_source
from cohortloom.plans.named import QUERIES, TASKS, as_text, query
from cohortloom.sources import bundles
from cohortloom.sources.catalog import CatalogTable, table_in
from cohortloom.sources.layout import Layout
from cohortloom.sources.tables import append_table, upsert
from cohortloom.sources.workspace import new_folder
from cohortloom.streaming.incremental import label_stream

SECOND_RUN = datetime(2026, 1, 2, 3, 4, 5, 678901)
CUSTOM_IDIOMS = {"une": "una", "que": "ke", "the": "el", " la ": " lla ", "tion": "ción", "ing": "in", "and": "an",
                 "er": "or", " de ": " di ", "en": "em", "ou": "u"}
TEMPLATE_SCHEMA = "modulo string, rol string, plantilla string"
PRICE_PROMPT, PRICE_COMPLETION = 3.0, 15.0


# --- draws, profiles, trajectories, labels ---
@query
def seed_parity(x: Inputs) -> DataFrame:
    keyed = x.entities().withColumn("d", draws.digest("paridad", F.col("indice"), x.settings.seed))
    d = draws.Draws("d")
    return keyed.select(
        "indice",
        d.word(0).alias("semilla"),
        d.uniform(1).alias("u"),
        d.int_between(2, 5, 17).alias("entero"),
        d.pick(3, ref.STYLES).alias("eleccion"),
        d.pick(4, ["a", "a", "b"]).alias("eleccion_ponderada"),
        d.below(5, "0.3D").alias("acierto"),
        F.expr(draws.one_decimal_sql(d.real_sql(6, "36.2D", "37.4D"))).alias("decimal"),
    )


@query
def profiles_(x: Inputs) -> DataFrame:
    return x.profiles().withColumns({
        "fecha_cirugia": F.col("fecha_cirugia").cast("string"), "comorbilidades": F.concat_ws(",", "comorbilidades")})


@query
def bundle_roundtrip(x: Inputs) -> DataFrame:
    folder = new_folder(x.spark, "bundles")
    bundles.write_bundles(x.profiles(), folder)
    return bundles.read_bundles(x.spark, folder).withColumns({
        "fecha_cirugia": F.col("fecha_cirugia").cast("string"),
        "comorbilidades": F.concat_ws(",", "comorbilidades"),
        "generado": F.date_format("generado_ts", "yyyy-MM-dd HH:mm:ss"),
    })


@query
def complication_rate(x: Inputs) -> DataFrame:
    return reports.complication_rate(x.profiles())


@query
def comorbidity_rate(x: Inputs) -> DataFrame:
    """Share of patients with each comorbidity of their procedure's pool."""
    return reports.comorbidity_rate(x.profiles())


@query
def trajectories(x: Inputs) -> DataFrame:
    return x.trajectories()


@query
def archetype_mix(x: Inputs) -> DataFrame:
    return reports.archetype_mix(x.trajectories(), x.settings.call_days[0])


@query
def labelled_cases(x: Inputs) -> DataFrame:
    return x.cases()


@query
def rule_label_events(x: Inputs) -> DataFrame:
    return event_rule(x.table("events"))


@query
def incremental_labels(x: Inputs) -> DataFrame:
    source, schema = stream_source(x, "events")
    output = new_folder(x.spark, "labels")
    label_stream(x.spark, source, schema, event_rule, output, new_folder(x.spark, "stream"))
    return x.spark.read.parquet(output)


@query
def last_call_label(x: Inputs) -> DataFrame:
    return reports.last_call(x.cases())


@query
def red_persistence(x: Inputs) -> DataFrame:
    return reports.red_persistence(x.cases())


# --- demographic adaptation ---
@query
def geo_sample(x: Inputs) -> DataFrame:
    drawn = x.entities().withColumn("d", draws.digest("geo", F.col("indice"), x.settings.seed))
    return adaptation.weighted_department(drawn, draws.Draws("d").uniform(0)).select("indice", "departamento", "ciudad")


@query
def adapted_profiles(x: Inputs) -> DataFrame:
    return x.adapted().withColumn("adaptation_fields", F.concat_ws(",", "adaptation_fields"))


@query
def geo_weights(x: Inputs) -> DataFrame:
    return reports.geo_weights(x.adapted())


@query
def geo_distribution(x: Inputs) -> DataFrame:
    return reports.geo_distribution(x.adapted())


# --- dialogues ---
@query
def case_context(x: Inputs) -> DataFrame:
    found = dialogues.case_context(x.cases(), x.profiles(), x.adapted())
    return found.select(
        "caso_id", "paciente_id", "dia_postop", "label", "procedimiento",
        "perfil_colombia.nombre_completo", "perfil_colombia.ciudad", "perfil_colombia.edad",
        *[f"vector_sintomas.{name}" for name in ref.SYMPTOMS])


@query
def style_mix(x: Inputs) -> DataFrame:
    return dialogues.assign_style(x.cases(), x.settings).groupBy("estilo_paciente").agg(
        F.count(F.lit(1)).alias("casos"))


@query
def patient_prompts(x: Inputs) -> DataFrame:
    return x.context().select("caso_id", dialogues.patient_prompt().alias("prompt"))


@query
def turn_grid(x: Inputs) -> DataFrame:
    return dialogues.turn_grid(x.cases().select("caso_id", "dia_postop"))


@query
def layer1_dialogues(x: Inputs) -> DataFrame:
    return as_text(x.generated_layer1(), "prompt_tokens", "completion_tokens")


@query
def turn_history(x: Inputs) -> DataFrame:
    return dialogues.turn_history(x.generated_layer1(), together=True).select(
        "dialogo_id", "turno_idx", "hablante", F.size("historial").alias("mensajes"),
        F.array_join("historial", "\n").alias("texto_historial"))


@query
def token_totals(x: Inputs) -> DataFrame:
    return dialogues.token_totals(x.generated_layer1(by_case=True))


def _done(x: Inputs) -> DataFrame:
    """Turns left by a run that was interrupted after about a third of the cases."""
    drawn = x.cases().withColumn("d", draws.digest("hecho", F.col("caso_id")))
    return dialogues.turn_grid(drawn.where(draws.Draws("d").below(0, "0.35D")).select("caso_id"))


@query
def pending_cases(x: Inputs) -> DataFrame:
    return dialogues.pending_cases(x.cases(), _done(x)).select("caso_id", "paciente_id", "dia_postop", "label")


@query
def token_projection(x: Inputs) -> DataFrame:
    """Finished and pending cases of one population: the mean of the former is paid for the latter."""
    done = _done(x)
    pending = dialogues.pending_cases(x.cases(), done)
    finished = dialogues.finished_turns(x.generated_layer1(by_case=True), done)
    return reports.token_projection(dialogues.token_totals(finished), pending, PRICE_PROMPT, PRICE_COMPLETION)


@query
def resume_run(x: Inputs) -> DataFrame:
    """An interrupted run that covered the first two call days, then a run over everything."""
    table = dialogues.new_layer1(x.spark, new_folder(x.spark, "layer1"), x.tasks_for())
    cases, (people, adapted) = x.dealt_cases(), x.dealt_people()
    early = cases.where(F.col("dia_postop").isin(list(x.settings.call_days[:2])))
    dialogues.run_batch(table, early, people, adapted, x.settings)
    dialogues.run_batch(table, cases, people, adapted, x.settings)
    return as_text(table.read(), "prompt_tokens", "completion_tokens")


UPSERT_COLUMNS = ["dialogo_id", "caso_id", "turno_idx", "hablante", "texto", "label_ground_truth"]


def _changes(x: Inputs) -> DataFrame:
    """Noisy turns under the id of their original; third-party turns are new."""
    original = F.when(F.col("hablante") != "tercero", F.col("dialogo_id_capa1")).otherwise(F.col("dialogo_id"))
    return x.layer2().where(F.col("intensidad_ruido").isNotNull()).withColumn("dialogo_id", original).select(
        *UPSERT_COLUMNS)


@query
def upsert_dialogues(x: Inputs) -> DataFrame:
    """Layer 1 with its noisy turns merged in."""
    return upsert(x.layer1().select(*UPSERT_COLUMNS), _changes(x), "dialogo_id")


@query
def upsert_bucketed(x: Inputs) -> DataFrame:
    """The same as a stored table bucketed by turn: filled in one upsert, changed in a second one."""
    turns = x.layer1().select(*UPSERT_COLUMNS)
    table = table_in(x.spark, new_folder(x.spark, "turnos"), turns.schema, "dialogo_id", buckets=8)
    table.upsert(turns)
    table.upsert(_changes(x))
    return table.read()


@query
def label_leak(x: Inputs) -> DataFrame:
    prompts = x.context().select(
        F.lit("prompt_paciente").alias("fuente"), "label", dialogues.patient_prompt().alias("texto"))
    spoken = x.generated_layer1().select(
        F.concat(F.lit("turno_"), "hablante").alias("fuente"), F.col("label_ground_truth").alias("label"), "texto")
    stored = x.layer1().select(
        F.lit("conversaciones").alias("fuente"), F.col("label_ground_truth").alias("label"),
        F.when(F.col("turno_idx") == 2, F.concat("texto", F.lit(" Caso "), F.upper("label_ground_truth")))
        .otherwise(F.col("texto")).alias("texto"))
    return reports.label_leak(prompts.unionByName(spoken).unionByName(stored))


@query
def parsed_responses(x: Inputs) -> DataFrame:
    def block(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    hidden = F.array(block("thinking", F.lit("oculto")), block("text", F.col("text")), block("text", F.lit("otro")))
    usage = F.when(F.col("turn") % 2 == 0, F.struct(
        F.length("text").alias("input_tokens"), F.col("turn").cast("int").alias("output_tokens")))
    raw = x.table("conversations").select(
        "conv_id", "turn", F.to_json(F.struct(hidden.alias("content"), usage.alias("usage"))).alias("respuesta"))
    return dialogues.parse_responses(raw)


@query
def parsed_variants(x: Inputs) -> DataFrame:
    """Responses of three shapes, broken ones, ones without a text and ones with impossible counts."""
    def struct(**fields: Column) -> Column:
        return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))

    shape, text, words = (F.col("conv_id") + F.col("turn")) % 6, F.col("text"), F.length("text")
    blocks = F.array(*[F.struct(F.lit(kind).alias("type"), value.alias("text")) for kind, value in
                       (("thinking", F.lit("oculto")), ("text", text))])
    usage = F.struct(words.alias("input_tokens"), F.col("turn").alias("output_tokens"))
    message = F.array(F.struct(F.struct(text.alias("content")).alias("message")))
    quoted = F.struct(words.cast("string").alias("entrada"))
    raw = (F.when(shape == 0, struct(content=blocks, usage=usage))
           .when(shape == 1, struct(choices=message, model=F.lit("otro")))
           .when(shape == 2, struct(output=F.struct(text.alias("text")), tokens=quoted))
           .when(shape == 3, F.concat(F.lit('{"content": ['), F.to_json(F.struct(text.alias("text")))))
           .when(shape == 4, struct(content=F.slice(blocks, 1, 1), usage=usage))
           .otherwise(struct(content=blocks, usage=F.struct(F.lit(-1).alias("prompt_tokens")))))
    rows = x.table("conversations").select("conv_id", "turn", raw.alias("respuesta"))
    return as_text(responses.parse_variants(rows), "prompt_tokens", "completion_tokens")


def _prompt_values(x: Inputs) -> DataFrame:
    """Cases with the map of values that templates may use; the label is none of them."""
    found = x.context().join(x.profiles().select("paciente_id", F.col("modulo_synthea").alias("modulo")), "paciente_id")
    person, symptoms = "perfil_colombia", "vector_sintomas"
    values = {"nombre": f"{person}.nombre_completo", "edad": f"{person}.edad", "ciudad": f"{person}.ciudad",
              "procedimiento": "procedimiento", "dia": "dia_postop", "estilo": "estilo_paciente",
              **{name: f"{symptoms}.{name}" for name in ref.SYMPTOMS}}
    pairs = [column for name, path in values.items() for column in (F.lit(name), F.col(path).cast("string"))]
    return found.select("caso_id", "modulo", F.create_map(*pairs).alias("valores"))


@query
def prompts_by_template(x: Inputs) -> DataFrame:
    rendered = templates.render(_prompt_values(x), constant_table(x.spark, ref.TEMPLATES, TEMPLATE_SCHEMA))
    return rendered.withColumn("sin_valor", F.array_join("sin_valor", ","))


@query
def template_gaps(x: Inputs) -> DataFrame:
    """Slots without a value, and modules without a template, as rows."""
    cases, known = _prompt_values(x), constant_table(x.spark, ref.TEMPLATES, TEMPLATE_SCHEMA)
    return templates.unknown_slots(cases, known).unionByName(
        templates.unmatched(cases, known), allowMissingColumns=True)


@query
def guard_outcomes(x: Inputs) -> DataFrame:
    """What the noise and the style guards would refuse, on requests that are right for most turns."""
    n, at = len(ref.NOISE_RANGES), F.col("turno_idx") + F.col("conversacion")
    kinds = draws.constant_array([name for name, _, _ in ref.NOISE_RANGES] + ["eco"])
    numbered = x.layer1().withColumn("conversacion", F.substring_index("caso_id", "_", -1).cast("long"))
    asked = numbered.withColumns({
        "tipo_ruido": F.element_at(kinds, (at % (n + 1) + 1).cast("int")),
        "intensidad": F.when(F.col("conversacion") % 11 != 0, (F.col("conversacion") % 7).cast("int")),
        "estilo_paciente": F.when(at % 13 == 0, "alegre").when(at % 17 != 0, F.col("estilo_paciente"))})
    by_noise = guards.guard_outcomes(asked, guards.noise_guards()).withColumn("grupo", F.lit("ruido"))
    by_style = guards.guard_outcomes(asked, guards.style_guards()).withColumn("grupo", F.lit("estilo"))
    return by_noise.unionByName(by_style)


@query
def catalogue_gap(x: Inputs) -> DataFrame:
    """Modules asked for by customers that have no calibration: every market segment stands for a module of that
    name, but for two that are known."""
    known = {"BUILDING": "appendicitis", "MACHINERY": "breast_cancer"}
    module = F.coalesce(*[F.when(F.col("c_mktsegment") == name, module) for name, module in known.items()],
                        F.lower("c_mktsegment"))
    return guards.uncalibrated_modules(x.table("customer", "c_mktsegment").select(module.alias("modulo")))


# --- noise ---
@query
def noise_selection(x: Inputs) -> DataFrame:
    swept = x.layer1().select("dialogo_id", F.explode(F.lit([0, 1, 2, 3, 4, 5, 6])).alias("intensidad"))
    return noise.select_noise(swept, F.col("intensidad"), x.settings.seed).select(
        "dialogo_id", "intensidad", F.coalesce("tipo_ruido", F.lit("ninguno")).alias("tipo_ruido"))


@query
def noise_stt(x: Inputs) -> DataFrame:
    spaced = F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("  doble fin "))).otherwise(F.col("text"))
    texts = x.rows("documents", "doc_id", "text").select("doc_id", spaced.alias("texto"))
    return texts.select("doc_id", add_noise("texto", "ruido_stt", 3, x.settings.seed).alias("texto_ruidoso"))


@query
def noise_idiom(x: Inputs) -> DataFrame:
    return x.generated_layer1().select(
        "dialogo_id", add_noise("texto", "modismo_regional", 3, x.settings.seed).alias("texto_ruidoso"))


@query
def noise_idiom_custom(x: Inputs) -> DataFrame:
    noisy = add_noise("texto", "modismo_regional", 2, x.settings.seed, CUSTOM_IDIOMS)
    return x.layer1().select("dialogo_id", noisy.alias("texto_ruidoso"))


@query
def noise_ambiguous(x: Inputs) -> DataFrame:
    leveled = x.layer1().withColumn("nivel", F.col("turno_idx") % 3 + 2)
    return leveled.select(
        "dialogo_id", F.col("nivel").alias("intensidad"),
        add_noise("texto", "respuesta_ambigua", "nivel", x.settings.seed).alias("texto_ruidoso"))


@query
def noise_contradiction(x: Inputs) -> DataFrame:
    return x.layer1().select(
        "dialogo_id", add_noise("texto", "contradiccion", 3, x.settings.seed).alias("texto_ruidoso"))


@query
def noise_missing(x: Inputs) -> DataFrame:
    return x.layer1().select(
        "dialogo_id", add_noise("texto", "informacion_faltante", 3, x.settings.seed).alias("texto_ruidoso"))


@query
def layer2_dialogues(x: Inputs) -> DataFrame:
    return as_text(x.layer2(), "intensidad_ruido")


@query
def layer2_generated(x: Inputs) -> DataFrame:
    """Layer 2 of the generated dialogues, in full."""
    return as_text(x.layer2(x.generated_layer1(), together=True), "intensidad_ruido")


@query
def noise_lineage_generated(x: Inputs) -> DataFrame:
    layer1 = x.generated_layer1(patients=LINKED_PER_TASK)
    return noise.noise_lineage(
        layer1, x.layer2(layer1, together=True), x.log(layer1, "paciente_id"), together=True)


@query
def noise_audit(x: Inputs) -> DataFrame:
    return reports.noise_audit(x.annotated(x.generated_layer1()))


@query
def noise_third_party(x: Inputs) -> DataFrame:
    return as_text(x.layer2().where(F.col("hablante") == "tercero"), "intensidad_ruido")


@query
def noise_log(x: Inputs) -> DataFrame:
    return x.log()


@query
def noise_lineage(x: Inputs) -> DataFrame:
    return noise.noise_lineage(x.layer1(), x.layer2(), x.log())


@query
def noise_summary(x: Inputs) -> DataFrame:
    return reports.noise_summary(x.annotated(x.generated_layer1()))


@query
def unchanged_noise(x: Inputs) -> DataFrame:
    return reports.unchanged_noise(x.log(x.generated_layer1()))


# --- curation ---
@query
def curated_rows(x: Inputs) -> DataFrame:
    return x.layer3().drop("prompt_tokens", "completion_tokens")


@query
def curation_rejects(x: Inputs) -> DataFrame:
    return curation.rejects(curation.review(x.submissions()))


@query
def rule_disagreement(x: Inputs) -> DataFrame:
    return curation.disagreements(curation.review(x.submissions()))


# --- quality and publication ---
@query
def demographic_nulls(x: Inputs) -> DataFrame:
    return quality.demographic_violations(x.adapted_with_faults())


@query
def label_balance(x: Inputs) -> DataFrame:
    """Label shares per call day, and the quality labels of ``labels`` with a value outside the domain."""
    per_day = quality.label_balance(x.cases(), x.settings, by=("dia_postop",))
    stored = x.table("labels", "doc_id", "quality").select(
        F.lit(-1).alias("dia_postop"),
        F.when(F.col("doc_id") % 50 == 0, "otra").otherwise(F.col("quality").cast("string")).alias("label"))
    other = quality.label_balance(stored, x.settings, domain=["0", "1", "2"], by=("dia_postop",))
    return per_day.unionByName(other)


@query
def blank_turns(x: Inputs) -> DataFrame:
    return quality.blank_turns(x.layer1_with_faults())


@query
def speaker_coverage(x: Inputs) -> DataFrame:
    return quality.speaker_coverage(x.layer1_with_faults())


@query
def silent_changes(x: Inputs) -> DataFrame:
    return quality.silent_changes(x.layer2(), x.log_with_gaps())


@query
def unreviewed_cases(x: Inputs) -> DataFrame:
    return quality.unreviewed_cases(x.layer3_unchecked())


@query
def label_drift(x: Inputs) -> DataFrame:
    return quality.label_drift(x.layer1(), x.layer2_with_faults())


@query
def contract_violations(x: Inputs) -> DataFrame:
    """Trajectories and cases, four rows a patient, are derived twice: folded by the rules they break, which also gives
    the label shares of the alerts, and as keys. The entities are spread evenly, so a task's keys fit its memory."""
    people, adapted, calls = x.even_people()
    folded = x.cases_with_faults(
        calls.withColumns({"rotas_llamada": contracts.broken_rules(contracts.TRAJECTORIES), "sano": labels.triage_of_columns()}),
        ("rotas_llamada", "sano"),
    ).groupBy(
        "dia_postop", "sano", "rotas_llamada", contracts.broken_rules(contracts.CASES).alias("rotas_caso")
    ).agg(F.count(F.lit(1)).alias("filas"))
    balance = quality.label_balance(folded, x.settings, "sano", by=("dia_postop",), weight="filas")
    patients = [(x.profiles_with_copies(people), contracts.PROFILES), (x.adapted_with_faults(adapted), contracts.ADAPTED)]
    tables = [
        (_balance_alerts(x, balance, x.settings.run_ts), contracts.ALERTS),
        (x.layer1(), contracts.LAYER1),
        (x.layer2_with_faults(), contracts.LAYER2),
        (x.log(), contracts.NOISE_LOG),
        (x.layer3_unchecked(), contracts.LAYER3),
    ]
    return reduce(DataFrame.unionByName, [
        contracts.folded_violations(folded, contracts.TRAJECTORIES, "rotas_llamada", "filas"),
        contracts.folded_violations(folded, contracts.CASES, "rotas_caso", "filas"),
        contracts.repeated_keys(x.cases_with_faults(calls), contracts.TRAJECTORIES, contracts.CASES),
        *[check(df, contract) for df, contract in patients for check in (contracts.violations, contracts.repeated_keys)],
        *[contracts.checks(df, contract) for df, contract in tables],
    ])


@query
def quality_report(x: Inputs) -> DataFrame:
    return quality.quality_report(
        x.adapted_with_faults(), x.cases(), x.layer1_with_faults(), x.layer2(), x.log_with_gaps(),
        x.layer3_unchecked(), x.settings)


def _day_alerts(x: Inputs, run_ts: datetime) -> DataFrame:
    return _balance_alerts(x, quality.label_balance(x.cases(), x.settings, by=("dia_postop",)), run_ts)


def _balance_alerts(x: Inputs, balance: DataFrame, run_ts: datetime) -> DataFrame:
    in_order = balance.withColumn("orden", F.col("dia_postop") * 10 + F.col("orden"))
    details = quality.balance_details(in_order, x.settings)
    return quality.alert_rows(details, x.settings, run_ts)


@query
def alert_rows(x: Inputs) -> DataFrame:
    return _day_alerts(x, x.settings.run_ts)


@query
def alert_append(x: Inputs) -> DataFrame:
    """Two runs into one log; the second one has a label outside the domain."""
    path = new_folder(x.spark, "alerts")
    append_table(_day_alerts(x, x.settings.run_ts), path, contracts.ALERTS.schema)
    strange = x.cases().withColumn(
        "label", F.when(F.col("label") == "verde", "desconocido").otherwise(F.col("label")))
    later = quality.balance_details(quality.label_balance(strange, x.settings), x.settings)
    append_table(
        quality.alert_rows(later, replace(x.settings, catalog="otro"), SECOND_RUN), path, contracts.ALERTS.schema)
    return x.spark.read.schema(contracts.ALERTS.schema).parquet(path)


@query
def gold_participants(x: Inputs) -> DataFrame:
    return publish.participant_view(x.layer1(), x.layer2())


@query
def gold_committee(x: Inputs) -> DataFrame:
    return publish.committee_view(x.layer1(), x.layer2(), x.layer3())


@query
def gold_roundtrip(x: Inputs) -> DataFrame:
    """Published twice, first without layer 3, and read by another session under the names of the catalog."""
    folder = new_folder(x.spark, "oro")
    layout = Layout(folder, folder.rsplit("/", 1)[1].replace("-", "_"))
    layer1, layer2, layer3 = x.layer1(), x.layer2(), x.layer3()
    for edge_cases in (layer3.where("false"), layer3):
        publish.write_gold(x.spark, layout, layer1, layer2, edge_cases)
    other = x.spark.newSession()
    seen = [other.table(table.name).withColumn("vista", F.lit(name)) for table, name in
            zip(publish.gold_tables(other, layout), ("participantes", "comite"))]
    return seen[0].unionByName(seen[1])


@query
def layered_names(x: Inputs) -> DataFrame:
    """Cases stored under three catalogs (the configured one, an override, an empty override) and read by name;
    the first one is replaced by a smaller table afterwards."""
    folder = new_folder(x.spark, "capas")
    base = Layout(folder, folder.rsplit("/", 1)[1].replace("-", "_"))
    catalogs = [("base", base), ("otro", base.override(base.catalog + "_otro")), ("vacio", base.override(""))]
    first, last = x.settings.call_days[0], x.settings.call_days[-1]
    writes = [(base, x.cases()), (catalogs[1][1], x.cases().where(F.col("dia_postop") == first)),
              (base, x.cases().where(F.col("dia_postop") == last))]
    table = contracts.CASES.table

    def stored(layout: Layout) -> CatalogTable:
        return CatalogTable(x.spark, layout.session_name("silver", table), layout.path("silver", table),
                            contracts.CASES.schema)

    for layout, rows in writes:
        stored(layout).replace(rows)
    found = [x.spark.table(stored(layout).name).groupBy("dia_postop").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "catalogo", F.lit(name)) for name, layout in catalogs]
    return reduce(DataFrame.unionByName, found)


@query
def audience_leak(x: Inputs) -> DataFrame:
    visible = publish.audience_leak(publish.participant_view(x.layer1(), x.layer2()), x.layer3())
    planted = publish.audience_leak(publish.committee_view(x.layer1(), x.layer2(), x.layer3()), x.layer3())
    return visible.withColumn("vista", F.lit("participantes")).unionByName(
        planted.withColumn("vista", F.lit("comite")))


@query
def rerun_diff(x: Inputs) -> DataFrame:
    """Layer 2 of the same rows, spread evenly over seven partitions and by text over five."""
    first = x.layer2(x.layer1().repartition(7))
    second = x.layer2(x.layer1().repartition(5, "texto"))
    return sets.content_difference(first, second, ignore=("generado_ts",))


QUERIES["profiles"] = QUERIES.pop("profiles_")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """What share of calls is green, yellow and red on each call day?"""
    x = Inputs(spark, folder)
    return quality.label_balance(x.cases(), x.settings, by=("dia_postop",))
