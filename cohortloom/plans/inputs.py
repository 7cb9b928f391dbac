"""The driver's tables seen as inputs of the engine.

Every row of ``orders`` (or ``customer``) is one patient, every row of
``conversations`` one dialogue turn. Violations for the checks are derived in the
plan, never written to the source tables.
"""

from __future__ import annotations

from datetime import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import reference_data as ref
from cohortloom.functions import draws
from cohortloom.functions.draws import constant_array
from cohortloom.operators import adaptation, curation, dialogues, labels, noise, profiles, trajectories
from cohortloom.settings import Settings
from cohortloom.sources.tables import scan
from cohortloom.sources.workspace import new_folder

ENTITY_KEYS = {"orders": "o_orderkey", "customer": "c_custkey"}
FIXED_RUN = datetime(2026, 1, 1)  # of the named queries, so that their results can be compared
PATIENTS_PER_TASK = 12_000  # of dealt tables: some 600,000 turns, which a task sorts in memory
CALLED_PER_TASK = 60_000  # of evenly spread tables, whose patients have a few calls each and no turns
LINKED_PER_TASK = 4_000  # of dealt tables whose turns meet in a task as three tables at once, two of them hashed
LEAST_TASKS = 32
SPEAKERS = {"user": "paciente", "assistant": "agente"}


class Inputs:
    """Lazily derived tables for one source folder."""

    def __init__(self, spark: SparkSession, folder: str, settings: Settings | None = None, tasks: int = 0) -> None:
        """``tasks`` spreads the columns read from a source table over that many partitions. It is for
        tables of one file, which cannot be split; by default nothing is shuffled for it."""
        self.spark, self.folder, self.tasks = spark, folder, tasks
        self.settings = settings or Settings(run_ts=FIXED_RUN)
        # One plan per derived table, so a query that uses a table twice builds it once.
        for name in ("scanned", "entities", "tasks_for", "dealt_entities", "dealt_cases", "profiles", "adapted", "trajectories", "cases", "context", "generated_layer1",
                     "layer1", "annotated", "layer2", "log", "submissions", "layer3"):
            setattr(self, name, cache(getattr(self, name)))

    def scanned(self, name: str) -> DataFrame:
        return scan(self.spark, self.folder, name)

    def table(self, name: str, *columns: str) -> DataFrame:
        return self.scanned(name).select(*columns) if columns else self.scanned(name)

    def rows(self, name: str, *columns: str) -> DataFrame:
        found = self.table(name, *columns)
        return found.repartition(self.tasks) if self.tasks else found

    # --- generated tables ---
    def entities(self, table: str = "orders") -> DataFrame:
        return self.rows(table, ENTITY_KEYS[table]).select(F.col(ENTITY_KEYS[table]).alias("indice"))

    def profiles(self, table: str = "orders") -> DataFrame:
        return profiles.generate_profiles(self.entities(table), self.settings)

    def adapted(self, table: str = "orders") -> DataFrame:
        ids = self.entities(table).select(profiles.patient_id(F.col("indice"), self.settings.seed).alias("paciente_id"))
        return adaptation.adapt_profiles(ids, self.settings)

    def trajectories(self, table: str = "orders") -> DataFrame:
        return trajectories.generate_trajectories(self.profiles(table), self.settings)

    def cases(self, table: str = "orders") -> DataFrame:
        return labels.label_cases(self.trajectories(table), self.settings)

    def tasks_for(self, table: str = "orders", patients: int = PATIENTS_PER_TASK) -> int:
        """Partitions for what is derived from a table: so many that each one fits a task, whatever the table's size."""
        return max(LEAST_TASKS, self.tasks, -(-self.table(table, ENTITY_KEYS[table]).count() // patients))

    def even_entities(self, table: str = "orders") -> DataFrame:
        """Entities spread by their position, the same number for each task, whatever ids repeat."""
        placed = self.entities(table).withColumn("fila", F.monotonically_increasing_id())
        return placed.repartition(self.tasks_for(table, CALLED_PER_TASK), "fila").drop("fila")

    def even_people(self, table: str = "orders") -> tuple[DataFrame, DataFrame, DataFrame]:
        """Profiles, adapted profiles and trajectories of evenly spread entities."""
        entities = self.even_entities(table)
        people = profiles.generate_profiles(entities, self.settings)
        ids = entities.select(profiles.patient_id(F.col("indice"), self.settings.seed).alias("paciente_id"))
        return (people, adaptation.adapt_profiles(ids, self.settings),
                trajectories.generate_trajectories(people, self.settings))

    def dealt_entities(self, table: str = "orders", patients: int = PATIENTS_PER_TASK) -> DataFrame:
        """Entities dealt out by patient while a row is an index and an id: what is derived from them meets by patient
        without another exchange. The number is given, as the rows of these few bytes grow to many turns."""
        named = self.entities(table).withColumn("paciente_id", profiles.patient_id(F.col("indice"), self.settings.seed))
        return named.repartition(self.tasks_for(table, patients), "paciente_id")

    def dealt_people(
        self, table: str = "orders", patients: int = PATIENTS_PER_TASK
    ) -> tuple[DataFrame, DataFrame]:
        """Profiles and adapted profiles, dealt out by patient. A task's share is small, so it is hashed, not sorted;
        a table that grows with the input is never broadcast."""
        entities = self.dealt_entities(table, patients)
        people = profiles.generate_profiles(entities, self.settings)
        adapted = adaptation.adapt_profiles(entities.select("paciente_id"), self.settings)
        return people.hint("shuffle_hash"), adapted.hint("shuffle_hash")

    def dealt_cases(self, table: str = "orders", patients: int = PATIENTS_PER_TASK) -> DataFrame:
        people = profiles.generate_profiles(self.dealt_entities(table, patients), self.settings)
        return labels.label_cases(trajectories.generate_trajectories(people, self.settings), self.settings)

    def context(
        self, table: str = "orders", by_case: bool = False, patients: int = PATIENTS_PER_TASK
    ) -> DataFrame:
        """Dealt out by patient. ``by_case`` deals the cases out before they have turns, so a step that needs the turns of
        a case together, and not those of a patient, moves none of them."""
        found = dialogues.assign_style(dialogues.case_context(
            self.dealt_cases(table, patients), *self.dealt_people(table, patients)), self.settings)
        return found.repartition(self.tasks_for(table, patients), "caso_id") if by_case else found

    def generated_layer1(
        self, table: str = "orders", by_case: bool = False, patients: int = PATIENTS_PER_TASK
    ) -> DataFrame:
        return dialogues.layer1_rows(
            dialogues.template_turns(self.context(table, by_case, patients), self.settings), self.settings)

    # --- conversations as layer 1 ---
    def layer1(self) -> DataFrame:
        rows = self.rows("conversations")
        conversation = F.col("conv_id").cast("string")
        case = F.concat(F.lit("conv_"), conversation)
        d = draws.Draws("d")
        speaker = F.col("role")
        for role, name in SPEAKERS.items():
            speaker = F.when(F.col("role") == role, name).otherwise(speaker)
        keyed = rows.withColumn("d", draws.digest("conversacion", F.col("conv_id"), self.settings.seed))
        return keyed.select(
            F.concat(F.lit("dlg_"), case, F.lit("_"), F.col("turn").cast("string")).alias("dialogo_id"),
            case.alias("caso_id"),
            profiles.patient_id(F.col("conv_id"), self.settings.seed).alias("paciente_id"),
            F.lit(0).alias("dia_postop"),
            F.col("turn").cast("int").alias("turno_idx"),
            speaker.alias("hablante"),
            F.col("text").alias("texto"),
            d.pick(0, ref.LABELS).alias("label_ground_truth"),
            d.pick(1, ref.STYLES).alias("estilo_paciente"),
            F.lit(self.settings.model_name).alias("modelo_paciente"),
            F.lit(self.settings.model_name).alias("modelo_agente"),
            F.lit(None).cast("int").alias("prompt_tokens"),
            F.lit(None).cast("int").alias("completion_tokens"),
            F.lit(self.settings.run_ts).alias("generado_ts"),
        )

    def annotated(self, layer1: DataFrame | None = None) -> DataFrame:
        return noise.annotate_noise(
            self.layer1() if layer1 is None else layer1, self.settings.noise_intensity, self.settings.seed)

    def layer2(self, layer1: DataFrame | None = None, together: bool = False) -> DataFrame:
        return noise.layer2_rows(self.annotated(layer1), self.settings.run_ts, together)

    def log(self, layer1: DataFrame | None = None, *kept: str) -> DataFrame:
        return noise.noise_log_rows(self.annotated(layer1), self.settings.seed, self.settings.run_ts, *kept)

    # --- edge-case submissions, one per customer ---
    def submissions(self) -> DataFrame:
        k = F.col("c_custkey")

        def nth(values: list, index: Column, kind: str = "string") -> Column:
            return F.element_at(constant_array(values, kind), (index % len(values) + 1).cast("int"))

        symptoms = F.struct(
            (k % 11).cast("int").alias("dolor_nrs"),
            (F.lit(36.0) + (k % 36) / 10.0).alias("fiebre_c"),
            nth(ref.MOBILITY, k).alias("movilidad"),
            nth(ref.WOUND, k).alias("herida"),
            nth(ref.APPETITE, k).alias("apetito"),
            nth(ref.SLEEP, F.floor(k / 3)).alias("sueno"),
        )
        turns = F.transform(F.sequence(F.lit(0), (k % 3 + 1).cast("int")), lambda t: F.struct(
            F.concat(F.lit("lim_"), k.cast("string"), F.lit("_"), t.cast("string")).alias("dialogo_id"),
            t.alias("turno_idx"),
            F.when(t % 2 == 0, "agente").otherwise("paciente").alias("hablante"),
            F.concat(F.lit("Turno "), t.cast("string"), F.lit(" de "), F.col("c_name")).alias("texto"),
        ))
        return self.table("customer", "c_custkey", "c_name").select(
            F.concat(F.lit("envio_"), k.cast("string")).alias("envio_id"),
            F.concat(F.lit("limite_"), k.cast("string")).alias("caso_id"),
            profiles.patient_id(k, self.settings.seed).alias("paciente_id"),
            nth(self.settings.call_days, k, "int").alias("dia_postop"),
            nth([*ref.EDGE_CATEGORIES, "otra"], k).alias("categoria_caso_limite"),
            F.when(k % 7 == 1, "").when(k % 7 > 1, F.concat(F.lit("revision_"), (k % 3).cast("string")))
            .alias("validado_por"),
            F.when(k % 11 == 0, "").when(k % 11 > 1, F.concat(F.lit("criterio_"), (k % 4).cast("string")))
            .alias("criterio_clinico_ref"),
            nth(ref.LABELS, k).alias("label_ground_truth"),
            F.when(k % 6 != 0, symptoms).alias("sintomas"),
            turns.alias("turnos"),
        )

    def layer3(self) -> DataFrame:
        return curation.layer3_rows(curation.review(self.submissions()), self.settings.run_ts)

    # --- planted violations ---
    def layer3_unchecked(self) -> DataFrame:
        """Submissions stored without review."""
        unchecked = self.submissions().withColumn("motivo_rechazo", F.lit(None).cast("string"))
        return curation.layer3_rows(unchecked, self.settings.run_ts)

    def profiles_with_copies(self, people: DataFrame | None = None) -> DataFrame:
        """Every 400th patient stored three times."""
        at = F.substring_index("paciente_id", "_", -1).cast("long")
        copies = F.when(at % 400 == 5, F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))
        people = self.profiles() if people is None else people
        return people.withColumn("copia", F.explode(copies)).drop("copia")

    def layer1_with_faults(self) -> DataFrame:
        conversation = F.substring_index("caso_id", "_", -1).cast("long")
        return self.layer1().where((F.col("hablante") != "agente") | (conversation % 13 != 0)).withColumn(
            "texto",
            F.when((conversation % 17 == 0) & (F.col("turno_idx") == 1), "   ").otherwise(F.col("texto")))

    def log_with_gaps(self) -> DataFrame:
        return self.log().where(draws.stable_seed("omitir", F.col("dialogo_id_capa1")) % 10 != 0)

    def layer2_with_faults(self) -> DataFrame:
        pick = draws.stable_seed("etiqueta", F.col("dialogo_id_capa1")) % 10
        return self.layer2().withColumns({
            "label_ground_truth": F.when(pick == 0, "desconocido").otherwise(F.col("label_ground_truth")),
            "intensidad_ruido": F.when(pick == 1, F.col("intensidad_ruido") + 3).otherwise(F.col("intensidad_ruido")),
        })

    def adapted_with_faults(self, adapted: DataFrame | None = None) -> DataFrame:
        at = F.substring_index("paciente_id", "_", -1).cast("long") % 1000
        return (self.adapted() if adapted is None else adapted).withColumns({
            "eps": F.when(at == 1, F.lit(None)).when(at == 2, "").when(at == 3, "  ").otherwise(F.col("eps")),
            "adapted_country": F.when(at == 4, F.lit(None)).when(at == 5, "US").otherwise(F.col("adapted_country")),
        })

    def cases_with_faults(self, trajectories: DataFrame | None = None, kept: tuple[str, ...] = ()) -> DataFrame:
        at = F.substring_index("paciente_id", "_", -1).cast("long") % 500
        broken = (self.trajectories() if trajectories is None else trajectories).withColumn(
            "fiebre_c",
            F.when(at == 7, F.lit(None)).when(at == 8, F.lit(float("nan"))).otherwise(F.col("fiebre_c")))
        return labels.label_cases(broken, self.settings, kept)


def event_label() -> Column:
    """The generic rule on foreign columns. Every 97th value is missing, so its label is too."""
    value = F.when(F.col("event_id") % 97 != 0, F.col("value"))
    kind = F.col("event_type")
    return labels.rule_label(
        red_any=[value >= 150.0, (kind == "error") & (value >= 60.0)],
        yellow=[value >= 40.0, kind.isin("error", "purchase"), F.col("user_id") % 2 == 0],
        min_yellow=2,
        numeric_inputs=[value],
    )


def event_rule(events: DataFrame, *carried: str) -> DataFrame:
    return events.select("event_id", "event_type", *carried, event_label().alias("label"))


def stream_source(x: Inputs, table: str) -> tuple[str, T.StructType]:
    """Folder that a stream can read: the table's own if it is a folder, else its rows as files of one."""
    path = f"{x.folder}/{table}.parquet"
    listed = x.spark.read.format("binaryFile").load(path).select("path").limit(1).first()
    if listed and listed["path"].rstrip("/").endswith(f"/{table}.parquet"):
        path = new_folder(x.spark, table)
        x.table(table).write.parquet(path)
    return path, x.table(table).schema
