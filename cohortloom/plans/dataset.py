"""The whole dataset as stored tables: each step reads tables and writes one table.

Steps are safe to repeat: generated tables are replaced by equal content in one switch,
dialogues continue with the cases still missing, alerts are appended per run. Tables and
audience views are names of the session's catalog, so every session reads them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom import contracts
from cohortloom.contracts import Contract
from cohortloom.operators import adaptation, curation, dialogues, labels, noise, profiles, trajectories
from cohortloom.plans import publish, quality
from cohortloom.settings import Settings
from cohortloom.sources import bundles
from cohortloom.sources.catalog import CatalogTable
from cohortloom.sources.layout import Layout

SILVER, BRONZE = "silver", "bronze"
BUNDLES = "documentos_pacientes"
KEYS = {contracts.LAYER1.table: "caso_id", contracts.LAYER3.table: "dialogo_id"}


class Dataset:
    def __init__(self, spark: SparkSession, layout: Layout, settings: Settings) -> None:
        self.spark, self.layout, self.settings = spark, layout, settings

    def stored(self, contract: Contract) -> CatalogTable:
        """Layer 1 is asked for its finished cases and layer 3 for its turns, so both are bucketed by that."""
        return CatalogTable(
            self.spark, self.layout.session_name(SILVER, contract.table), self.layout.path(SILVER, contract.table),
            contract.schema, KEYS.get(contract.table))

    def table(self, contract: Contract) -> DataFrame:
        return self.stored(contract).read()

    def make_profiles(self, entities: DataFrame) -> None:
        """Profiles as JSON documents, then parsed into the table."""
        documents = self.layout.path(BRONZE, BUNDLES)
        bundles.write_bundles(profiles.generate_profiles(entities, self.settings), documents)
        self.stored(contracts.PROFILES).replace(bundles.read_bundles(self.spark, documents))

    def make_trajectories(self) -> None:
        walks = trajectories.generate_trajectories(self.table(contracts.PROFILES), self.settings)
        self.stored(contracts.TRAJECTORIES).replace(walks)

    def make_adapted(self) -> None:
        people = adaptation.adapt_profiles(self.table(contracts.PROFILES), self.settings)
        self.stored(contracts.ADAPTED).replace(people)

    def make_cases(self) -> None:
        cases = labels.label_cases(self.table(contracts.TRAJECTORIES), self.settings)
        self.stored(contracts.CASES).replace(cases)

    def make_dialogues(self, generate: Callable[[DataFrame], DataFrame] | None = None, slices: int = 1) -> None:
        dialogues.run_batch(
            self.stored(contracts.LAYER1), self.table(contracts.CASES), self.table(contracts.PROFILES),
            self.table(contracts.ADAPTED), self.settings, generate, slices)

    def make_noise(self) -> None:
        """Layer 2 and its log: two narrow passes over stored layer 1 with equal draws, so
        the annotated rows are never kept in memory or written twice."""
        marked = noise.annotate_noise(
            self.table(contracts.LAYER1), self.settings.noise_intensity, self.settings.seed)
        self.stored(contracts.LAYER2).replace(noise.layer2_rows(marked, self.settings.run_ts))
        self.stored(contracts.NOISE_LOG).replace(
            noise.noise_log_rows(marked, self.settings.seed, self.settings.run_ts))

    def add_edge_cases(self, submissions: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Store accepted submissions; returns the rejected ones and the rule disagreements."""
        reviewed = curation.review(submissions)
        self.stored(contracts.LAYER3).upsert(curation.layer3_rows(reviewed, self.settings.run_ts))
        return curation.rejects(reviewed), curation.disagreements(reviewed)

    def publish(self) -> list[str]:
        """Check, log the advisory alerts, publish the audience tables. A blocking problem raises
        before anything is logged or published."""
        layer1, layer2 = self.table(contracts.LAYER1), self.table(contracts.LAYER2)
        layer3, cases = self.table(contracts.LAYER3), self.table(contracts.CASES)
        report = quality.quality_report(
            self.table(contracts.ADAPTED), cases, layer1, layer2, self.table(contracts.NOISE_LOG), layer3, self.settings)
        quality.gate(report)
        details = quality.balance_details(quality.label_balance(cases, self.settings), self.settings)
        alerts = quality.alert_rows(details, self.settings, self.settings.run_ts)
        self.stored(contracts.ALERTS).append(alerts)
        return publish.publish(self.spark, self.layout, report, layer1, layer2, layer3)

    def build(self, entities: DataFrame, generate: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
        """All steps in order; ``entities`` has one whole number ``indice`` per patient."""
        self.make_profiles(entities)
        self.make_trajectories()
        self.make_adapted()
        self.make_cases()
        self.make_dialogues(generate)
        self.make_noise()
        return self.publish()
