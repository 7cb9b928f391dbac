"""Named queries over time: earlier labels, red episodes, streams with state, sketches by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.operators import history
from cohortloom.plans import reports
from cohortloom.plans.inputs import Inputs, event_label, event_rule
from cohortloom.plans.named import query
from cohortloom.sources.workspace import new_folder
from cohortloom.streaming import arrivals

DELAY, WINDOW = "6 hours", "12 hours"


def labelled_events(x: Inputs) -> DataFrame:
    """Events as calls: when, of whom, which label."""
    events = x.table("events")
    return event_rule(events, "ts", "user_id").withColumn("ts", F.col("ts").cast("timestamp"))


@query
def label_at_event(x: Inputs) -> DataFrame:
    """For each event the label of its user's latest strictly earlier event that has one."""
    events = labelled_events(x)
    found = history.latest_before(
        events.select("event_id", "user_id", "ts"), events.where("label is not null"), key="user_id", time="ts",
        order="event_id", values=["event_id", "label"])
    return found.select("event_id", "user_id", F.coalesce("previo.event_id", F.lit(-1)).alias("evento_previo"),
                        F.coalesce("previo.label", F.lit("ninguno")).alias("label_previo"))


@query
def red_episodes(x: Inputs) -> DataFrame:
    runs = history.episodes(labelled_events(x), key="user_id", time="ts", order="event_id", state=F.col("label") == "rojo")
    shown = {name: F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS") for name in ("inicio", "fin")}
    return runs.withColumns(shown)


def _arrive(x: Inputs, source: str, number: int) -> None:
    """Two arrivals of events. The second one brings the later half, every tenth event of the first half that was held
    back, and every seventh event of the first half once more."""
    events = x.table("events", "event_id", "ts", "user_id", "event_type", "value").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    half = (events.agg(F.max("event_id")).first()[0] or 0) // 2
    first = (F.col("event_id") <= half) & (F.col("event_id") % 10 != 0)
    again = first & (F.col("event_id") % 7 == 0)
    (events.where(first) if number == 1 else events.where(~first).unionByName(events.where(again))).write.mode(
        "append").parquet(source)


@query
def stream_resume(x: Inputs) -> DataFrame:
    """Each event labelled once over two arrivals on one checkpoint; late ones are listed as such."""
    source, output, checkpoint = (new_folder(x.spark, name) for name in ("llegadas", "etiquetas", "avance"))
    for number in (1, 2):
        _arrive(x, source, number)
        schema = x.spark.read.parquet(source).schema
        arrivals.distinct_stream(
            x.spark, source, schema, key="event_id", time="ts", delay=DELAY, label=event_rule, output=output,
            checkpoint=checkpoint)
    return arrivals.with_late_rows(x.spark.read.parquet(source), x.spark.read.parquet(output), "event_id", event_rule)


@query
def windowed_label_share(x: Inputs) -> DataFrame:
    """Label shares of the windows that the watermark closed over two arrivals, with the rows that came too late."""
    source, output, checkpoint = (new_folder(x.spark, name) for name in ("llegadas", "ventanas", "avance"))
    for number in (1, 2):
        _arrive(x, source, number)
        schema = x.spark.read.parquet(source).schema
        arrivals.windowed_counts(
            x.spark, source, schema, time="ts", width=WINDOW, delay=DELAY, label=event_label(), domain=ref.LABELS,
            output=output, checkpoint=checkpoint)
    return arrivals.windowed_shares(
        x.spark.read.parquet(output), x.spark.read.parquet(source), time="ts", width=WINDOW, domain=ref.LABELS,
        settings=x.settings)


@query
def distinct_cases_sketch(x: Inputs) -> DataFrame:
    """Patients with a call that is not green, per call day and in all, from stored daily states. The calls are labelled
    once and stored, as every day, the one pass and the exact counts look at them."""
    folder, called = new_folder(x.spark, "estados"), new_folder(x.spark, "llamadas")
    x.dealt_cases().where("label <> 'verde'").select("dia_postop", "paciente_id").write.parquet(called)
    cases = x.spark.read.parquet(called)
    for day in x.settings.call_days:
        reports.daily_sketches(cases.where(F.col("dia_postop") == day), "paciente_id").write.mode("append").parquet(folder)
    return reports.distinct_from_sketches(x.spark.read.parquet(folder), cases, "paciente_id")
