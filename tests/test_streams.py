"""Streams with state: repeated and late rows, replayed batches, windows."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom import Settings
from cohortloom.operators import dialogues
from cohortloom.operators.adaptation import adapt_profiles
from cohortloom.operators.labels import label_cases
from cohortloom.operators.profiles import generate_profiles
from cohortloom.operators.sets import content_difference
from cohortloom.operators.trajectories import generate_trajectories
from cohortloom.sources.workspace import new_folder
from cohortloom.streaming import arrivals

SCHEMA = "id long, at timestamp, label string"
START = datetime(2024, 1, 1)


def rows(spark, *hours, first=0, label="rojo"):
    return spark.createDataFrame([(first + n, START + timedelta(hours=h), label) for n, h in enumerate(hours)], SCHEMA)


class Stream:
    def __init__(self, spark):
        self.spark = spark
        self.source, self.output, self.checkpoint = (new_folder(spark, n) for n in ("in", "out", "ck"))

    def arrive(self, df):
        df.coalesce(1).write.mode("append").parquet(self.source)

    def run(self):
        arrivals.distinct_stream(
            self.spark, self.source, rows(self.spark).schema, key="id", time="at", delay="2 hours",
            label=lambda df: df.select("id", F.upper("label").alias("label")), output=self.output,
            checkpoint=self.checkpoint)

    def written(self):
        return sorted(r["id"] for r in self.spark.read.parquet(self.output).collect())


def test_repeats_within_and_over_arrivals_and_late_rows(spark):
    stream = Stream(spark)
    stream.arrive(rows(spark, 0, 1, 10).unionByName(rows(spark, 0, 1, 10)))
    stream.run()
    assert stream.written() == [0, 1, 2]
    # 10: seen again; 9 hours: after the watermark (8), new; 3 hours: late; 12: new
    stream.arrive(rows(spark, 10, first=2).unionByName(rows(spark, 9, 3, 12, first=50)))
    stream.run()
    assert stream.written() == [0, 1, 2, 50, 52]
    label = lambda df: df.select("id", F.upper("label").alias("label"))
    told = arrivals.with_late_rows(spark.read.parquet(stream.source), spark.read.parquet(stream.output), "id", label)
    assert {r["id"]: r["estado"] for r in told.collect() if r["estado"] == arrivals.LATE} == {51: "tarde"}
    stream.run()  # nothing new
    assert stream.written() == [0, 1, 2, 50, 52]


def test_a_replayed_batch_changes_nothing(spark):
    """The job dies after the sink's commit and before the stream's own: the batch is run again."""
    stream = Stream(spark)
    stream.arrive(rows(spark, 0, 1, 10))
    stream.run()
    before = stream.written()
    commits = sorted((f for f in glob.glob(f"{stream.checkpoint.removeprefix('file:')}/commits/*") if os.path.basename(f).isdigit()),
                     key=lambda f: int(os.path.basename(f)))
    os.remove(commits[-1])
    crc = os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    stream.run()
    assert stream.written() == before
    stream.arrive(rows(spark, 11, first=9))
    stream.run()
    assert stream.written() == [*before, 9]


def test_windows_close_once_and_late_rows_are_counted(spark):
    source, output, checkpoint = (new_folder(spark, n) for n in ("in", "out", "ck"))

    def run():
        arrivals.windowed_counts(
            spark, source, rows(spark).schema, time="at", width="4 hours", delay="1 hour", label=F.col("label"),
            domain=["rojo", "verde"], output=output, checkpoint=checkpoint)

    rows(spark, 0, 1, 5).unionByName(rows(spark, 9, first=8, label="verde")).coalesce(1).write.mode("append").parquet(source)
    run()  # watermark 8: windows that end at 4 and 8 are closed
    rows(spark, 2, 9, 14, first=20).coalesce(1).write.mode("append").parquet(source)
    run()  # watermark 13: the window that ends at 12 is closed; the row at 2 is late
    shares = arrivals.windowed_shares(
        spark.read.parquet(output), spark.read.parquet(source), time="at", width="4 hours", domain=["rojo", "verde"],
        settings=Settings()).collect()
    got = {(r["inicio"][11:13], r["label"]): (r["n"], r["total"], r["tardias"]) for r in shares}
    assert got == {("00", "rojo"): (2, 2, 1), ("00", "verde"): (0, 2, 1), ("04", "rojo"): (1, 1, 0), ("04", "verde"): (0, 1, 0),
                   ("08", "rojo"): (1, 2, 0), ("08", "verde"): (1, 2, 0)}


def test_arriving_cases_become_dialogues_once(spark, settings):
    """Cases arrive in two lots, some of them twice; every case is spoken once, as in a single run."""
    people = generate_profiles(spark.range(0, 12).withColumnRenamed("id", "indice"), settings)
    cases = label_cases(generate_trajectories(people, settings), settings)
    context = dialogues.assign_style(dialogues.case_context(cases, people, adapt_profiles(people, settings)), settings)
    timed = context.withColumn("llegada", F.timestamp_seconds(F.col("dia_postop").cast("long") * 86_400)).cache()
    source, output, checkpoint = (new_folder(spark, n) for n in ("in", "out", "ck"))
    speak = lambda df: dialogues.layer1_rows(dialogues.template_turns(df.drop("llegada"), settings), settings)
    for lot in ("dia_postop <= 7", "dia_postop >= 7"):
        timed.where(lot).coalesce(1).write.mode("append").parquet(source)
        arrivals.distinct_stream(spark, source, timed.schema, key="caso_id", time="llegada", delay="1 day", label=speak,
                                 output=output, checkpoint=checkpoint)
    assert tuple(content_difference(spark.read.parquet(output), speak(timed)).first()) == (0, 0)


@pytest.mark.parametrize("hours", [()])
def test_an_empty_arrival(spark, hours):
    stream = Stream(spark)
    stream.arrive(rows(spark, *hours))
    stream.run()
    assert stream.spark.read.schema("id long, label string").parquet(stream.output).isEmpty()
