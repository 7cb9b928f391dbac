"""The resumable batch stores its turns by an upsert."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F
from test_catalog import PAIR, no_broadcast  # noqa: F401  a fixture

from cohortloom.operators import dialogues
from cohortloom.operators.adaptation import adapt_profiles
from cohortloom.operators.labels import label_cases
from cohortloom.operators.profiles import generate_profiles
from cohortloom.operators.sets import content_difference
from cohortloom.operators.trajectories import generate_trajectories
from cohortloom.settings import Settings
from cohortloom.sources.catalog import table_in
from cohortloom.sources.workspace import new_folder


def table(spark):
    return table_in(spark, new_folder(spark, "lotes"), PAIR, "k", buckets=4)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), PAIR)


def content(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def people(spark):
    settings = Settings(seed=7)
    profiles = generate_profiles(spark.range(12).withColumnRenamed("id", "indice"), settings).cache()
    cases = label_cases(generate_trajectories(profiles, settings), settings).cache()
    return settings, cases, profiles, adapt_profiles(profiles, settings).cache()


def test_a_case_stored_meanwhile_is_not_stored_twice(spark, people):
    settings, cases, profiles, adapted = people
    layer1 = dialogues.new_layer1(spark, new_folder(spark, "capa1"), 4)

    def late(context):
        dialogues.run_batch(layer1, cases.where("dia_postop < 7"), profiles, adapted, settings)  # another run
        return dialogues.template_turns(context, settings)

    dialogues.run_batch(layer1, cases, profiles, adapted, settings, late)
    assert layer1.read().count() == layer1.read().select("dialogo_id").distinct().count() == 12 * 4 * 12
    once = dialogues.new_layer1(spark, new_folder(spark, "once"), 4)
    dialogues.run_batch(once, cases, profiles, adapted, settings)
    assert tuple(content_difference(once.read(), layer1.read()).first()) == (0, 0)


def test_a_finished_case_needs_no_profile(spark, people):
    settings, cases, profiles, adapted = people
    layer1 = dialogues.new_layer1(spark, new_folder(spark, "capa1"), 4)
    gone = profiles.first()["paciente_id"]
    left = profiles.where(F.col("paciente_id") != gone)
    done = cases.where(F.col("paciente_id") == gone)
    dialogues.run_batch(layer1, done, profiles, adapted, settings)
    used = lambda context: dialogues.template_turns(
        context.withColumn("caso_id", F.when(F.col("procedimiento") != "", F.col("caso_id"))), settings)
    dialogues.run_batch(layer1, cases, left, adapted, settings, used)
    assert layer1.read().select("caso_id").distinct().count() == 48
    with pytest.raises(Exception, match="no profile for patient"):
        dialogues.run_batch(dialogues.new_layer1(spark, new_folder(spark, "otra"), 4), cases, left, adapted, settings, used)


def test_merge_inserts_without_writing_again(spark):
    t = table(spark)
    t.merge(rows(spark, ("a", 1), ("a", 2), ("b", 1)), "v")
    version, held = t.version(), t.read()
    files = set(spark.table(version).inputFiles())
    t.merge(rows(spark, ("c", 1), ("c", 1), (None, 3)), "v")
    assert t.version() == version and files < set(spark.table(version).inputFiles())
    want = [("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 1)]
    assert content(t.read().where("k is not null")) == want and t.read().where("k is null").count() == 1
    assert content(spark.newSession().table(t.name).where("k is not null")) == want
    assert {len(r) for r in held.collect()} == {2}


def test_merge_replaces_matched_rows_only(spark):
    t = table(spark)
    t.merge(rows(spark, ("a", 1), ("a", 2), ("a", 2), ("b", 1)), "v")
    t.merge(rows(spark, ("a", 2), ("a", 3), ("c", 9)), "v")
    want = [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 9)]
    assert content(t.read()) == want
    t.merge(rows(spark, ("a", 2), ("a", 3), ("c", 9)), "v")  # again, as after a lost answer
    assert content(t.read()) == want
    t.merge(rows(spark), "v")
    assert content(t.read()) == want
    with pytest.raises(ValueError, match="no key"):
        table_in(spark, new_folder(spark, "lotes"), PAIR).merge(rows(spark, ("a", 1)), "v")


def test_a_merge_that_dies_leaves_the_old_rows(spark):
    t = table(spark)
    t.merge(rows(spark, ("a", 1)), "v")
    bad = rows(spark, ("b", 2)).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        t.merge(bad, "v")
    assert content(t.read()) == [("a", 1)]


def test_the_question_for_shared_keys_moves_no_row(spark, no_broadcast):  # noqa: F811
    t, staged = table(spark), table(spark)
    t.merge(rows(spark, ("a", 1)), "v")
    staged.merge(rows(spark, ("a", 1), ("b", 1)), "v")
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        t.shared_keys(staged.read()).explain()
    assert "Exchange" not in shown.getvalue() and shown.getvalue().count("Bucketed: true") == 2
    assert content(t.shared_keys(staged.read())) == [("a",)]
