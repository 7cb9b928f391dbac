from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom import contracts
from cohortloom.operators.profiles import generate_profiles
from cohortloom.operators.sets import content_difference
from cohortloom.plans.registry import event_rule
from cohortloom.sources import bundles, tables
from cohortloom.sources.catalog import table_in
from cohortloom.sources.layout import Layout
from cohortloom.sources.workspace import new_folder, shared_folder
from cohortloom.streaming.incremental import label_stream, resume_stream

PAIR = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def pairs(spark, **values):
    return spark.createDataFrame(list(values.items()), PAIR)


def content(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_upsert(spark):
    merged = tables.upsert(pairs(spark, a=1, b=2), pairs(spark, b=20, c=30), "k")
    assert content(merged) == {"a": 1, "b": 20, "c": 30} and merged.count() == 3
    twice = pairs(spark, b=1).unionByName(pairs(spark, b=2))
    for target in (pairs(spark, a=1), pairs(spark)):
        with pytest.raises(tables.DuplicateKeyError):
            tables.upsert(target, twice, "k")


def test_append(spark):
    path = new_folder(spark, "log")
    for run in (1, 2):
        tables.append_table(pairs(spark, a=run), path, PAIR)
    assert spark.read.parquet(path).count() == 2


def test_bundles_leave_no_orphans(spark, settings):
    path = new_folder(spark, "bundles")
    many, few = (generate_profiles(spark.range(n).withColumnRenamed("id", "indice"), settings) for n in (25, 1))
    for people, n in ((many, 25), (few, 1)):
        bundles.write_bundles(people, path)
        back = bundles.read_bundles(spark, path)
        assert back.count() == n
        assert contracts.schema_differences(back, contracts.PROFILES) == []
        assert tuple(content_difference(people, back.select(*people.columns)).first()) == (0, 0)


def test_malformed_bundle_fails(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"paciente_id": "p", "edad": "muchos"}\n')
    with pytest.raises(Exception, match="FAILFAST|Malformed|MALFORMED"):
        bundles.read_bundles(spark, str(tmp_path)).collect()


def test_layout():
    layout = Layout("/datos/", "base")
    assert layout.table_name("silver", "casos") == "base.silver.casos"
    assert layout.session_name("silver", "casos") == "base_silver.casos"
    assert layout.path("gold_comite", "vista") == "/datos/base/gold_comite/vista"
    assert layout.override("prueba").table_name("bronze", "x") == "prueba.bronze.x"
    assert layout.override("") == layout.override(None) == layout
    with pytest.raises(KeyError):
        layout.path("oro", "x")


def test_shared_folder_is_the_sessions(spark):
    assert new_folder(spark, "x").startswith(shared_folder(spark) + "/x-")
    assert spark.conf.get("spark.checkpoint.dir") == shared_folder(spark)


def test_content_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, "a")] * 3 + [(2, None)], "n int, t string")
    right = spark.createDataFrame([(1, "a")] + [(3, "c")], "n int, t string")
    assert tuple(content_difference(left, right).first()) == (3, 1)
    assert tuple(content_difference(left, left.withColumn("t", F.lit("z")), ignore=("t",)).first()) == (0, 0)


def events(spark, first, last):
    return spark.range(first, last).select(
        F.col("id").alias("event_id"), F.lit("error").alias("event_type"), (F.col("id") * 1.5).alias("value"),
        F.col("id").alias("user_id"))


def test_stream_labels_each_arrival_once(spark):
    source, output, checkpoint = (new_folder(spark, n) for n in ("in", "out", "ck"))
    schema = events(spark, 0, 1).schema
    for first, last in ((0, 50), (50, 80), (80, 80)):
        events(spark, first, last).write.mode("append").parquet(source)
        label_stream(spark, source, schema, event_rule, output, checkpoint)
        done = spark.read.parquet(output)
        assert tuple(content_difference(done, event_rule(events(spark, 0, last))).first()) == (0, 0)


def test_stream_of_batches_resumes(spark):
    source, checkpoint = new_folder(spark, "in"), new_folder(spark, "ck")
    table = table_in(spark, new_folder(spark, "t"), PAIR, "k", buckets=4)
    for batch in ({"a": 1, "b": 2}, {"b": 3, "c": 4}):
        pairs(spark, **batch).coalesce(1).write.mode("append").parquet(source)
        resume_stream(spark, source, PAIR, table.upsert, checkpoint)
    assert content(table.read()) == {"a": 1, "b": 3, "c": 4}
    assert Path(checkpoint).exists()
