import corpus_pipeline
from conftest import SMALL

import __spark_entry__ as entry_point
from cohortloom.llm.jaccard_join import jaccard_classes
from cohortloom.llm.secret_scan import secrets


def test_names_are_registered():
    names = set(entry_point.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")} and "pipeline" in names


def test_stages_decide_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, SMALL)
    single = stages["ngram_jaccard_join"](spark, good, SMALL)
    clean = stages["benchmark_decontamination"](spark, single, SMALL)
    masked = stages["secret_scan"](spark, clean, SMALL)
    assert good.columns == single.columns == clean.columns == masked.columns == docs.columns
    classes = jaccard_classes(good, words=5, percent=80)
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in classes.collect()}
    assert 0 < clean.count() < single.count() < good.count() < docs.count()
    assert masked.count() == clean.count() and secrets(masked).where("spans != ''").count() == 0
    mixed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in clean.collect()}
    assert mixed.columns == [*docs.columns, "copy_no", "mix_position"]
