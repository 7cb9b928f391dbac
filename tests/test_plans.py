"""What the physical plans must and must not contain."""

import io
import re
from contextlib import redirect_stdout

import pytest
from conftest import SMALL

from cohortloom.plans.registry import QUERIES, TASKS

# Queries that write and read back while they run are covered by their parts.
LAZY = sorted(set(QUERIES) - {
    "resume_run", "bundle_roundtrip", "alert_append", "incremental_labels", "upsert_bucketed", "gold_roundtrip",
    "layered_names", "stream_resume", "windowed_label_share", "distinct_cases_sketch"})
NARROW = ["profiles", "trajectories", "labelled_cases", "adapted_profiles", "geo_sample", "turn_grid", "noise_stt",
          "noise_log", "noise_selection", "curated_rows", "parsed_responses", "parsed_variants", "rule_label_events"]


def plan_of(spark, name: str) -> str:
    shown = io.StringIO()
    with redirect_stdout(shown):
        QUERIES[name](spark, SMALL).explain("formatted")
    return shown.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = plan_of(spark, name)
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                     "Scan ExistingRDD"):
        assert operator not in plan
    assert "RoundRobinPartitioning" not in plan or name == "rerun_diff"  # which compares two partitionings


@pytest.mark.parametrize("name", NARROW)
def test_generators_do_not_shuffle_by_key(spark, name):
    assert not re.findall(r"\n\(\d+\) Exchange", plan_of(spark, name))


def test_one_file_tables_are_spread_on_request(spark):
    spark.conf.set(TASKS, "3")
    try:
        assert "RoundRobinPartitioning(3)" in plan_of(spark, "profiles")
    finally:
        spark.conf.unset(TASKS)


def test_history_needs_no_window(spark):
    assert "Window" not in plan_of(spark, "turn_history")


def test_scans_are_pruned(spark):
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(spark, "label_balance")
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan_of(spark, "noise_stt")
    assert "text" not in re.findall(r"ReadSchema: (\S+)", plan_of(spark, "noise_selection"))[0]


def test_digest_is_computed_once_per_row(spark):
    """Two digests per call row: archetype and day; the profile digest is the third."""
    assert plan_of(spark, "trajectories").count("sha2(") == 3


def test_layer2_rows_are_shuffled_once(spark):
    plan = plan_of(spark, "layer2_dialogues")
    assert len(re.findall(r"hashpartitioning\(caso_id#\d+, tramo#\d+", plan)) == 1
