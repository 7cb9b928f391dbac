"""Plans that stay within their limits whatever the size of the entity table."""

from __future__ import annotations

import contextlib
import io

from cohortloom.operators import dialogues, noise
from cohortloom.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_finished_cases_are_never_broadcast(spark):
    cases = spark.range(20).selectExpr("cast(id as string) AS caso_id")
    assert "Broadcast" not in plan_of(dialogues.pending_cases(cases, cases.where("caso_id < '5'")))
    assert "Broadcast" not in plan_of(dialogues.finished_turns(cases, cases.where("caso_id < '5'")))


def test_turns_of_a_case_are_not_moved_for_its_history(spark):
    plan = plan_of(QUERIES["turn_history"](spark, SMALL))
    assert "Exchange" not in plan[:plan.index("Generate explode([0,1,2")]


def test_unchanged_noise_is_tested_above_the_noise(spark):
    plan = plan_of(QUERIES["unchanged_noise"](spark, SMALL))
    assert "Generate explode(array(" in plan


def test_numbering_is_the_same_when_turns_lie_together(spark):
    rows = spark.createDataFrame(
        [("a", 1, p, f"t{p}") for p in (0, 3, 4096, 9000, 9001)] + [("a", 3, 5, "u"), ("b", 1, 2, "v"), (None, 1, 7, "w")],
        "caso_id string, dia_postop int, turno_idx int, id string")
    group = ["caso_id", "dia_postop"]
    starts = noise.range_starts(rows.selectExpr(*group, "turno_idx", "1 AS filas"), group, "turno_idx")
    apart, together = (noise.dense_turn_index(rows, starts, group, "turno_idx", ["id"], kept) for kept in (False, True))
    assert together.columns == apart.columns
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
    assert {r.id: r.turno_idx for r in together.where("caso_id = 'a' and dia_postop = 1").collect()} == {
        "t0": 0, "t3": 1, "t4096": 2, "t9000": 3, "t9001": 4}
