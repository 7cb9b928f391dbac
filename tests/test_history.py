"""Earlier facts and runs of state against plain loops, over many spans, with ties, nulls and a hot entity."""

import io
import random
import re
from contextlib import redirect_stdout
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import history

SCHEMA = "id long, who long, at timestamp, label string"
START = datetime(2024, 1, 1)


def rows_of(rng, n=400, people=5, hours=300, labels=("rojo", "verde", None)):
    rows = [(i, rng.choice([0, 0, 0, *range(people)]), START + timedelta(hours=rng.randrange(hours)), rng.choice(labels))
            for i in range(n)]
    return rows + [(n, None, START, "rojo"), (n + 1, 1, None, "rojo")]


@pytest.mark.parametrize("seconds", [3600, 86_400, 10_000_000_000])
def test_latest_before(spark, seconds):
    rows = rows_of(random.Random(seconds))
    frame = spark.createDataFrame(rows, SCHEMA)
    got = history.latest_before(
        frame.drop("label"), frame.where("label is not null"), key="who", time="at", order="id", values=["id", "label"],
        seconds=seconds).collect()
    assert len(got) == len(rows)
    for row in got:
        earlier = [(at, i, label) for i, who, at, label in rows
                   if None not in (label, who, at, row["who"], row["at"]) and who == row["who"] and at < row["at"]]
        best = max(earlier, default=None)
        assert (row["previo"] and tuple(row["previo"])) == (best and (best[1], best[2])), row


def plain_episodes(rows):
    out = []
    for person in {r[1] for r in rows if r[1] is not None and r[2] is not None}:
        mine = sorted((at, i, label == "rojo") for i, who, at, label in rows if who == person and at is not None)
        run = []
        for at, _, red in [*mine, (None, None, False)]:
            if red:
                run.append(at)
            elif run:
                out.append((person, run[0], run[-1], len(run), at is None))
                run = []
    return sorted(out)


@pytest.mark.parametrize("seed, labels", [(1, ("rojo", "verde", None)), (2, ("rojo",) * 9 + ("verde",)), (3, ("rojo",)),
                                          (4, ("verde", None))])
@pytest.mark.parametrize("seconds", [3600, 86_400, 10_000_000_000])
def test_episodes(spark, seed, labels, seconds):
    rows = rows_of(random.Random(seed), labels=labels)
    found = history.episodes(spark.createDataFrame(rows, SCHEMA), key="who", time="at", order="id",
                             state=F.col("label") == "rojo", seconds=seconds)
    assert sorted(tuple(r) for r in found.collect()) == plain_episodes(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert history.latest_before(none, none, key="who", time="at", order="id", values=["label"]).isEmpty()
    assert history.episodes(none, key="who", time="at", order="id", state=F.col("label") == "rojo").isEmpty()


def test_a_hot_entity_is_dealt_out_by_span(spark):
    """Rows are shuffled by entity and span; what is shuffled by the entity alone is one row a span."""
    frame = spark.createDataFrame([(1, 1, START, "rojo")], SCHEMA)
    for df in (history.episodes(frame, key="who", time="at", order="id", state=F.col("label") == "rojo"),
               history.latest_before(frame, frame, key="who", time="at", order="id", values=["label"])):
        shown = io.StringIO()
        with redirect_stdout(shown):
            df.explain()
        plan = shown.getvalue()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        for lone in re.findall(r"hashpartitioning\(clave#\d+, \d+\).*\n(.*)", plan):
            assert "Scan" not in lone
        assert re.search(r"hashpartitioning\(clave#\d+L?, tramo#\d+L?", plan)
