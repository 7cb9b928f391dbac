"""Clusters with bounds against plain rounds over all distances."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from compare import duck, spark_side, sql_side
from conftest import SMALL

import __spark_entry__ as entry_point
from cohortloom.llm import centroid_clusters as cc

SCHEMA = "vec_id bigint, embedding array<double>, Vector int"


def plain(rows, k, rounds, components, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == components and all(x is not None and math.isfinite(x) for x in v)]
    mark = lambda i: "~" if i is None else hashlib.sha256(f"3:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (mark(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    for at in range(rounds + 1):
        near = [min(range(len(centroids)), key=lambda j: (far(v, centroids[j]), j)) for _, v in kept]
        if at < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v), c in zip(kept, near) if c == j]
                if own:
                    centroids[j] = [sum(xs) // len(own) for xs in zip(*own)]
    distance = [far(v, centroids[c]) for (_, v), c in zip(kept, near)]
    spread = [sum(d for d, c in zip(distance, near) if c == j) for j in range(len(centroids))]
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(str(i), c, d, spread[c], sum(distance), marks[c])
                   for (i, _), c, d in zip(kept, near, distance)])


def got(df):
    return sorted((str(r["vec_id"]), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"])
                  for r in df.collect())


@pytest.mark.parametrize("keep_every", [1, 3, 50])
def test_equal_to_plain_rounds(spark, keep_every, monkeypatch):
    monkeypatch.setattr(cc, "BLOCK_ROWS", 64)
    rng = random.Random(3)
    rows = []
    for i in range(500):
        centre = rng.randrange(12)
        rows.append((i, [centre % 4 + rng.gauss(0, 0.4), centre // 4 + rng.gauss(0, 0.4), rng.gauss(0, 0.2)]))
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    assert got(cc.clusters(frame, k=8, rounds=10, components=3, keep_every=keep_every)) == plain(rows, 8, 10, 3)


def test_ties_repeats_nulls_and_odd_vectors(spark):
    rng = random.Random(4)
    rows = [(rng.choice([i, i, 7, None]), [float(rng.randrange(3)), float(rng.randrange(-2, 2))]) for i in range(200)]
    rows += rows[:40] + [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [math.nan, 1.0]), (6, [math.inf, 0.0]),
                         (8, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    assert got(cc.clusters(frame, k=6, rounds=5, components=2, scale=1)) == plain(rows, 6, 5, 2, scale=1)


def test_few_or_no_vectors(spark):
    rows = [(1, [0.5, 0.25]), (2, [1.5, -0.25])]
    assert got(cc.clusters(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), components=2)) == plain(rows, 8, 10, 2)
    none = cc.clusters(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components_stay_exact_or_fail():
    points = np.array([[2 ** 26, -2 ** 26], [3, 2 ** 26 - 1]], np.int32)
    assert cc._squared(points, np.array([-2 ** 26, 5])).tolist() == [
        (2 ** 27) ** 2 + (2 ** 26 + 5) ** 2, (2 ** 26 + 3) ** 2 + (2 ** 26 - 6) ** 2]
    with pytest.raises(ValueError, match="beyond"):
        cc._whole_numbers(pa.array([1]), pa.array([[1e9, 0.0]]), 2, 1024)


def test_a_swinging_centroid_costs_no_rescan():
    """A centroid that moves away and comes back has no displacement since the evaluation: no vector is looked at,
    though the sum of its moves is larger than any distance."""
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-20, 20, (50, 2)), rng.integers(980, 1020, (50, 2))]).astype(np.int32)
    home, away = np.array([[0, 0], [1000, 1000]]), np.array([[900, -900], [100, 2500]])
    block = cc.Block(pa.array(range(100)), points).evaluate([home])
    after = block.evaluate([home, away, home])
    assert (after.seen == 0).all() and (after.near == block.near).all()
    assert (block.evaluate([home, away]).seen == 1).any()


def test_query_equals_sql(spark):
    query = entry_point.queries()["op12_centroid_clusters"](spark, SMALL)
    assert spark_side(query) == sql_side(duck(SMALL), entry_point.oracle_sql()["op12_centroid_clusters"])
