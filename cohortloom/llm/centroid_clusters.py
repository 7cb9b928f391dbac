"""Exact Lloyd clustering of whole-number vectors with bounds loosened by the norm of total displacement.

The centroids of all rounds are kept. For each vector and centroid the last exactly evaluated distance
is stored with the round it was evaluated in. In a later round that distance can have changed by no
more than the norm of the centroid's displacement between the two rounds, which is never more than the
sum of its moves round by round and stays small for a centroid that swings. A vector whose bounds leave
one candidate keeps its centroid without looking at its components; all others are evaluated anew,
exactly, for the centroids whose bounds fail.

As a bound depends on its own round and the current one only, a round does not need the state of the
round before: vectors are stored with their bounds every ``keep_every`` rounds, and the rounds between
read the same table. Vectors are held in blocks of some thousand rows, so a round is one narrow pass
over arrays and a sum of ``k * components`` numbers for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted, stored

BLOCK_ROWS = 4096
LARGEST = 1 << 27  # of a component: squared distances of 64 components then fit into a long
SAFE = 1 << 22  # up to here sums of squares are exact in double precision, too
BLOCK = "ids array<bigint>, points binary, near binary, dist binary, seen binary"
SLACK = 1e-6  # more than the rounding of stored distances (single precision) and of their comparison

History = list[np.ndarray]


def _squared(points: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    kind = np.float64 if max(np.abs(points).max(initial=0), np.abs(centroid).max()) <= SAFE else np.int64
    apart = points.astype(kind) - centroid.astype(kind)
    return np.einsum("ij,ij->i", apart, apart).astype(np.int64)


class Block:
    """Vectors with their bounds: ``dist[i, j]`` is the distance of vector i to centroid j of round ``seen[i, j]``."""

    def __init__(self, ids: pa.Array, points: np.ndarray, near=None, dist=None, seen=None) -> None:
        self.ids, self.points, self.near, self.dist, self.seen = ids, points, near, dist, seen

    @classmethod
    def of(cls, batch: pa.RecordBatch, at: int, components: int) -> "Block":
        ids = batch.column("ids").slice(at, 1).flatten()

        def array(name: str, kind: str, width: int | None) -> np.ndarray | None:
            raw = batch.column(name)[at].as_buffer()
            if raw is None:
                return None
            flat = np.frombuffer(raw, kind)
            return flat.reshape(len(ids), -1) if width else flat

        return cls(ids, array("points", "<i4", components), array("near", "<i4", None),
                   array("dist", "<f4", 1), array("seen", "<i2", 1))

    def evaluate(self, history: History) -> "Block":
        """Nearest centroids (the smaller number on ties) of the last round of ``history``, with new bounds."""
        now, centroids = len(history) - 1, history[-1]
        rows, k = len(self.points), len(centroids)
        if self.near is None:
            exact = np.stack([_squared(self.points, c) for c in centroids], axis=1)
            near = exact.argmin(axis=1).astype(np.int32)
            return Block(self.ids, self.points, near, np.sqrt(exact).astype(np.float32),
                         np.full((rows, k), now, np.int16))
        moved = np.stack([np.linalg.norm(centroids.astype(float) - then.astype(float), axis=1) for then in history])
        near, dist, seen = self.near.copy(), self.dist.copy(), self.seen.copy()
        reach = moved[seen, np.arange(k)]
        low = dist * (1.0 - SLACK) - reach - SLACK
        every = np.arange(rows)
        high = dist[every, near] * (1.0 + SLACK) + reach[every, near] + SLACK
        low[every, near] = np.inf
        open_rows = np.flatnonzero((low <= high[:, None]).any(axis=1))
        if not open_rows.size:
            return Block(self.ids, self.points, near, dist, seen)
        best = np.empty(len(open_rows), np.int64)  # of the stored centroid, exactly
        for j in range(k):
            own = np.flatnonzero(near[open_rows] == j)
            best[own] = _squared(self.points[open_rows[own]], centroids[j])
        held = near[open_rows]
        dist[open_rows, held], seen[open_rows, held] = np.sqrt(best), now
        high = np.sqrt(best) * (1.0 + SLACK) + SLACK
        choice = held.copy()
        for j in range(k):
            failed = np.flatnonzero(low[open_rows, j] <= high)
            there = _squared(self.points[open_rows[failed]], centroids[j])
            dist[open_rows[failed], j], seen[open_rows[failed], j] = np.sqrt(there), now
            wins = (there < best[failed]) | ((there == best[failed]) & (j < choice[failed]))
            choice[failed[wins]], best[failed[wins]] = j, there[wins]
        near[open_rows] = choice
        return Block(self.ids, self.points, near, dist, seen)

    def row(self) -> pa.RecordBatch:
        arrays = [self.points.astype("<i4", copy=False), self.near, self.dist, self.seen]
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(self.ids)], pa.int32()), self.ids.cast(pa.int64())),
             *[pa.array([None if a is None else a.tobytes()], pa.binary()) for a in arrays]],
            ["ids", "points", "near", "dist", "seen"])


def _whole_numbers(ids: pa.Array, vectors: pa.Array, components: int, scale: int) -> tuple[pa.Array, np.ndarray]:
    """Kept rows: exactly ``components`` numbers, none null, NaN or infinite; each becomes ``floor(scale * x)``."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(sizes == components)
    flat = vectors.take(pa.array(right)).flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, components)
    finite = np.isfinite(values).all(axis=1)
    scaled = np.floor(values[finite] * float(scale))
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a vector component is beyond {LARGEST // scale}: squared distances would not fit into a long")
    return ids.take(pa.array(right[finite])), scaled.astype(np.int32)


def blocks_of(vectors: DataFrame, components: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, points = _whole_numbers(batch.column("id"), batch.column("vector"), components, scale)
            for at in range(0, len(ids), BLOCK_ROWS):
                yield Block(ids.slice(at, BLOCK_ROWS), points[at:at + BLOCK_ROWS]).row()

    return vectors.mapInArrow(run, BLOCK)


def first_centroids(blocks: DataFrame, k: int, seed: int, components: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``; a null id comes last, equal ids by their vectors.
    Each block offers its own first ``k``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block.of(batch, at, components)
                marks = ["~" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
                         for i in block.ids.to_pylist()]
                order = sorted(range(len(marks)), key=lambda i: (marks[i], block.points[i].tolist()))[:k]
                yield pa.RecordBatch.from_pydict({
                    "mark": pa.array([marks[i] for i in order], pa.string()),
                    "vector": pa.array([block.points[i].tolist() for i in order], pa.list_(pa.int64()))})

    found = blocks.mapInArrow(run, "mark string, vector array<bigint>").orderBy("mark", "vector").limit(k).collect()
    return np.array([row["vector"] for row in found], np.int64).reshape(-1, components)


def _evaluated(blocks: DataFrame, history: History, components: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield Block.of(batch, at, components).evaluate(history).row()

    return blocks.mapInArrow(run, BLOCK)


def _sums(blocks: DataFrame, history: History, components: int, current: bool) -> tuple[np.ndarray, list[list[int]]]:
    """Vectors and component sums of each centroid. A task folds its blocks into one row a centroid."""
    k = len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, components), np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block.of(batch, at, components)
                block = block if current else block.evaluate(history)
                counts += np.bincount(block.near, minlength=k)
                for j in range(k):
                    sums[j] += block.points[block.near == j].sum(axis=0, dtype=np.int64)
        used = np.flatnonzero(counts)
        rows = np.concatenate([counts[used, None], sums[used]], axis=1)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(used, pa.int32()), "sums": pa.array(rows.tolist(), pa.list_(pa.int64()))})

    folded = blocks.mapInArrow(run, "cluster int, sums array<bigint>").select(
        "cluster", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at").agg(
        F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    out = [[0] * (components + 1) for _ in range(k)]
    for row in folded.collect():  # k * (components + 1) numbers
        out[row["cluster"]][row["at"]] = int(row["total"])
    return out


def clusters(vectors: DataFrame, *, k: int = 8, rounds: int = 10, components: int = 64, scale: int = 1024, seed: int = 3,
             keep_every: int = 4, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per kept vector: ``vec_id``, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia``,
    ``centroid_sha256``.

    Kept are vectors of exactly ``components`` numbers without null, NaN or infinity; components are
    ``floor(scale * x)`` (the job fails if one is beyond 2**27). Repeated rows are vectors of their own.
    With fewer than ``k`` vectors there are that many centroids; an empty table gives an empty result. A
    null ``vec_id`` takes part, but starts a centroid only if others are missing. Empty clusters keep
    their centroid. All arithmetic that decides is exact; ``keep_every`` changes the cost only.

    The driver holds ``rounds * k * components`` numbers, which every task gets.
    """
    found = vectors.select(quoted(vec_id).cast("bigint").alias("id"), quoted(embedding).alias("vector"))
    blocks = stored(blocks_of(found, components, scale), "blocks")
    history = [first_centroids(blocks, k, seed, components)]
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(history[0]):
        return vectors.sparkSession.createDataFrame(
            [], f"{schema}, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for number in range(rounds):
        keep = number % keep_every == 0
        if keep:
            blocks = stored(_evaluated(blocks, history, components), "blocks")
        folded = _sums(blocks, history, components, current=keep)
        history.append(np.array([
            [part // total[0] for part in total[1:]] if total[0] else old.tolist()
            for total, old in zip(folded, history[-1])], np.int64))
    last = history[-1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = Block.of(batch, at, components).evaluate(history)
                distance = np.empty(len(block.near), np.int64)
                for j in range(len(last)):
                    own = block.near == j
                    distance[own] = _squared(block.points[own], last[j])
                yield pa.RecordBatch.from_arrays(
                    [block.ids.cast(pa.int64()), pa.array(block.near, pa.int32()), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])

    rows = stored(blocks.mapInArrow(assign, schema), "assigned")
    spread = {row["cluster"]: int(row["total"]) for row in rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}  # at most k
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in last]
    at = F.col("cluster") + 1
    return rows.select(
        "vec_id", "cluster", "distance",
        F.element_at(F.array(*[F.lit(spread.get(j, 0)).cast("bigint") for j in range(len(last))]), at).alias("cluster_inertia"),
        F.lit(sum(spread.values())).cast("bigint").alias("inertia"),
        F.element_at(F.array(*[F.lit(mark) for mark in marks]), at).alias("centroid_sha256"))


def _oracle(k: int = 8, rounds: int = 10) -> str:
    """The same rounds as one chain of SQL tables."""
    steps = [f"""
WITH kept AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
v AS MATERIALIZED (SELECT r, vec_id, i, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, range(1, 65) s(i)),
c0 AS MATERIALIZED (SELECT c, i, x FROM v JOIN (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c
  FROM kept ORDER BY c LIMIT {k}) USING (r))"""]
    for at in range(rounds + 1):
        steps.append(f"""
a{at} AS MATERIALIZED (SELECT r, min(c) AS c, min(dist) AS dist FROM (
  SELECT r, c, sum((v.x - c{at}.x) * (v.x - c{at}.x)) AS dist FROM v JOIN c{at} USING (i) GROUP BY r, c)
  GROUP BY r, dist QUALIFY dist = min(dist) OVER (PARTITION BY r))""")
        if at < rounds:
            steps.append(f"""
c{at + 1} AS MATERIALIZED (SELECT o.c, o.i, coalesce(CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT), o.x) AS x
  FROM c{at} o LEFT JOIN (SELECT c, i, sum(x) AS s, count(*) AS n FROM v JOIN a{at} USING (r) GROUP BY c, i) m USING (c, i))""")
    return ",".join(steps) + f"""
SELECT kept.vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
  CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
  mark AS centroid_sha256
FROM a{rounds} JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS mark FROM c{rounds} GROUP BY c) USING (c)
"""


ORACLE = _oracle()
