"""Documents that hold passages of a benchmark.

For every benchmark item, windows of the item's number of words slide over each document, one word
at a time, and get two independent 64-bit SimHashes of their words. A multi-index over blocks of the
items' fingerprints gives all items within ``RADIUS`` bits in one of the two. Exact similarity of the
weighted five-word shingles (weight: occurrences; sum of minima over sum of maxima) then decides. A
window that shares no shingle with any item cannot pass that decision, so fingerprints are only
computed around words that start a shared shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.stored import quoted
from cohortloom.llm.words import U, Words, find_words, mixed, n_grams, parts, text_bytes

SHINGLE = 5
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16
PROBES = 1 << 20  # look-ups held at once
BLOCK_BYTES = 4 << 20  # benchmark text that goes to every task at once; more is worked off in blocks
REGION = 1 << 14  # words whose running sums are held at once
_FILTER_BITS = 22


def fingerprints(hashes: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """SimHash of the words ``start .. start + width`` for each start (sorted)."""
    out, at = np.zeros(len(start), np.uint64), 0
    while at < len(start):
        upto = int(np.searchsorted(start, start[at] + REGION, side="right"))
        low, high = start[at], start[upto - 1] + width
        bits = np.unpackbits(hashes[low:high].view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.zeros((high - low + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        ones = sums[start[at:upto] - low + width] - sums[start[at:upto] - low]
        out[at:upto] = np.packbits(2 * ones > width, axis=1).view(np.uint64).ravel()
        at = upto
    return out


def second(hashes: np.ndarray) -> np.ndarray:
    """Word hashes for the second fingerprint."""
    return mixed(hashes ^ U(0xA0761D6478BD642F))


def _flips(most: int) -> np.ndarray:
    """Masks that change up to ``most`` bits of a block."""
    return np.array([sum(1 << bit for bit in bits) for n in range(most + 1)
                     for bits in combinations(range(BLOCK_BITS), n)], np.uint64)


class HammingIndex:
    """All pairs (query, key) within ``radius`` bits.

    Of four blocks at least one differs in a fourth of the radius at most. Keys are filed under every value of
    each block that differs in one bit less than half of that, queries ask for the rest, so each pair within the
    radius meets under a value of some block; what meets is compared in full.
    """

    def __init__(self, keys: np.ndarray, radius: int = RADIUS) -> None:
        self.keys, self.radius = keys, radius
        spread = radius // BLOCKS
        filed, self.asked = _flips(spread // 2), _flips(spread - spread // 2)
        self.values, self.holders, self.present = [], [], []
        for block in range(BLOCKS):
            values = (self._block(keys, block)[:, None] ^ filed).ravel()
            order = np.argsort(values, kind="stable")
            self.values.append(values[order])
            self.holders.append(order // len(filed))
            present = np.zeros(1 << BLOCK_BITS, bool)
            present[values] = True
            self.present.append(np.packbits(present))

    @staticmethod
    def _block(fingerprints: np.ndarray, block: int) -> np.ndarray:
        return (fingerprints >> U(block * BLOCK_BITS)) & U((1 << BLOCK_BITS) - 1)

    def near(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, key, distance), each pair once."""
        pairs, step = [np.zeros(0, np.int64)], max(1, PROBES // len(self.asked))
        for at in range(0, len(asked), step):
            some = asked[at:at + step]
            for block in range(BLOCKS):
                probes = (self._block(some, block)[:, None] ^ self.asked).ravel()
                filed = self.present[block][probes >> U(3)] >> (U(7) - (probes & U(7))).astype(np.uint8) & 1
                hit = np.flatnonzero(filed)
                low = np.searchsorted(self.values[block], probes[hit], side="left")
                many = np.searchsorted(self.values[block], probes[hit], side="right") - low
                query = np.repeat(at + hit // len(self.asked), many)
                place = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                pairs.append(query * len(self.keys) + self.holders[block][place])
        query, key = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(self.keys)))
        distance = np.bitwise_count(asked[query] ^ self.keys[key])
        close = distance <= self.radius
        return query[close], key[close], distance[close]


class TwinIndex:
    """Keys with two fingerprints each; a pair is near if one of the two is."""

    def __init__(self, *keys: np.ndarray) -> None:
        self.parts = [HammingIndex(k) for k in keys]

    def near(self, *asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, key, smaller distance) of each pair."""
        found = [part.near(a) for part, a in zip(self.parts, asked)]
        width = max(1, len(self.parts[0].keys))
        query, key = np.divmod(np.unique(np.concatenate([q * width + k for q, k, _ in found])), width)
        distance = np.minimum(*[np.bitwise_count(a[query] ^ part.keys[key]) for part, a in zip(self.parts, asked)])
        return query, key, distance


class Benchmark:
    """A block of benchmark items, ready for comparison with documents."""

    def __init__(self, rows: list[tuple[int, str]], similarity: float) -> None:
        self.similarity = similarity
        data, offsets = text_bytes(pa.array([text for _, text in rows], pa.large_string()))
        words = find_words(data, offsets)
        size = np.diff(words.first)
        self.ids = [item for item, _ in rows]
        self.width = size
        self.shingles: list[dict[int, int]] = [{} for _ in rows]
        self.lengths = sorted({min(SHINGLE, int(n)) for n in size if n})
        holders: dict[int, dict[int, list[int]]] = {n: {} for n in self.lengths}
        for n in self.lengths:
            runs, first = n_grams(words, n)
            for i in np.flatnonzero(np.minimum(size, SHINGLE) == n):
                for value in runs[first[i]:first[i + 1]].tolist():
                    self.shingles[i][value] = self.shingles[i].get(value, 0) + 1
                for value in self.shingles[i]:
                    holders[n].setdefault(value, []).append(int(i))
        self.known = {n: np.array(sorted(holders[n]), np.uint64) for n in self.lengths}
        self.holders = {n: [np.array(holders[n][v]) for v in sorted(holders[n])] for n in self.lengths}
        self.maybe = {}
        for n in self.lengths:
            self.maybe[n] = np.zeros(1 << _FILTER_BITS, bool)
            self.maybe[n][self.known[n] >> U(64 - _FILTER_BITS)] = True
        self.by_width = {}
        for width in sorted({int(n) for n in size if n}):
            items = np.flatnonzero(size == width)
            starts = words.first[items]
            order = np.argsort(starts)
            items = items[order]
            self.by_width[width] = (items, TwinIndex(*[
                fingerprints(hashes, starts[order], width) for hashes in (words.hash, second(words.hash))]))

    def weighted(self, item: int, run: list[int]) -> float:
        """Sum of minima over sum of maxima of the shingles' occurrences."""
        wanted, seen = self.shingles[item], {}
        for value in run:
            seen[value] = seen.get(value, 0) + 1
        same = sum(min(n, wanted.get(value, 0)) for value, n in seen.items())
        return same / (len(run) + sum(wanted.values()) - same)

    def leaks(self, words: Words) -> list[tuple[int, int, int, int, int, float]]:
        """(row, item, first word, words, distance, similarity) of the best window per row and item."""
        spans: dict[tuple[int, int], list[np.ndarray]] = {}  # (row, width) -> window starts
        runs_of = {}
        for n in self.lengths:
            runs, first = n_grams(words, n)
            runs_of[n] = (runs, first)
            hit = np.flatnonzero(self.maybe[n][runs >> U(64 - _FILTER_BITS)])
            at = np.searchsorted(self.known[n], runs[hit])
            at[at == len(self.known[n])] = 0
            same = self.known[n][at] == runs[hit]
            hit, at = hit[same], at[same]
            rows = np.searchsorted(first, hit, side="right") - 1
            for position, row, shingle in zip((hit - first[rows]).tolist(), rows.tolist(), at.tolist()):
                size = int(words.first[row + 1] - words.first[row])
                for width in {int(self.width[i]) for i in self.holders[n][shingle]}:
                    low, high = max(0, position + n - width), min(position, max(0, size - width))
                    spans.setdefault((row, width), []).append(np.arange(low, max(low, high) + 1))
        best: dict[tuple[int, int], tuple] = {}
        twin = second(words.hash)
        for (row, width), starts in spans.items():
            start = np.unique(np.concatenate(starts))
            begin, size = int(words.first[row]), int(words.first[row + 1] - words.first[row])
            taken = min(width, size)
            start = start[start + taken <= size]
            items, index = self.by_width[width]
            query, key, distance = index.near(
                *[fingerprints(hashes, start + begin, taken) for hashes in (words.hash, twin)])
            n = min(SHINGLE, width)
            runs, first = runs_of[n]
            for q, k, bits in zip(query.tolist(), key.tolist(), distance.tolist()):
                item, at = int(items[k]), int(start[q])
                run = runs[first[row] + at:first[row] + at + max(taken - n + 1, 0)]
                score = self.weighted(item, run.tolist())
                held = best.get((row, item))
                if score >= self.similarity and (held is None or score > held[5]):
                    best[row, item] = (row, item, at, taken, bits, score)
        return sorted(best.values())


def _blocks(benchmark: DataFrame, similarity: float) -> Iterator[Benchmark]:
    block, size = [], 0
    for row in benchmark.where("item_id is not null and text is not null").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size > BLOCK_BYTES:
            yield Benchmark(block, similarity)
            block, size = [], 0
    yield Benchmark(block, similarity)


def _find(block: Benchmark):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in parts(batch.column("text")):
                ids = batch.column("doc_id")
                found = block.leaks(find_words(*text_bytes(batch.column("text").slice(at, upto - at))))
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([at + x[0] for x in found], pa.int64())),
                    pa.array([block.ids[x[1]] for x in found], pa.int64()),
                    *[pa.array([x[k] for x in found], pa.int64()) for k in (2, 3, 4)],
                    pa.array([round(x[5], 6) for x in found], pa.float64()),
                ], ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"])
    return run


def _drop(block: Benchmark, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc")
            texts = docs.field(docs.type.get_field_index(text))
            for at, upto in parts(texts):
                found = block.leaks(find_words(*text_bytes(texts.slice(at, upto - at))))
                keep = np.ones(upto - at, bool)
                keep[[x[0] for x in found]] = False
                yield pa.RecordBatch.from_arrays([docs.slice(at, upto - at).filter(pa.array(keep))], ["doc"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
          similarity: float = 0.8) -> DataFrame:
    """``doc_id``, ``item_id`` and best window of every benchmark item found in a document.

    Words are lower-cased (A-Z) and split at ASCII white space. Items of fewer than five words are
    one shingle; a document shorter than an item is one window. Null and empty texts hold nothing;
    items with a null id or text, or without words, are not looked for; equal items are found each.
    A null ``doc_id`` stays null; repeated rows give repeated results; of windows that tie the first
    counts. Other columns are not read. Empty tables give an empty result. No shuffle; the benchmark
    goes to the tasks in blocks of ``BLOCK_BYTES``, one pass over the documents each.
    """
    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    schema = T.StructType([plain.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in (
        "item_id", "start_word", "n_words", "distance")], T.StructField("similarity", T.DoubleType())])
    out = None
    for block in _blocks(benchmark.select(F.col("item_id").cast("long"), "text"), similarity):
        part = plain.mapInArrow(_find(block), schema)
        out = part if out is None else out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", similarity: float = 0.8) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found, with the same columns; see ``leaks``."""
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("doc"))
    for block in _blocks(benchmark.select(F.col("item_id").cast("long"), "text"), similarity):
        packed = packed.mapInArrow(_drop(block, text), packed.schema)
    return packed.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
