"""What each filter of a chain removes, in every order, and what it would have removed alone.

Texts are read once by a table-driven transducer over their bytes: a class per byte, two states
(inside a word or between words), and for each pair of state and byte the actions to take. Every
row of the transition table resets the state, so the state before a byte is the target of the byte
before it and the whole pass is a few table look-ups on arrays, carried over cuts of a long text.
Spans of words go into an open-addressing hash table whose hits are verified byte by byte, so
distinct words are counted exactly.

A filter chain depends on a document only through the set of filters it fails, so documents are
counted by part and that set before any order is unfolded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted, stored
from cohortloom.llm.words import BYTES_AS_THEY_ARE, SLICE, mixed, slices, span_hashes, text_bytes

# --- the transducer ---
BETWEEN, INSIDE = 0, 1
OPEN, CLOSE, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8, 16
WHITE = [0x20, *range(0x09, 0x0E)]
SYMBOLS = b"#$%&*|"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """State after each byte, and the actions for each pair of state and byte."""
    after = np.full(256, INSIDE, np.uint8)
    after[WHITE] = BETWEEN
    actions = np.zeros((2, 256), np.uint8)
    actions[:, :0x80] |= POINT  # of UTF-8, all bytes but 80-BF start a code point
    actions[:, 0xC0:] |= POINT
    actions[:, ord("A"):ord("Z") + 1] |= CAPITAL
    actions[:, list(SYMBOLS)] |= SYMBOL
    actions[BETWEEN, after == INSIDE] |= OPEN
    actions[INSIDE, after == BETWEEN] |= CLOSE
    return after, actions


AFTER, ACTIONS = _tables()


class Run:
    """Counts per text and word spans of texts that lie one after the other; every text starts and
    ends between words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        after = AFTER[data]
        before = np.empty_like(after)
        before[1:] = after[:-1]
        filled = np.diff(offsets) > 0
        before[offsets[:-1][filled]] = BETWEEN
        acts = ACTIONS[before, data]
        closed = np.zeros(len(data) + 1, bool)
        closed[:-1] = acts & CLOSE != 0
        last = offsets[1:][filled]
        closed[last] |= after[last - 1] == INSIDE
        self.start, self.end = np.flatnonzero(acts & OPEN), np.flatnonzero(closed)
        self.first = np.searchsorted(self.start, offsets)
        self.words = np.diff(self.first)
        self.capitals, self.symbols = (
            np.diff(np.searchsorted(np.flatnonzero(acts & act), offsets)) for act in (CAPITAL, SYMBOL))
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum(acts & POINT != 0, out=points[1:])
        self.points = np.diff(points[offsets])


def _eight_bytes(padded: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each position as one number; bytes beyond ``left`` are zero."""
    loaded = np.lib.stride_tricks.sliding_window_view(padded, 8)[at].view(np.uint64)[:, 0]
    bits = np.uint64(8) * np.minimum(left, 8).astype(np.uint64)
    mask = np.where(bits == 64, np.uint64(2 ** 64 - 1), (np.uint64(1) << (bits % np.uint64(64))) - np.uint64(1))
    return loaded & mask


def _equal_spans(padded: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from ``a`` equal those from ``b``; long spans one by one."""
    same = np.ones(len(a), bool)
    long = size > 64
    for i in np.flatnonzero(long):
        same[i] = np.array_equal(padded[a[i]:a[i] + size[i]], padded[b[i]:b[i] + size[i]])
    left = np.flatnonzero(~long)
    for done in range(0, 64, 8):
        left = left[size[left] > done]
        if not left.size:
            break
        rest = size[left] - done
        hit = _eight_bytes(padded, a[left] + done, rest) == _eight_bytes(padded, b[left] + done, rest)
        same[left[~hit]] = False
        left = left[hit]
    return same


def distinct_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray,
                   hashes: np.ndarray | None = None) -> np.ndarray:
    """Positions of one span for every distinct pair of row and bytes.

    All spans are inserted at once: those that meet a free slot claim it, then every span compares
    itself with the holder of its slot, row, length and bytes alike, and goes on to the next slot if
    they differ. Equal spans probe the same slots, so they meet the same holder, whatever the hash.
    """
    if not len(start):
        return np.zeros(0, np.int64)
    if hashes is None:
        hashes = span_hashes(data, start, end, BYTES_AS_THEY_ARE)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    mask = (1 << (2 * len(start)).bit_length()) - 1
    table = np.full(mask + 1, -1, np.int64)
    slot = (mixed(hashes + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(mask)).astype(np.int64)
    size = end - start
    holder = np.empty(len(start), np.int64)
    waiting = np.arange(len(start))
    while waiting.size:
        at = slot[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        held = table[at]
        met = (row[held] == row[waiting]) & (size[held] == size[waiting]) & (hashes[held] == hashes[waiting])
        check = np.flatnonzero(met & (held != waiting))
        met[check] = _equal_spans(padded, start[held[check]], start[waiting[check]], size[waiting[check]])
        holder[waiting[met]] = held[met]
        waiting = waiting[~met]
        slot[waiting] = (slot[waiting] + 1) & mask
    return np.unique(holder)


def _cuts(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of a long text that end in front of white space."""
    at = 0
    while at < len(data):
        upto = at + SLICE
        while upto < len(data):
            white = np.flatnonzero(AFTER[data[upto:upto + SLICE]] == BETWEEN)
            if white.size:
                upto += int(white[0])
                break
            upto += SLICE
        upto = min(upto, len(data))
        yield at, upto
        at = upto


MEASURES = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")


def measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """``MEASURES`` of each text. A text longer than a slice is read in pieces, so what is held at
    once is a piece and the distinct words so far."""
    if len(offsets) == 2 and len(data) > SLICE:
        totals, seen = np.zeros(4, np.int64), set()
        for at, upto in _cuts(data):
            piece = data[at:upto]
            run = Run(piece, np.array([0, len(piece)]))
            totals += [run.words[0], run.capitals[0], run.points[0], run.symbols[0]]
            one = distinct_spans(piece, run.start, run.end, np.zeros(len(run.start), np.int64))
            raw = piece.tobytes()
            seen.update(raw[run.start[i]:run.end[i]] for i in one)
        return [np.array([n]) for n in (totals[0], len(seen), *totals[1:])]
    run = Run(data, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), run.words)
    distinct = np.bincount(row[distinct_spans(data, run.start, run.end, row)], minlength=len(offsets) - 1)
    return [run.words, distinct, run.capitals, run.points, run.symbols]


def text_measures(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """``doc_id``, ``part``, ``MEASURES`` and ``digest`` (SHA-256 of the text's bytes) of every row of ``docs``.

    A null text is empty, a null part an empty string; a null ``doc_id`` stays null; repeated rows
    give repeated rows; other columns are not read. No shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = text_bytes(piece.column("text"))
                raw = memoryview(data)
                digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("part"),
                     *[pa.array(counts, pa.int64()) for counts in measure(data, offsets)], pa.array(digests, pa.binary())],
                    ["doc_id", "part", *MEASURES, "digest"])

    plain = docs.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"),
                        quoted(text).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in MEASURES)
    return plain.mapInArrow(run, f"doc_id {kind}, part string, {counts}, digest binary")


def with_copies(measures: DataFrame) -> DataFrame:
    """``measures`` with ``copy``: whether a smaller ``doc_id`` has the same text. Rows that share a
    ``doc_id`` are no copies of each other; a null one is no copy and has none.

    Texts that occur once are folded away before the join; a text with very many copies is folded
    before the shuffle, and its rows are split by AQE in the join.
    """
    repeated = measures.where("doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("digest", "least")
    return measures.join(repeated, "digest", "left").select(
        *measures.columns, F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("copy"))


# Failure conditions over the columns of ``with_copies``.
FILTERS: dict[str, str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_points",
    "D": "n_symbols > 0",
    "E": "copy",
}


def chain_report(rows: DataFrame, filters: Mapping[str, str | Column]) -> DataFrame:
    """Effects of a filter chain in all orders; ``rows`` has ``part``, ``good``, ``toxic`` and what the filters read.

    ``filters`` maps one-letter names to failure conditions; a null condition counts as passed. One
    row per part, order and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost``, ``shapley``. Only counts by part and set of failed filters are
    unfolded (at most ``2 ** len(filters)`` a part), so the work on orders does not grow with the rows.
    """
    failed = F.concat(*[F.when(F.expr(rule) if isinstance(rule, str) else rule, letter).otherwise("")
                        for letter, rule in filters.items()])
    sets = rows.groupBy("part", failed.alias("failed")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("n_good"), F.count_if("toxic").alias("n_toxic"))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(filters)])
    steps = sets.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(filters))))).withColumns({
            "fails": F.expr("contains(failed, substring(filter_order, step, 1))"),
            "gone": F.expr("translate(failed, left(filter_order, step - 1), '') <> failed"),
            "only": F.expr("failed = substring(filter_order, step, 1)"),
            # a filter removes a document in those orders in which it comes first among the failed ones
            "orders_won": F.expr(f"{factorial(len(filters))} div greatest(length(failed), 1)"),
        })

    def total(count: str, condition: str) -> Column:
        return F.expr(f"sum(if({condition}, {count}, 0))")

    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", "not gone and not fails").alias("kept"),
        total("n", "not gone and fails").alias("removed"),
        total("n", "gone and fails").alias("redundant"),
        total("n", "only").alias("unique_fails"),
        total("n_good", "not gone and fails").alias("good_lost"),
        total("n_toxic", "not gone and fails").alias("toxic_lost"),
        total("n * orders_won", "fails").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, str | Column] = FILTERS) -> DataFrame:
    """``chain_report`` over whole texts of ``docs`` (``doc_id``, ``text``, ``lang``), with ``labels``
    (``doc_id``, ``quality``, ``toxic``).

    Rows of ``labels`` with one ``doc_id`` are folded: good or toxic if one of them is. A document
    without labels, or with null ones, is neither. An empty table gives no rows. Measures are stored
    once (some 70 bytes a document), texts are read once.
    """
    rows = with_copies(stored(text_measures(docs), "measures")).drop("digest")
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    return chain_report(rows.join(marks, "doc_id", "left"), filters)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part,
        CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN least < doc_id THEN 'E' ELSE '' END AS failed FROM m),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
s AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
p AS (SELECT filter_order, CAST(k AS INTEGER) AS step, substring(filter_order, k, 1) AS c,
             substring(filter_order, 1, k - 1) AS earlier FROM o, range(1, 6) r(k)),
u AS (SELECT *, contains(failed, c) AS fails, translate(failed, earlier, '') <> failed AS gone FROM s, p)
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
  CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
  CAST(coalesce(sum(n) FILTER (failed = c), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(n_good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
  CAST(coalesce(sum(n_toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * (120 // greatest(length(failed), 1))) FILTER (fails), 0) AS BIGINT) AS shapley
FROM u GROUP BY part, filter_order, step
"""
