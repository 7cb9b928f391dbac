"""Repeated passages across documents, by sliding runs of sentences.

A sentence ends at ``.``, ``!`` or ``?`` before white space, at a line feed, or after ``LONGEST``
words. From every sentence a run slides: that sentence and those after it, until there are at least
two sentences and ``least_words`` words. Runs are hashed (words only, A-Z lowered), the hashes are
joined over all documents, and a sentence is removed if a run that covers it occurred before.

With ``passages``, windows of ``WINDOW`` words (longer than any sentence) are hashed as well, at places
that depend only on the words around them: the lowest ``GRAM``-gram of every ``SPAN`` words says which of
the span's ``STEP`` windows is taken. So a passage of at least ``SPAN`` words that occurred before loses
all but fewer than ``STEP`` words at each end, wherever its sentences start, end or are cut. Windows
remove words, so a sentence may lose a part only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.stored import quoted, stored
from cohortloom.llm.words import _STEPS, U, Words, find_words, mixed, parts, text_bytes

LONGEST = 24  # words; a longer sentence counts as several
WINDOW = LONGEST + 1  # words, so that a window touches two sentences at least
STEP = 8
SPAN = WINDOW + STEP - 1
GRAM = 9  # equal to WINDOW modulo STEP, so that few windows are taken (mod-minimizers)
WORDS = 1 << 30  # from here on a place is a word, below it a sentence; more words fit in no Arrow string
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """The words; the first word of each sentence (each up to the next or the text's end), their content
    hashes and numbers of words, and the first sentence of each text."""
    words = find_words(data, offsets)
    n = len(words.start)
    if not n:
        empty = np.zeros(0, np.int64)
        return words, empty, np.zeros(0, np.uint64), empty, np.zeros(len(offsets), np.int64)
    last = data[words.end - 1]
    breaks = np.concatenate([[0], np.cumsum(data == 0x0A, dtype=np.int64)])
    opens = np.ones(n, bool)
    opens[1:] = _ENDS[last[:-1]] | (breaks[words.start[1:]] > breaks[words.end[:-1]])
    opens[words.first[:-1][np.diff(words.first) > 0]] = True
    begin = np.flatnonzero(opens)
    inside = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    begin = np.flatnonzero(inside % LONGEST == 0)
    size = np.diff(np.append(begin, n))
    place = (np.arange(n) - np.repeat(begin, size)).astype(np.uint64)
    hashes = mixed(np.add.reduceat(mixed(words.hash + place * U(0x9E3779B97F4A7C15)), begin))
    return words, begin, hashes, size, np.searchsorted(begin, words.first)


def window_starts(words: Words) -> np.ndarray:
    """First words of the windows that are hashed."""
    n = len(words.hash)
    if n < SPAN:
        return np.zeros(0, np.int64)
    grams = mixed(sum(words.hash[j:n - GRAM + 1 + j] * _STEPS[j] for j in range(GRAM)))
    lowest = np.lib.stride_tricks.sliding_window_view(grams, SPAN - GRAM + 1).argmin(axis=1)
    at = np.arange(n - SPAN + 1)
    inside = at + SPAN <= np.repeat(words.first[1:], np.diff(words.first))[at]
    return np.unique((at + lowest % STEP)[inside])


def window_hashes(words: Words, start: np.ndarray) -> np.ndarray:
    return mixed(sum((words.hash[start + j] * _STEPS[j] for j in range(WINDOW)), np.zeros(len(start), np.uint64)))


def run_ends(size: np.ndarray, first: np.ndarray, least_words: int) -> np.ndarray:
    """For each sentence the end (exclusive) of the run that starts there, or 0 if the text ends before
    the run is long enough. All sentences of a text that is shorter than that are one run."""
    sums = np.concatenate([[0], np.cumsum(size)])
    counts = np.diff(first)
    start = np.arange(len(size))
    text_end = np.repeat(first[1:], counts)
    end = np.maximum(np.searchsorted(sums, sums[start] + least_words), start + 2)
    whole = (start == np.repeat(first[:-1], counts)) & (end > text_end)
    return np.where(end <= text_end, end, np.where(whole, text_end, 0))


def run_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the sentences ``start .. end`` of each run, from running sums of place-weighted hashes."""
    powers = np.full(len(hashes) + 1, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    inverse = np.full(len(hashes) + 1, pow(0x9E3779B97F4A7C15 | 1, -1, 2 ** 64), dtype=np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    return mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def _runs(least_words: int, passages: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in parts(batch.column("text")):
                words, _, hashes, size, first = sentences(*text_bytes(batch.column("text").slice(at, upto - at)))
                end = run_ends(size, first, least_words)
                start = np.flatnonzero(end)
                rows = np.searchsorted(first, start, side="right") - 1
                place, value = start - first[rows], run_hashes(hashes, start, end[start])
                if passages:
                    windows = window_starts(words)
                    own = np.searchsorted(words.first, windows, side="right") - 1
                    rows, place = np.append(rows, own), np.append(place, WORDS + windows - words.first[own])
                    value = np.append(value, window_hashes(words, windows))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(at + rows)), pa.array(place, pa.int32()),
                    pa.array(value.view(np.int64))], ["doc_id", "at", "run"])
    return work


def _cut(least_words: int, fields: list[str], text: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, covered = batch.column("doc"), batch.column("covered")
            texts = docs.field(fields.index(text))
            for at, upto in parts(texts):
                data, offsets = text_bytes(texts.slice(at, upto - at))
                words, begin, _, size, first = sentences(data, offsets)
                run_end, begin = run_ends(size, first, least_words), np.append(begin, len(words.start))
                raw, new, removed, lost = data.tobytes(), [], [], []
                for i in range(upto - at):
                    low, high, zero, n = int(first[i]), int(first[i + 1]), int(words.first[i]), int(words.first[i + 1] - words.first[i])
                    if not covered[at + i].is_valid or not n:
                        new.append(texts[at + i].as_py())
                        removed.append(0)
                        lost.append(0)
                        continue
                    places = covered[at + i].values.to_numpy().astype(np.int64)
                    runs, windows = low + places[places < WORDS], places[places >= WORDS] - WORDS
                    runs = runs[runs < high]
                    runs, windows = runs[run_end[runs] > 0], windows[windows < n]
                    steps = np.zeros(n + 1, np.int64)
                    np.add.at(steps, np.append(begin[runs] - zero, windows), 1)
                    np.add.at(steps, np.append(begin[run_end[runs]] - zero, np.minimum(windows + WINDOW, n)), -1)
                    gone = np.cumsum(steps[:-1]) > 0
                    # A word takes along what follows it up to the next one; the first one also what precedes it.
                    edges = np.append(words.start[zero:zero + n], offsets[i + 1])
                    edges[0] = offsets[i]
                    turns = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]])))
                    kept = edges[turns].reshape(-1, 2)
                    new.append(b"".join(raw[a:b] for a, b in kept.tolist()).decode() if gone.any() else texts[at + i].as_py())
                    removed.append(int(np.logical_and.reduceat(gone, begin[low:high] - zero).sum()))
                    lost.append(int(gone.sum()))
                flat = docs.slice(at, upto - at).flatten()
                flat[fields.index(text)] = pa.array(new, texts.type)
                yield pa.RecordBatch.from_arrays([
                    pa.StructArray.from_arrays(flat, fields=list(docs.type)), pa.array(np.diff(first), pa.int64()),
                    pa.array(removed, pa.int64()), pa.array(lost, pa.int64()),
                ], ["doc", "n_sentences", "n_removed", "words_removed"])
    return work


def repeated_runs(docs: DataFrame, least_words: int, passages: bool = False) -> DataFrame:
    """``doc_id`` and the sorted places ``covered`` at which a run or window starts that occurred before.

    A window that overlaps its first occurrence in the same text does not count. Copies of a run are folded to their first place before the shuffle; only runs that occur at
    least twice are joined back.
    """
    found = docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(
        _runs(least_words, passages), "doc_id long, at int, run long")
    place = F.struct("doc_id", "at")
    known = stored(found.groupBy("run").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                   .where("first < last").select("run", F.col("first.doc_id").alias("d"), F.col("first.at").alias("a")),
                   "runs")
    later = found.join(known, "run").where(f"doc_id != d or at >= a + if(at >= {WORDS}, {WINDOW}, 1)")
    return stored(later.groupBy("doc_id").agg(F.sort_array(F.collect_set("at")).alias("covered")), "covered")


def without_repeats(docs: DataFrame, *, least_words: int = 20, passages: bool = False, text: str = "text",
                    doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs`` as a struct ``doc`` with its text cut, and ``n_sentences``, ``n_removed``,
    ``words_removed``. ``n_removed`` counts sentences that are gone as a whole.

    The first occurrence, by ``doc_id`` and place, keeps its sentences. ``passages`` also removes what was
    repeated from the middle of a sentence on, or up to it. A text that is
    too short for a run is one run as a whole. Null and empty texts stay as they are. Rows without ``doc_id`` have no place in the order and stay whole.
    Rows that repeat a ``doc_id`` share its places: what one of them loses, all lose. Extra columns
    ride along in ``doc``. An empty table gives an empty result. ``doc_id`` is compared as a long.
    """
    plain = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    covered = repeated_runs(plain, least_words, passages)
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("doc"))
    schema = T.StructType([T.StructField("doc", packed.schema["doc"].dataType), *[
        T.StructField(n, T.LongType()) for n in ("n_sentences", "n_removed", "words_removed")]])
    return packed.join(covered, F.col("doc")[doc_id].cast("long") == F.col("doc_id"), "left").select(
        "doc", "covered").mapInArrow(_cut(least_words, docs.columns, text), schema)
