"""Quality rules whose thresholds follow each language and source.

Every document gets a few whole-number ratios. Their distributions are kept as histogram sketches
(value buckets of 1/32 relative width with counts): sketches of parts of the data merge by adding
counts, in any order, with the same result. Documents that fail the base rule are left out.

The fence of a language and source lies above its median, by ``TAIL`` times the way from there to its
0.9 quantile. Junk may make up a third of a group, and with it the whole tail: so that way is bounded by
``REACH`` times the way from the median to the 0.65 quantile or to the lower quartile, whichever is
larger; a third of junk reaches neither. A group with few documents takes the merged sketch of its
language, then that of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cohortloom.llm.stored import quoted, stored
from cohortloom.llm.words import BYTES_AS_THEY_ARE, U, find_words, mixed, n_grams, parts, span_hashes, text_bytes

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")
# Ratio of a document, and how far above the median its fence lies at least (fixed values). The base
# rule rejects repeats above 500, and with them nearly all texts in which every second line is a copy.
RATIOS = {
    "symbols": ("1000 * n_symbols div n_words", 100),
    "dup_lines": ("1000 * n_dup_lines div n_lines", 400),
    "repeats": ("1000 * n_repeat_words div n_words", 400),
    "upper": ("1000 * n_upper div word_chars", 60),
    "word_length": ("100 * word_chars div n_words", 150),
}
TAIL = 3
REACH = 6
QUANTILES = {"q25": (1, 4), "q50": (1, 2), "q65": (13, 20), "q90": (9, 10)}
LEAST_DOCS = 100  # a group with fewer takes the merged sketch above it
LEAST_WORDS = 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_LEADS = np.array([b & 0xC0 != 0x80 for b in range(256)])


def _per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of marked bytes of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[offsets])


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs again anywhere, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    as_before = np.concatenate([[False], ordered[1:] == ordered[:-1]]) if len(keys) else np.zeros(0, bool)
    twice, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    before[order] = as_before
    twice[order] = as_before | np.append(as_before[1:], False)[:len(keys)]
    return twice, before


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text; null is empty."""
    data, offsets = text_bytes(column)
    rows = len(offsets) - 1
    if not len(data):
        return {name: np.zeros(rows, np.int64) for name in COUNTS}
    words = find_words(data, offsets, BYTES_AS_THEY_ARE)
    row_of = words.row_of()
    in_word = np.zeros(len(data) + 1, dtype=np.int8)
    in_word[words.start] += 1
    np.add.at(in_word, words.end, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)

    cut = data == 0x0A
    line_start = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(cut) + 1)
    line_start = line_start[line_start < len(data)]
    filled = np.unique(np.searchsorted(line_start, words.start, side="right") - 1)
    ends = np.append(line_start[1:], len(data))
    ends = np.where(cut[ends - 1], ends - 1, ends)
    start, end = line_start[filled], ends[filled]
    line_row = np.searchsorted(offsets, start, side="right") - 1
    _, seen = _repeated(mixed(span_hashes(data, start, end, BYTES_AS_THEY_ARE)) + mixed(line_row.astype(np.uint64) + U(1)))

    windows, first = n_grams(words, 3)
    window_row = np.repeat(np.arange(rows), np.diff(first))
    twice, _ = _repeated(windows + mixed(window_row.astype(np.uint64) + U(1)))
    at = (np.arange(len(windows)) - first[window_row] + words.first[window_row])[twice]
    covered = np.zeros(len(words.start), dtype=bool)
    for k in range(3):
        covered[at + k] = True
    tally = lambda where: np.bincount(where, minlength=rows).astype(np.int64)
    return {
        "n_words": np.diff(words.first).astype(np.int64),
        "word_chars": _per_row(_LEADS[data] & in_word, offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_dup_lines": tally(line_row[seen]),
        "n_repeat_words": tally(row_of[covered]),
        "n_lines": tally(line_row),
        "n_upper": _per_row(_UPPER[data], offsets),
    }


def _measured(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("doc")
            texts = docs.field(docs.type.get_field_index(text))
            for at, upto in parts(texts):
                counts = measure(texts.slice(at, upto - at))
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(at, upto - at), *[pa.array(counts[c], pa.int64()) for c in COUNTS]], ["doc", *COUNTS])
    return run


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """Each row of ``docs`` as a struct ``doc``, with its counts and ratios."""
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("doc"))
    schema = T.StructType([T.StructField("doc", packed.schema["doc"].dataType),
                           *[T.StructField(c, T.LongType()) for c in COUNTS]])
    counted = packed.mapInArrow(_measured(text), schema)
    return counted.withColumns({
        name: F.when(F.expr(sql.split(" div ")[1]) > 0, F.expr(sql)).otherwise(F.lit(0)).cast("long")
        for name, (sql, _) in RATIOS.items()
    }).withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > 50 * n_words"))


def bucket(value: Column) -> Column:
    """Lower bound of a value's bucket: its six leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(counted: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``ratio``, ``bucket``, ``docs``: one mergeable sketch per group and ratio, of
    the documents that pass the base rule."""
    pairs = ", ".join(f"'{name}', {name}" for name in RATIOS)
    return counted.where("not base_failed").selectExpr("lang", "source", f"stack({len(RATIOS)}, {pairs}) as (ratio, value)").groupBy(
        "lang", "source", "ratio", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("docs"))


def _quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """``docs`` by ``keys``, and a struct of ``QUANTILES`` per ratio, from the merged sketch."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("docs").alias("docs"))
    group = Window.partitionBy(*keys, "ratio")
    running = merged.withColumns({"upto": F.sum("docs").over(group.orderBy("bucket")),
                                  "total": F.sum("docs").over(group)})
    return running.groupBy(*keys, "ratio").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(n * F.col("upto") >= k * F.col("total"), F.col("bucket"))).alias(q) for q, (k, n) in QUANTILES.items()]
    ).groupBy(*keys).agg(
        F.max("total").alias("docs"),
        *[F.max(F.when(F.col("ratio") == name, F.struct(*QUANTILES))).alias(name) for name in RATIOS])


def thresholds(sketch: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Fences (``f_<ratio>``) of every ``lang`` and ``source``; small groups take those of what they are part of."""
    own = _quantiles(sketch, "lang", "source")
    of_lang = _quantiles(sketch, "lang").select(
        F.col("lang").alias("l_lang"), F.col("docs").alias("l_docs"), *[F.col(n).alias(f"l_{n}") for n in RATIOS])
    of_all = _quantiles(sketch.withColumn("one", F.lit(1)), "one").select(
        F.col("one").alias("a_one"), *[F.col(n).alias(f"a_{n}") for n in RATIOS])

    def fence(name: str, least: int) -> Column:
        held = F.when(F.col("docs") >= least_docs, F.col(name)).when(
            F.col("l_docs") >= least_docs, F.col(f"l_{name}")).otherwise(F.col(f"a_{name}"))
        bound = REACH * F.greatest(held["q65"] - held["q50"], held["q50"] - held["q25"])
        return held["q50"] + F.greatest(F.lit(least), F.least(TAIL * (held["q90"] - held["q50"]), bound))

    return own.join(of_lang, F.col("lang").eqNullSafe(F.col("l_lang")), "left").withColumn("one", F.lit(1)).join(
        of_all, F.col("one") == F.col("a_one"), "left").select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"),
        *[fence(name, least).alias(f"f_{name}") for name, (_, least) in RATIOS.items()])


def judged(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
           least_docs: int = LEAST_DOCS) -> DataFrame:
    """Every row of ``docs`` as a struct ``doc``, with ``COUNTS``, ``base_failed`` and ``kept``.

    A null text counts as empty: no words, so it fails the base rule. Null languages and sources
    are groups of their own. Repeated rows are judged alike and count as often as they occur. Extra
    columns ride along in ``doc``, so their names clash with nothing. An empty table gives an empty
    result. Counts are computed twice, for the sketches and for the verdicts: that is cheaper than
    shuffling or storing all texts.
    """
    groups = lambda df: df.withColumns({
        "lang": F.col("doc")[lang].cast("string"), "source": F.col("doc")[source].cast("string")})
    narrow = docs.select(*[quoted(c) for c in dict.fromkeys([lang, source, text])])
    sketch = stored(sketches(groups(with_counts(narrow, text))), "quality-sketches")
    fences = stored(thresholds(sketch, least_docs), "quality-fences")
    within = " and ".join(f"{name} <= f_{name}" for name in RATIOS)
    return groups(with_counts(docs, text)).join(
        fences, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left"
    ).withColumn("kept", F.expr(f"not base_failed and coalesce({within}, true)"))


def quality_rules(docs: DataFrame, *, doc_id: str = "doc_id", **columns) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row; see ``judged``."""
    names = [doc_id, *(columns.get(k, k) for k in ("text", "lang", "source"))]
    narrow = docs.select(*[quoted(c) for c in dict.fromkeys(names)])
    return judged(narrow, **columns).select(
        F.col("doc")[doc_id].alias("doc_id"), *COUNTS[:5], "base_failed", "kept")


def good_documents(docs: DataFrame, **columns) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with the same columns."""
    return judged(docs, **columns).where("kept").select(
        *[F.col("doc")[name].alias(name) for name in docs.columns])
