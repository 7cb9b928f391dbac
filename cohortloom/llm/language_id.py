"""Language of whole texts by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes (A-Z lowered). A byte that its
longest context has seen costs ``-log2(count / (total + distinct))`` bits; one that it has not costs
the escape, ``-log2(distinct / (total + distinct))``, and then what the next shorter context says,
down to equal odds for all bytes. Statistics are frozen after training, so the code length of a
byte depends on its context alone: the trees of all languages become one table, and a text's exact
code length is a sum of table entries. The shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted, stored
from cohortloom.llm.words import parts, text_bytes

ORDER = 3
TRAIN_BYTES = 1 << 20  # bytes of text per language that are learned from, about
LANGUAGES_AT_ONCE = 8  # whose tables a worker holds at once
UNKNOWN = "und"

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A"):ord("Z") + 1] += 32


def _contexts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The bytes one, two and three places before each byte; spaces in front of a text."""
    out, first = [], offsets[:-1]
    for k in range(1, ORDER + 1):
        before = np.full(len(data), 32, np.uint8)
        before[k:] = data[:-k] if len(data) > k else data[:0]
        for j in range(k):
            at = first + j
            before[at[at < offsets[1:]]] = 32
        out.append(before)
    return out


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of context and byte as whole numbers, and how often each occurs."""
    data = _LOWERED[data]
    code = data.astype(np.int64)
    for k, before in enumerate(_contexts(data, offsets), 1):
        code |= before.astype(np.int64) << (8 * k)
    return np.unique(code, return_counts=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            texts = batch.column("text").filter(pa.array(langs.indices.to_numpy() == k))
            for at, upto in parts(texts):
                codes, counts = gram_counts(*text_bytes(texts.slice(at, upto - at)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                    ["lang", "gram", "n"])


class ContextTrees:
    """Code lengths under frozen counts: ``grams[lang] = (codes, counts)`` of the longest runs."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(grams)
        seen = np.unique(np.concatenate([np.zeros(0, np.int64), *[g[0] & 255 for g in grams.values()], [32]]))
        self.rank = np.full(256, len(seen), np.int64)  # bytes never learned share the last rank
        self.rank[seen] = np.arange(len(seen))
        self.width = width = len(seen) + 1
        nodes = [np.zeros(1, np.int64)]  # contexts of each length, as numbers in base ``width``
        split = {}
        for lang, (codes, counts) in grams.items():
            ranks = [self.rank[(codes >> (8 * k)) & 255] for k in range(ORDER + 1)]
            split[lang] = (ranks, counts)
        for length in range(1, ORDER + 1):
            nodes.append(np.unique(np.concatenate([self._context(ranks, length) for ranks, _ in split.values()])))
        first = np.concatenate([[0], np.cumsum([len(n) for n in nodes])])
        bits = np.zeros((first[-1], width, len(grams)), np.float32)
        for k, lang in enumerate(self.languages):
            ranks, counts = split[lang]
            for length in range(ORDER + 1):
                shorter = np.full((1, width), np.log2(256.0)) if length == 0 else bits[
                    first[length - 1] + np.searchsorted(nodes[length - 1], nodes[length] % width ** (length - 1)), :, k]
                key = self._context(ranks, length) * width + ranks[0]
                pair, at = np.unique(key, return_inverse=True)
                n = np.bincount(at, counts)
                node = np.searchsorted(nodes[length], pair // width)
                total = np.bincount(node, n, minlength=len(nodes[length]))
                distinct = np.bincount(node, minlength=len(nodes[length]))
                known = total > 0
                own = shorter.astype(np.float64)
                own = np.repeat(own, len(nodes[length]), axis=0) if length == 0 else own
                own[known] -= np.log2(distinct[known] / (total[known] + distinct[known]))[:, None]
                own[node, pair % width] = -np.log2(n / (total + distinct)[node])
                bits[first[length]:first[length + 1], :, k] = own
        self.bits = bits.reshape(-1, len(grams))
        self.node = np.zeros((width,) * ORDER, np.int32)  # longest context known for each three bytes
        for length in range(1, ORDER + 1):
            digits = [nodes[length] // width ** j % width for j in range(length)]  # nearest byte first
            where = [slice(None)] * (ORDER - length) + digits[::-1]
            ids = np.arange(first[length], first[length + 1])
            self.node[tuple(where)] = ids
        self.node = self.node.ravel()

    def _context(self, ranks: list[np.ndarray], length: int) -> np.ndarray:
        out = np.zeros(len(ranks[0]), np.int64)
        for k in range(length, 0, -1):
            out = out * self.width + ranks[k]
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text (rows) under each language (columns)."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        filled = np.diff(offsets) > 0
        if not filled.any():
            return out
        data = _LOWERED[data]
        rank = self.rank.astype(np.int32)
        context = np.zeros(len(data), np.int32)
        for before in _contexts(data, offsets)[::-1]:
            context = context * self.width + rank[before]
        at = self.node[context].astype(np.int64) * self.width + rank[data]
        out[filled] = np.add.reduceat(self.bits[at], offsets[:-1][filled], axis=0, dtype=np.float64)
        return out


_TREES: dict[int, list[ContextTrees]] = {}


class Model:
    """The counts of all languages; trees are built once per worker."""

    def __init__(self, grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.grams = grams
        self.key = hash(tuple((lang, codes.tobytes(), counts.tobytes()) for lang, (codes, counts) in sorted(grams.items())))

    def trees(self) -> list[ContextTrees]:
        if self.key not in _TREES:
            _TREES.clear()
            names = sorted(self.grams)
            _TREES[self.key] = [ContextTrees({n: self.grams[n] for n in names[i:i + LANGUAGES_AT_ONCE]})
                                for i in range(0, len(names), LANGUAGES_AT_ONCE)]
        return _TREES[self.key]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Best language and its posterior odds among all, from code lengths."""
        trees = self.trees()
        names = [n for tree in trees for n in tree.languages]
        bits = np.concatenate([tree.code_lengths(data, offsets) for tree in trees], axis=1)
        best = bits.argmin(axis=1)
        gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
        return [names[k] for k in best], 1.0 / np.exp2(-gap).sum(axis=1)


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> Model:
    """Counts from a sample of labelled rows (``doc_id``, ``text``, ``lang``) of about ``train_bytes``
    bytes per language, chosen by a hash of ``doc_id``; all rows of a smaller language. The row with the
    smallest hash is always taken, so no language is left out, and a sampled row gives ``train_bytes``
    characters at most, so a few long rows do not exceed the bound."""
    labelled = docs.where("lang is not null and text is not null").withColumn(
        "luck", F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1 << 30)))
    sizes = stored(labelled.groupBy("lang").agg(
        F.sum(F.octet_length("text")).alias("size"), F.min("luck").alias("first")), "languages")
    share = F.least(F.lit(1.0), F.lit(float(train_bytes)) / F.col("size"))
    taken = (F.col("luck") / F.lit(float(1 << 30)) < share) | (F.col("luck") == F.col("first"))
    sample = labelled.join(sizes, "lang").where(taken).select("lang", F.left("text", F.lit(train_bytes)).alias("text"))
    counts = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).toArrow()  # bounded: as many rows as sampled bytes at most
    langs = np.array(counts["lang"].to_pylist(), dtype=object)
    codes, n = counts["gram"].to_numpy(), counts["n"].to_numpy()
    grams = {}
    for lang in sorted(set(langs)):
        own = langs == lang
        order = np.argsort(codes[own])
        grams[lang] = (codes[own][order], n[own][order])
    return Model(grams)


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in parts(batch.column("text")):
                part = batch.slice(at, upto - at)
                lettered = part.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                if model.grams:
                    names, score = model.predict(*text_bytes(part.column("text")))
                else:
                    names, score = [UNKNOWN] * len(lettered), np.zeros(len(lettered))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"),
                    pa.array([n if has else UNKNOWN for n, has in zip(names, lettered)], pa.string()),
                    pa.array(np.where(lettered, score, 0.0)),
                ], ["doc_id", "held_out", "lang_pred", "score"])
    return run


def languages(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
              train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Learns only from rows with a language whose ``crc32(doc_id)`` is not a multiple of five; a row
    without ``doc_id`` is held out. A prediction sees the text alone. Null texts, texts without a
    letter, and all texts if nothing was learned are ``und`` with score 0; of languages that tie the
    first by name wins. Repeated rows get equal results; other columns are not read; an empty table
    gives an empty result.
    """
    held_out = F.coalesce(F.crc32(quoted(doc_id).cast("string")) % 5 == 0, F.lit(True))
    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"),
                        quoted(lang).cast("string").alias("lang"), held_out.alias("held_out"))
    model = train(plain.where("not held_out"), train_bytes)
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.select("doc_id", "held_out", "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
                        ).mapInArrow(_predict(model), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
