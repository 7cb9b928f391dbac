"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts are cut at safe boundaries: in front of a run of white space that follows another character.
The tokenizer's own pre-split always starts a new token there, and special strings hold no white
space, so the pieces' token counts add up to those of the whole text (tested against it). A piece
that recurs is encoded once per worker; batches for the encoder are balanced by bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.stored import quoted
from cohortloom.llm.words import BYTES_AS_THEY_ARE, SPACE, slices, span_hashes, text_bytes

BATCH_BYTES = 1 << 15
KEPT_PIECES = 1 << 22  # lengths that a worker remembers (16 bytes each); then it starts anew


def _wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before byte ``at`` may be white space of more than one byte
    (or an ASCII separator); there no cut is made, which is always exact."""
    last = data[at - 1]
    second, third = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    return ((last >= 0x1C) & (last <= 0x1F) | (second == 0xC2)
            | (third >= 0xE1) & (third <= 0xE3) & (second >= 0x80) & (second <= 0x9A))


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sorted byte positions at which pieces start; every text that is not empty starts one."""
    white = SPACE[data]
    at = np.flatnonzero(white[1:] & ~white[:-1]) + 1
    at = at[~_wide_space(data, at)]
    starts = offsets[:-1][np.diff(offsets) > 0]
    return np.union1d(at, starts)


class LengthCounter:
    """Token lengths by one tokenizer file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.lengths = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _encode(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece. A batch is one pre-split input, whose tokens name their piece."""
        lengths, at = [np.zeros(0, np.int64)], 0
        while at < len(pieces):
            size, upto = 0, at
            while upto < len(pieces) and (upto == at or size < BATCH_BYTES):
                size += len(pieces[upto])
                upto += 1
            encoded = self.tokenizer.encode(pieces[at:upto], is_pretokenized=True, add_special_tokens=False)
            lengths.append(np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=upto - at))
            at = upto
        return np.concatenate(lengths)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text, given the bytes of all and their offsets."""
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        start = piece_starts(data, offsets)
        end = np.append(start[1:], len(data))
        hashes = span_hashes(data, start, end, BYTES_AS_THEY_ARE)
        distinct, example, of = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, distinct)
        found = at < len(self.keys)
        found[found] = self.keys[at[found]] == distinct[found]
        lengths = np.zeros(len(distinct), np.int64)
        lengths[found] = self.lengths[at[found]]
        new = np.flatnonzero(~found)
        if len(new):
            raw = data.tobytes()
            lengths[new] = self._encode([raw[start[i]:end[i]].decode("utf-8", "replace") for i in example[new]])
            if len(self.keys) + len(new) > KEPT_PIECES:
                self._forget()
            keys = np.concatenate([self.keys, distinct[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.lengths = keys[order], np.concatenate([self.lengths, lengths[new]])[order]
        sums = np.concatenate([[0], np.cumsum(lengths[of])])
        first = np.searchsorted(start, offsets)
        return np.diff(sums[first])


_COUNTERS: dict[str, LengthCounter] = {}


def token_counts(docs: DataFrame, path: str, *, text: str = "text", doc_id: str = "doc_id",
                 limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Null and empty texts have 0 bytes and tokens; a null ``doc_id`` stays null; repeated rows give
    repeated rows; other columns are not read. An empty table gives an empty result. No shuffle:
    a task holds one slice of its Arrow batch and the lengths of at most ``KEPT_PIECES`` pieces.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(path) or _COUNTERS.setdefault(path, LengthCounter(path))
        for batch in batches:
            for part in slices(batch, "text"):
                n_tokens = counter.count(*text_bytes(part.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n_tokens), pa.array(n_tokens > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    plain = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"),
                        F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long").alias("n_bytes"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
