import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from helpers import WORD, lowered
from tokenizers import Tokenizer

from cohortloom.llm import words as W
from cohortloom.llm.token_counts import LengthCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = list("ab1!' \n\t\r\x0b\x1c\x1f\x85\xa0é日s") + ["<|endoftext|>", "'ll", "  ", " ", "​", "　", "﻿",
                                                  "\x00", "Â", "ã"]


def test_words_and_runs_equal_a_regular_expression(monkeypatch):
    monkeypatch.setattr(W, "CHUNK", 16)
    rng = random.Random(2)
    texts = ["", "a", "a b", "A b c", " x\ty ", "ü Ü\x0b", None] + [
        "".join(rng.choice("abAB é\n\t ") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    found = W.find_words(*W.text_bytes(pa.array(texts)))
    runs, first = W.n_grams(found, 3, short_whole=True)
    names = {}
    for i, text in enumerate(texts):
        words = WORD.findall(lowered(text))
        hashes = found.hash[found.first[i]:found.first[i + 1]].tolist()
        grams = [tuple(words[j:j + 3]) for j in range(len(words) - 2)] or ([tuple(words)] if words else [])
        own = runs[first[i]:first[i + 1]].tolist()
        assert len(words) == len(hashes) and len(grams) == len(own)
        assert all(names.setdefault(a, b) == b for a, b in [*zip(words, hashes), *zip(grams, own)])
    assert len(set(names.values())) == len(names)


def test_lengths_equal_whole_texts():
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    counter = LengthCounter(PATH)
    whole = [len(e.ids) for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from memory
        assert counter.count(*W.text_bytes(pa.array(texts))).tolist() == whole


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr("cohortloom.llm.token_counts.KEPT_PIECES", 3)
    counter = LengthCounter(PATH)
    lengths = [counter.count(*W.text_bytes(pa.array([t]))).tolist() for t in ("a b c d", "e f", "a b")]
    assert lengths == [[4], [2], [2]] and len(counter.keys) <= 6


def test_table_with_nulls_repeats_and_other_columns(spark):
    rows = [(1, "a b", 7), (None, None, 7), (2, "", 7), (2, "word " * 600, 7), (1, "a b", 7)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, n_tokens int")
    got = sorted((tuple(r) for r in token_counts(docs, PATH).collect()), key=str)
    long = len(Tokenizer.from_file(PATH).encode("word " * 600, add_special_tokens=False).ids)
    assert got == sorted([(1, 3, 2, False)] * 2 + [(None, 0, 0, False), (2, 0, 0, False), (2, 3000, long, True)], key=str)
    assert token_counts(docs.limit(0), PATH).collect() == []
    assert np.array([r.n_tokens > 512 for r in token_counts(docs, PATH).collect()]).sum() == 1
