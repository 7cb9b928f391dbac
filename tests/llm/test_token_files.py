"""Token files: ids equal to the library's, layout, random access, damage."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from conftest import SMALL
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from cohortloom.llm import token_files as tf
from cohortloom.sources.workspace import new_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id bigint, text string, Mark string"


def plain(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_text(rng):
    parts = ["word", "Word.", "don't", "I'LL", "é", "́", "İ.", "Σ,", "x.", "x..", "9;", "<|endoftext|>", "<|ENDOFTEXT|>",
             "<|", "|>", "é!", "é", "ß9.", "ÿ÷", "×a", "ña´", "ª", "a̧b", "≠", "l'été", "''s", "~`^", "12.5%", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "日本", "😀", "#$", "A1b2", "...", "ﬁ"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(30)))


def test_pieces_equal_the_library():
    rng = random.Random(9)
    pieces = tf.Pieces(PATH)
    for _ in range(4000):
        text = odd_text(rng)
        ids = np.frombuffer(pieces.encode(text.encode()) + pieces.packed([2]), "<u2")
        assert ids.tolist() == plain(text), repr(text)


def test_a_full_memory_of_pieces_starts_anew(monkeypatch):
    monkeypatch.setattr(tf, "KEPT_PIECES", 5)
    pieces = tf.Pieces(PATH)
    for text in ("a b c d", "e f a b", "one two three four five six seven", "a one"):
        assert np.frombuffer(pieces.encode(text.encode()), "<u2").tolist() == plain(text)[:-1]


def test_round_trip_and_order(spark):
    rng = random.Random(10)
    docs = [(rng.randrange(-50, 400), odd_text(rng), "m") for _ in range(300)]
    docs += [(None, "null id", "m"), (7, None, "m"), (8, "", "m"), (9, "long " * 50_000, "m")] + docs[:20]
    rng.shuffle(docs)
    folder = new_folder(spark, "tokens")
    tf.write_token_files(spark.createDataFrame(docs, SCHEMA).repartition(5), folder, PATH, file_bytes=2000)
    index = tf.read_index(spark, folder, checked=True).cache()
    assert index.select("file").distinct().count() > 3
    rows = tf.with_starts(index).orderBy("start").collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(
        (str(i), len(plain(t)), crc(plain(t))) for i, t, _ in docs)
    at, last = 0, None
    for row in rows:  # nulls first, then ascending, without gaps
        assert row["start"] == at
        assert last is None or row["doc_id"] is not None and row["doc_id"] >= last
        at, last = at + row["n_tokens"], row["doc_id"]


def test_only_wanted_frames_are_decompressed(spark):
    docs = [(i, f"text number {i}", "m") for i in range(100)] + [(5, "a second row of five", "m")]
    folder = new_folder(spark, "tokens")
    tf.write_token_files(spark.createDataFrame(docs, SCHEMA), folder, PATH, file_bytes=300)
    wanted = spark.createDataFrame([(5,), (5,), (63,), (1000,), (None,)], "doc_id bigint")
    found = sorted((r["doc_id"], r["ids"]) for r in tf.read_documents(spark, folder, wanted).collect())
    assert found == sorted((i, plain(t)) for i, t, _ in docs if i in (5, 63))


def built(texts):
    pieces = tf.Pieces(PATH)
    builder = tf.FileBuilder(pieces.width, 3)
    for i, text in enumerate(texts):
        builder.add(i, pieces.encode(text.encode()) + pieces.packed([2]))
    return builder.finish() + tf.LINE_END


def test_layout():
    texts = ["first text", "", "the third one"]
    content = built(texts)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u2").tolist() == [i for t in texts for i in plain(t)]
    found = tf.TokenFile(content)
    assert (found.partition, found.number, found.doc_ids.to_pylist()) == (3, 0, [0, 1, 2])
    for at, text in enumerate(texts):
        lone = content[found.offsets[at + 1]:found.offsets[at + 2]]
        assert np.frombuffer(zstandard.ZstdDecompressor().decompress(lone), "<u2").tolist() == plain(text)
        assert found.tokens(at).tolist() == plain(text)


def test_damage_is_found_where_it_is():
    content = built(["first text", "second text", "third text"])
    good = tf.TokenFile(content)
    at = int(good.offsets[3]) - 2  # in the checksum of the second text's frame
    broken = tf.TokenFile(content[:at] + bytes([content[at] ^ 1]) + content[at + 1:])
    assert broken.tokens(0).tolist() == plain("first text") and broken.tokens(2).tolist() == plain("third text")
    with pytest.raises(tf.DamagedFile):
        broken.tokens(1)
    for cut in (content[:-1], content[:40], content[10:], b""):
        with pytest.raises(tf.DamagedFile):
            tf.TokenFile(cut)


def test_empty_table(spark):
    done = tf.token_files(spark.createDataFrame([], SCHEMA), new_folder(spark, "tokens"), PATH)
    assert done.count() == 0 and done.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_query_equals_the_library(spark):
    rows = {r["doc_id"]: r for r in entry_point.queries()["op13_token_files"](spark, SMALL).collect()}
    at = 0
    for doc in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect():
        ids = plain(doc["text"])
        row = rows.pop(doc["doc_id"])
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    assert not rows
