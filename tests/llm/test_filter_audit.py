"""The byte transducer and its hash table against plain Python, the report against SQL and by hand."""

import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
from compare import duck, spark_side, sql_side
from conftest import SMALL
from helpers import WORD

import __spark_entry__ as entry_point
from cohortloom.llm import filter_audit as fa
from cohortloom.llm.words import text_bytes

DOCS = "doc_id bigint, text string, lang string, Text_Extra string"
MARKS = "doc_id bigint, quality int, toxic int"


def plain(text):
    words = WORD.findall(text or "")
    return [len(words), len(set(words)), sum("A" <= c <= "Z" for c in text or ""), len(text or ""),
            sum(c in "#$%&*|" for c in text or "")]


def odd_text(rng):
    parts = ["a", "Ab", "é", "日本", "😀x", " ", "\n", "\t", "\x0b", " ", " ", "#", "$|", "word", "w" * 9, "w" * 70]
    return "".join(rng.choices(parts, k=rng.randrange(60)))


def test_transducer_counts_odd_texts():
    rng = random.Random(5)
    texts = [odd_text(rng) for _ in range(3000)] + [None, "", " ", "x", "x ", " x", "a a a", "#"]
    counts = fa.measure(*text_bytes(pa.array(texts, pa.string())))
    assert [list(row) for row in np.stack(counts, axis=1)] == [plain(t) for t in texts]


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(6)
    text = " ".join(odd_text(rng) for _ in range(400)) + "end" * 1000
    monkeypatch.setattr(fa, "SLICE", 500)
    assert [n[0] for n in fa.measure(*text_bytes(pa.array([text])))] == plain(text)


def test_equal_hashes_are_told_apart():
    """All spans get one hash: only the comparison of bytes is left, and the probing ends."""
    words = ["aa", "ab", "aa", "a" * 65, "a" * 64 + "b", "a" * 65, "", "longer than eight", "longer than nine!", "ab"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    start = end - [len(w) for w in words]
    one = np.zeros(len(words), np.uint64)
    assert len(fa.distinct_spans(data, start, end, np.zeros(len(words), np.int64), one)) == len(set(words))
    rows = np.array([0] * 5 + [1] * 5)
    assert len(fa.distinct_spans(data, start, end, rows, one)) == len(set(words[:5])) + len(set(words[5:]))


def by_hand(docs, marks):
    least = {}
    for doc_id, text, _, _ in docs:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    out = Counter()
    for doc_id, text, lang, _ in docs:
        words, distinct, capitals, points, symbols = plain(text)
        fails = {"A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 3 * points, "D": symbols > 0,
                 "E": doc_id is not None and least[text or ""] < doc_id}
        good = any(m[0] == doc_id and m[1] == 1 for m in marks if doc_id is not None)
        toxic = any(m[0] == doc_id and m[2] == 1 for m in marks if doc_id is not None)
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                key = (lang or "", "".join(order), step)
                out[(*key, "kept")] += not gone and not fails[f]
                out[(*key, "removed")] += not gone and fails[f]
                out[(*key, "redundant")] += gone and fails[f]
                out[(*key, "unique_fails")] += fails[f] and sum(fails.values()) == 1
                out[(*key, "good_lost")] += not gone and fails[f] and good
                out[(*key, "toxic_lost")] += not gone and fails[f] and toxic
                if not gone and fails[f]:
                    out[(lang or "", f, "won")] += 1
                gone = gone or fails[f]
    return out


def test_edges(spark):
    rng = random.Random(7)
    prose = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", prose, prose, prose + " #", "Same WORDS " * 300, prose + " X" * 200, odd_text(rng)]
    docs = [(i if i % 17 else None, rng.choice(texts), rng.choice(["en", "de", None, ""]), "x") for i in range(120)]
    docs += docs[:30]  # repeated rows
    marks = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 1), (None, 1, 1)]
    got = fa.filter_audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(marks, MARKS)).collect()
    want = by_hand(docs, marks)
    assert len(got) == 600 * len({d[2] or "" for d in docs})
    for row in got:
        key = (row["part"], row["filter_order"], row["step"])
        for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert row[name] == want[(*key, name)], (key, name)
        assert row["shapley"] == want[(row["part"], row["filter_order"][row["step"] - 1], "won")]


def test_empty_tables_and_two_filters(spark):
    none = spark.createDataFrame([], DOCS)
    assert fa.filter_audit(none, spark.createDataFrame([], MARKS)).count() == 0
    rows = spark.createDataFrame([("p", True, False, 1), ("p", False, True, None)], "part string, good boolean, toxic boolean, n int")
    report = {(r["filter_order"], r["step"]): r["removed"] for r in fa.chain_report(rows, {"X": "n > 0", "Y": "n = 1"}).collect()}
    assert report == {("XY", 1): 1, ("XY", 2): 0, ("YX", 1): 1, ("YX", 2): 0}


def test_query_equals_sql(spark):
    query = entry_point.queries()["op11_filter_audit"](spark, SMALL)
    assert spark_side(query) == sql_side(duck(SMALL), entry_point.oracle_sql()["op11_filter_audit"])


def test_sql_on_empty_texts():
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents AS SELECT 1 AS doc_id, NULL::VARCHAR AS text, NULL::VARCHAR AS lang")
    connection.execute("CREATE TABLE labels AS SELECT 1 AS doc_id, 1 AS quality, NULL::INT AS toxic")
    _, rows = sql_side(connection, fa.ORACLE)
    assert sum(rows.values()) == 600
