import hashlib
import math
import time
from collections import Counter

import numpy as np
import pytest
from compare import spark_side, sql_side
from conftest import SMALL
from pyspark.sql import functions as F

from cohortloom.llm.mixing import mix, with_odds
from cohortloom.llm.queries import ORACLES, QUERIES
from cohortloom.llm.warc import MAGIC, read_archives, write_archives


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert spark_side(QUERIES[name](spark, SMALL)) == sql_side(connection, ORACLES[name])


def test_rates_reach_the_target(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"),
                                     F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").alias("source"))
    weights = spark.createDataFrame([("a", 3.0), (None, 1.0), ("gone", 5.0), ("b", -2.0)], "source string, weight double")
    seen = Counter(r.source for r in mix(docs, weights).collect())
    assert seen["b"] == 0 and seen["gone"] == 0
    assert abs(seen["a"] - 15000) < 500 and abs(seen[None] - 5000) < 300


def exact_odds(rate, upto):
    total, out = 0.0, []
    for k in range(upto + 1):
        total += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        out.append(total)
    return out


@pytest.mark.parametrize("rate", [0.01, 1.0, 40.0, 130.0, 2000.0, 30_000.0])
def test_odds_equal_the_distribution(spark, rate):
    row = with_odds(spark.createDataFrame([("s", rate)], "mix_source string, rate double")).first()
    exact = exact_odds(rate, row.low + len(row.odds) - 1)
    assert row.low == 0 or exact[row.low - 1] < 2 ** -52
    assert np.allclose(row.odds, exact[row.low:], rtol=0, atol=1e-9) and row.odds[-1] == pytest.approx(1.0, abs=1e-9)
    assert len(row.odds) <= 20 * math.sqrt(rate) + 45


def test_very_large_rates(spark):
    """Two documents with rates of 100,000 and 1,000,000 are drawn in seconds, as often as their rate says."""
    docs = spark.createDataFrame([(1, "a" * 10, "x"), (2, "b" * 10, "y")], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("x", 1.0), ("y", 10.0)], "source string, weight double")
    began = time.monotonic()
    drawn = mix(docs, weights, epochs=550_000.0).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max("copy_no").alias("last"), F.countDistinct("copy_no").alias("kinds")).collect()
    for row in drawn:
        rate = {1: 100_000, 2: 1_000_000}[row.doc_id]
        assert abs(row.n - rate) < 8 * math.sqrt(rate) and row.n == row.last == row.kinds
    assert len(drawn) == 2 and time.monotonic() - began < 60


def test_mixing_odd_rows(spark):
    rows = [(1, "a", "x", 0), (1, "a", "x", 0), (None, "b", "x", 0), (2, None, "x", 0), (3, "", "empty", 0), (4, "c" * 9, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, Copy_No int")
    got = mix(docs, epochs=4.0)
    assert got.columns == ["doc_id", "text", "source", "copy_no", "mix_position"]
    copies = Counter((r.doc_id, r.source) for r in got.collect())
    assert copies[1, "x"] % 2 == 0 and (3, "empty") not in copies and (None, "x") in copies
    assert mix(docs.limit(0)).collect() == []


FAKE = MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
LONG = "<p>" + "é x" * 60 + "</p>"
PAGES = [(i, f"http://a/{i}", f"row {i} " * i) for i in range(30)] + [
    (100, None, LONG), (101, "u", LONG), (99, "u v", LONG), (102, "u", "x"), (103, "u", "x"), (104, "u", None), (105, "u", ""),
    (106, "u", "a" + MAGIC + "b"), (107, "u", FAKE * 3 + "tail"), (108, "u", MAGIC * 5), (109, "u", MAGIC),
    (110, "u", "\r\n\r\n" + MAGIC + "\r\n\r\n"), (None, "u", LONG), (None, "u", "lonely" * 40), (111, "u", "q" + FAKE),
    (112, "u", "WARC/1.1\rWARC/1.1\r\nWWARC/1.1\r\n")]


@pytest.mark.parametrize("compression, split", [("gzip", "128m"), ("none", "128m"), ("none", "97")])
def test_archives_round_trip(spark, tmp_path, compression, split):
    first = {}
    for page, _, html in PAGES:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        to = first.get(body)
        to = to if to is not None and to != page else None
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to,
                     None if to is not None else bytes(body)))
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int").repartition(2)
    write_archives(pages, str(tmp_path / "a"), compression=compression)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_archives(spark, str(tmp_path / "a")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str) and all(r.intact for r in rows)


def test_archives_of_an_empty_table(spark, tmp_path):
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert read_archives(spark, str(tmp_path / "a")).collect() == []
