import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.functions import draws
from cohortloom.functions.text import first_block, is_blank, percent_text, render
from cohortloom.operators.profiles import patient_id


def seed_of(*parts) -> int:
    return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def test_stable_seed_is_the_head_of_sha256(spark):
    rows = spark.range(500).select("id", draws.stable_seed("parte", F.col("id"), 42).alias("s")).collect()
    assert all(r["s"] == seed_of("parte", r["id"], 42) for r in rows)
    assert max(r["s"] for r in rows) > 2 ** 31


@given(st.floats(min_value=0, max_value=0.999999), st.integers(min_value=0, max_value=2 ** 32 - 1))
def test_hex_threshold_is_the_numeric_comparison(p, word):
    assert (f"{word:08x}" < draws.hex_threshold(p)) == (word / 2 ** 32 < p)


def test_limits_are_inclusive_and_all_reached(spark):
    d = draws.Draws("d")
    drawn = spark.range(3000).withColumn("d", draws.digest("x", F.col("id"))).select(
        d.int_between(0, 2, 5).alias("n"), d.pick(1, ["a", "b"]).alias("c"), d.uniform(2).alias("u"))
    seen = drawn.agg(F.collect_set("n").alias("n"), F.collect_set("c").alias("c"), F.min("u"), F.max("u")).first()
    assert sorted(seen["n"]) == [2, 3, 4, 5] and sorted(seen["c"]) == ["a", "b"]
    assert 0 <= seen[2] < 0.01 and 0.99 < seen[3] < 1


def test_words_beyond_the_first_digest(spark):
    d = draws.Draws("d")
    keyed = spark.range(4000).withColumn("d", draws.digest("x", F.col("id")))
    rows = keyed.select("d", d.word(7).alias("w7"), d.word(8).alias("w8"), d.word(17).alias("w17"), F.expr(
        f"transform(sequence(0, 20), i -> {d.word_sql('i')})").alias("all")).collect()
    for r in rows[:50]:
        assert (r.w7, r.w8, r.w17) == (r["all"][7], r["all"][8], r["all"][17])
        assert r.w7 == int(r.d[56:], 16)
        assert r.w17 == int(hashlib.sha256(f"{r.d}|2".encode()).hexdigest()[8:16], 16)
    for k in range(21):
        share = sum(r["all"][k] / 2 ** 32 < 0.25 for r in rows) / 4000
        assert abs(share - 0.25) < 0.04
    with pytest.raises(ValueError):
        d.word(-1)


@pytest.mark.parametrize("index", [None, -1])
def test_an_index_must_be_a_number_from_zero(spark, index):
    rows = spark.createDataFrame([(index,)], "i long")
    with pytest.raises(Exception, match="not an index of a patient"):
        rows.select(patient_id(F.col("i"), 7)).collect()


def test_long_ids_are_not_cut(spark):
    ids = spark.range(99_998, 123_457, 11_729).select(patient_id(F.col("id"), 7).alias("p")).collect()
    assert [r["p"] for r in ids] == ["pac_7_99998", "pac_7_111727", "pac_7_123456"]


def test_one_decimal_rounds_half_up(spark):
    value = spark.sql(f"SELECT {draws.one_decimal_sql('37.25D')} AS a, {draws.one_decimal_sql('36.04D')} AS b").first()
    assert tuple(value) == (37.3, 36.0)


def test_blank_means_any_white_space(spark):
    texts = [None, "", "  ", "\t\n", "  ", "\x1c", "a", " . "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(is_blank(F.col("t")).alias("b"))
    assert [r["b"] for r in df.collect()] == [t is None or not t.strip() for t in texts]


def test_percent_text(spark):
    df = spark.createDataFrame([(0, 3), (1, 3), (3, 3), (76, 100), (1, 1000)], "n long, total long")
    assert [r[0] for r in df.select(percent_text(F.col("n"), F.col("total"))).collect()] == [
        "0.0%", "33.3%", "100.0%", "76.0%", "0.1%"]


def test_rendering_is_one_pass(spark):
    df = spark.createDataFrame([("{{b}}", 3)], "a string, b int")
    assert df.select(render("<{{ a }}|{{b}}>", {"a": F.col("a"), "b": F.col("b")})).first()[0] == "<{{b}}|3>"
    with pytest.raises(KeyError):
        render("{{label}}", {"a": F.col("a")})


def test_fences_and_slots_that_are_not_closed():
    assert first_block("```text\r\nuno\r\n```\r\n") == "uno"
    with pytest.raises(ValueError):
        render("{{a", {"a": F.lit(1)})


def test_first_fenced_block():
    assert first_block("x\n```\nuno\ndos\n```\n```\ntres\n```") == "uno\ndos"
    with pytest.raises(ValueError):
        first_block("sin bloque")
