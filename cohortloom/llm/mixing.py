"""Mixing sources to target weights by Poisson replication.

A source with target share ``w`` of ``epochs`` times all bytes gets the mean repetition rate that
brings its own bytes to that size. Each document inverts the Poisson distribution of that mean at a
uniform value hashed from its id: the number of copies is the smallest count whose cumulative
probability reaches the value. Documents are exploded by their counts and shuffled over the whole
table by a hash of id and copy. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.stored import others, quoted, stored

RESULT = ("copy_no", "mix_position")
COPIES = 1 << 12


def hashed(*parts: Column | str, digits: int = 13) -> Column:
    """First hex digits of an MD5 over ``|``-joined parts as a long: 52 bits by default."""
    text = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def first_count(rate: Column) -> Column:
    """Counts below it are so unlikely (ten standard deviations) that no 52-bit value reaches them."""
    return F.greatest(F.floor(rate - 10 * F.sqrt(rate) - 20), F.lit(0)).cast("long")


def log_factorial(n: Column) -> Column:
    """Stirling's series; of counts from 100 on (and 0) its error is below that of a double's last digit."""
    x = n.cast("double")
    series = x * F.log(x) - x + F.lit(0.5) * F.log(F.lit(2 * math.pi) * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return F.when(n > 0, series).otherwise(0.0)


def with_odds(wanted: DataFrame) -> DataFrame:
    """``mix_source`` and ``rate`` with ``low`` and ``odds``: cumulative Poisson probabilities of ``low``, ``low + 1``, ... far
    into the tail (beyond 52-bit values). Some ``20 * sqrt(rate)`` of them, as rows that running sums add up.

    Terms are built from logarithms, so large rates do not underflow; below 100 or so ``low`` is 0.
    """
    rate, low = F.col("rate"), F.col("low")
    upto = F.when(rate > 0, F.ceil(rate + 10 * F.sqrt(rate) + 20)).otherwise(0).cast("long")
    counts = wanted.withColumn("low", F.when(rate > 0, first_count(rate)).otherwise(F.lit(0).cast("long"))).select(
        "*", F.explode(F.sequence(low, upto)).alias("k"))
    k = F.col("k")
    step = F.when(k == low, -rate + low * F.log(rate) - log_factorial(low)).otherwise(F.log(rate) - F.log(k.cast("double")))
    so_far = Window.partitionBy("mix_source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = counts.withColumn("term", F.when(rate > 0, F.exp(F.sum(step).over(so_far))).otherwise(1.0)).withColumn(
        "upto", F.sum("term").over(so_far))
    return summed.groupBy("mix_source", "rate", "low").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "upto"))), lambda x: x["upto"]).alias("odds"))


def rates(docs: DataFrame, weights: DataFrame | None, *, source: str, text: str, epochs: float,
          temperature: float) -> DataFrame:
    """``mix_source``, ``rate``, ``low`` and ``odds`` of every source; a source without bytes has rate 0."""
    sizes = stored(docs.groupBy(quoted(source).cast("string").alias("mix_source")).agg(
        F.coalesce(F.sum(F.octet_length(quoted(text))), F.lit(0)).cast("double").alias("size")), "mix-sizes")
    if weights is None:
        wanted = sizes.withColumn("weight", F.when(F.col("size") > 0, F.pow("size", F.lit(float(temperature)))).otherwise(0.0))
    else:
        given = weights.groupBy(F.col("source").cast("string").alias("w_source")).agg(F.sum("weight").alias("weight"))
        wanted = sizes.join(given, F.col("mix_source").eqNullSafe(F.col("w_source")), "left").withColumn(
            "weight", F.when(F.col("size") > 0, F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).otherwise(0.0))
    total = wanted.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()  # one row
    scale = float(epochs) * (total["size"] or 0.0) / total["weight"] if total["weight"] else 0.0
    rate = F.when(F.col("weight") > 0, F.lit(scale) * F.col("weight") / F.col("size")).otherwise(0.0)
    return with_odds(wanted.select("mix_source", rate.alias("rate")))


def mix(docs: DataFrame, weights: DataFrame | None = None, *, source: str = "source", text: str = "text",
        doc_id: str = "doc_id", epochs: float = 1.0, temperature: float = 0.7, seed: int = 42) -> DataFrame:
    """Rows of ``docs``, each as often as drawn, with ``copy_no`` (from 1) and ``mix_position``. Rows are dealt
    out to partitions by a hash of their position and sorted by it inside.

    ``weights`` (``source``, ``weight``) are target shares of bytes, in any unit; sources that it does
    not name get none, and negative or null weights count as 0. Without it the shares follow the
    sources' bytes to the power ``temperature``. A null source is a source of its own. Null and empty
    texts add no bytes but are drawn like the rest of their source; a source without any bytes is
    left out. Rows without ``doc_id`` are drawn by their text. Repeated rows get equal counts. Columns
    of ``docs`` named like the two result columns are replaced. An empty table gives an empty result.
    """
    table = stored(rates(docs, weights, source=source, text=text, epochs=epochs, temperature=temperature), "mix-rates")
    names = others(docs, RESULT)
    key = F.coalesce(F.concat(F.lit("id:"), quoted(doc_id).cast("string")),
                     F.concat(F.lit("text:"), F.md5(F.coalesce(quoted(text), F.lit("")).cast("binary"))))
    drawn = docs.select(
        F.struct(*[quoted(c) for c in names]).alias("doc"), quoted(source).cast("string").alias("doc_source"),
        key.alias("key")
    ).withColumn("u", hashed(F.lit(seed), F.col("key"), "count") / F.lit(float(2 ** 52))).join(
        table, F.col("doc_source").eqNullSafe(F.col("mix_source"))
    ).withColumn("below", F.size(F.filter("odds", lambda odds: odds < F.col("u")))).withColumn(
        "copies", (F.col("low") + F.col("below")).cast("int"))
    # large counts are dealt out in two steps, so no row holds more than COPIES numbers
    several = drawn.where("copies > 0").select(
        "doc", "key", "copies", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPIES}").cast("int"))).alias("lot"))
    copied = several.select("doc", "key", F.explode(F.sequence(
        F.col("lot") * COPIES + 1, F.least(F.col("copies"), (F.col("lot") + 1) * COPIES))).alias("copy_no"))
    placed = copied.select("doc", "copy_no", hashed(F.lit(seed), F.col("key"), F.col("copy_no"), "place", digits=15)
                           .alias("mix_position"))
    return placed.repartition("mix_position").sortWithinPartitions("mix_position").select(
        *[F.col("doc")[c].alias(c) for c in names], "copy_no", "mix_position")


ORACLE = """
WITH RECURSIVE sizes AS (
  SELECT source, CAST(sum(strlen(text)) AS DOUBLE) AS size FROM documents GROUP BY source
), total AS (SELECT sum(size) AS size, sum(pow(size, 0.7)) AS weight FROM sizes),
rates AS (SELECT s.source, t.size / t.weight * pow(s.size, 0.7) / s.size AS rate FROM sizes s, total t),
odds AS (
  SELECT source, rate, 0 AS k, -rate AS lg, exp(-rate) AS upto FROM rates
  UNION ALL
  SELECT source, rate, k + 1, lg + ln(rate) - ln(k + 1), upto + exp(lg + ln(rate) - ln(k + 1))
  FROM odds WHERE k < ceil(rate + 10 * sqrt(rate) + 20)
), drawn AS (
  SELECT d.*, CAST('0x' || substr(md5('42|id:' || doc_id || '|count'), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM documents d
), counted AS (
  SELECT d.doc_id, any_value(d.text) AS text, any_value(d.lang) AS lang, any_value(d.source) AS source,
         any_value(d.n_chars) AS n_chars, count(*) FILTER (WHERE o.upto < d.u) AS copies
  FROM drawn d JOIN odds o ON d.source IS NOT DISTINCT FROM o.source GROUP BY d.doc_id
), copied AS (SELECT *, unnest(range(1, copies + 1)) AS c FROM counted)
SELECT doc_id, text, lang, source, n_chars, CAST(c AS INTEGER) AS copy_no,
       CAST('0x' || substr(md5('42|id:' || doc_id || '|' || c || '|place'), 1, 15) AS BIGINT) AS mix_position
FROM copied
"""
