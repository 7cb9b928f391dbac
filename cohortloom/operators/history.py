"""What was known about an entity before each of its rows, and runs of equal state over time.

Both cut the history of an entity into spans of time. A span is one window group, so an entity that holds
a third of all rows is spread over as many tasks as it has spans; what crosses from span to span is one
row a span, folded before its shuffle. Rows of one entity at one instant stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_SECONDS = 86_400


def _span(time: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(time) / (seconds * 1_000_000)).alias("tramo")


def latest_before(rows: DataFrame, facts: DataFrame, *, key: str, time: str, order: str, values: list[str],
                  seconds: int = SPAN_SECONDS) -> DataFrame:
    """``rows`` with ``previo``, the struct of ``values`` of the latest row of ``facts`` with the same key and a strictly
    earlier time; null if there is none. Of facts at one time that with the greatest ``order`` counts.

    Rows with a null key or time have no earlier fact; such facts are left out. No range condition: both sides are
    united, sorted by time within their span, and the last fact is carried on; what a span inherits is the
    latest fact of the spans before it, one row a span.
    """
    fact = F.struct(*values)
    known = facts.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("clave"), F.col(time).alias("hora"), F.lit(1).alias("es_hecho"), F.col(order).alias("orden"),
        fact.alias("hecho"), F.lit(None).cast(rows.select(F.struct("*").alias("r")).schema["r"].dataType).alias("fila"))
    asked = rows.select(
        F.col(key).alias("clave"), F.col(time).alias("hora"), F.lit(0).alias("es_hecho"),
        F.lit(None).cast(known.schema["orden"].dataType).alias("orden"),
        F.lit(None).cast(known.schema["hecho"].dataType).alias("hecho"), F.struct("*").alias("fila"))
    united = known.unionByName(asked).select("*", _span("hora", seconds))
    spans = united.groupBy("clave", "tramo").agg(
        F.max_by("hecho", F.when(F.col("es_hecho") == 1, F.struct("hora", "orden"))).alias("ultimo"))
    before = Window.partitionBy("clave").orderBy("tramo").rowsBetween(Window.unboundedPreceding, -1)
    inherited = spans.select("clave", "tramo", F.last("ultimo", ignorenulls=True).over(before).alias("heredado")).where(
        "clave is not null and tramo is not null and heredado is not null")
    # at one time rows come before facts, so a fact is strictly earlier than the rows that see it
    within = Window.partitionBy("clave", "tramo").orderBy("hora", "es_hecho", "orden").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = united.join(inherited, ["clave", "tramo"], "left").withColumn(
        "visto", F.coalesce(F.last("hecho", ignorenulls=True).over(within), F.col("heredado")))
    sure = F.col("clave").isNotNull() & F.col("hora").isNotNull()
    return seen.where("es_hecho = 0").select("fila.*", F.when(sure, F.col("visto")).alias("previo"))


def episodes(rows: DataFrame, *, key: str, time: str, order: str, state: Column,
             seconds: int = SPAN_SECONDS) -> DataFrame:
    """Maximal runs of rows of a key, by time, in which ``state`` holds: key, ``inicio``, ``fin`` (times of the first and
    the last row), ``n``, ``abierto`` (nothing follows the run).

    Rows at one time follow each other by ``order``. A null state does not hold. Rows with a null key or time
    are left out. Runs inside a span are final; only the run that touches a span's start and the one that
    touches its end are linked over spans, two rows a span.
    """
    marked = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("clave"), F.col(time).alias("hora"), F.col(order).alias("orden"),
        F.coalesce(state, F.lit(False)).alias("dentro"), _span(time, seconds))
    within = Window.partitionBy("clave", "tramo").orderBy("hora", "orden")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = marked.select(
        "clave", "tramo", "hora", "dentro",
        F.lag("dentro").over(within).isNull().alias("primera"), F.lead("dentro").over(within).isNull().alias("ultima"),
        F.count_if(~F.col("dentro")).over(so_far).alias("corte"))
    runs = placed.groupBy("clave", "tramo", "corte").agg(
        F.min(F.when(F.col("dentro"), F.col("hora"))).alias("inicio"), F.max(F.when(F.col("dentro"), F.col("hora"))).alias("fin"),
        F.count_if("dentro").alias("n"), F.max(F.col("primera") & F.col("dentro")).alias("toca_inicio"),
        F.max(F.col("ultima") & F.col("dentro")).alias("toca_fin"))
    # two places a span: the run at its start, the run at its end (the same one if the state always holds)
    spans = runs.groupBy("clave", "tramo").agg(
        F.max("toca_inicio").alias("empieza"), F.max("toca_fin").alias("termina"),
        F.max(F.col("toca_inicio") & F.col("toca_fin")).alias("entero"))
    by_span = Window.partitionBy("clave").orderBy("tramo")
    linked = spans.withColumns({
        "sigue": F.col("empieza") & F.coalesce(F.lag("termina").over(by_span), F.lit(False)),
        "ultimo": F.lead("tramo").over(by_span).isNull()})
    places = linked.select("clave", "tramo", F.inline(F.array(
        F.struct(F.lit(0).alias("lugar"), F.when(~F.col("sigue"), F.struct("tramo", F.lit(0).alias("lugar"))).alias("origen"),
                 (F.col("entero") & F.col("ultimo")).alias("final")),
        F.struct(F.lit(1).alias("lugar"), F.when(~F.col("entero"), F.struct("tramo", F.lit(1).alias("lugar"))).alias("origen"),
                 F.col("ultimo").alias("final")))))
    in_order = Window.partitionBy("clave").orderBy("tramo", "lugar").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chains = places.select("clave", "tramo", "lugar", "final", F.last("origen", ignorenulls=True).over(in_order).alias("origen"))
    held = runs.where("n > 0")
    edge = held.where("toca_inicio or toca_fin").withColumn("lugar", F.when(F.col("toca_inicio"), 0).otherwise(1))
    whole = edge.join(chains, ["clave", "tramo", "lugar"]).groupBy("clave", "origen").agg(
        F.min("inicio").alias("inicio"), F.max("fin").alias("fin"), F.sum("n").alias("n"),
        F.max(F.col("toca_fin") & F.col("final")).alias("abierto"))
    inner = held.where("not toca_inicio and not toca_fin").withColumn("abierto", F.lit(False))
    columns = [F.col("clave").alias(key), "inicio", "fin", F.col("n").cast("long").alias("n"), "abierto"]
    return whole.select(*columns).unionByName(inner.select(*columns))
