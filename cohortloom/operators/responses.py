"""Service responses of changing shape, read as VARIANT: accepted rows and rejected ones with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Where text and token counts may be, in the order in which they are looked for.
TEXT_PATHS = ["$.choices[0].message.content", "$.output.text"]
BLOCKS_PATH = "$.content"
PROMPT_PATHS = ["$.usage.input_tokens", "$.usage.prompt_tokens", "$.tokens.entrada"]
COMPLETION_PATHS = ["$.usage.output_tokens", "$.usage.completion_tokens", "$.tokens.salida"]
BAD_JSON, NO_TEXT, BAD_TOKENS = "json_invalido", "sin_texto", "tokens_invalidos"


def _first(column: str, paths: list[str], kind: str) -> Column:
    return F.coalesce(*[F.try_variant_get(column, path, kind) for path in paths])


def parse_variants(responses: DataFrame, column: str = "respuesta") -> DataFrame:
    """Every row of ``responses`` with ``texto``, ``prompt_tokens``, ``completion_tokens`` and ``motivo``, null if accepted.

    The text is that of the first block of type ``text``, or a message, or a plain output. Missing counts are 0;
    counts given as digits in quotes are read; a count that is there but is no whole number of at least 0 rejects
    the row, as do broken JSON and a missing text. No row fails the job; other fields may come and go.
    """
    block = F.get(F.filter(
        F.try_variant_get("v", BLOCKS_PATH, "array<struct<type:string,text:string>>"), lambda b: b["type"] == "text"), F.lit(0))
    given = {name: _first("v", paths, "string") for name, paths in
             (("dado_p", PROMPT_PATHS), ("dado_c", COMPLETION_PATHS))}
    read = responses.withColumn("v", F.try_parse_json(column)).withColumns(
        {"texto": F.coalesce(block["text"], _first("v", TEXT_PATHS, "string")), **given})
    count = lambda name: F.coalesce(F.col(name).try_cast("int"), F.lit(0))
    wrong = lambda name: F.col(name).isNotNull() & ~F.coalesce(F.col(name).try_cast("int") >= 0, F.lit(False))
    reason = (F.when(F.col("v").isNull(), BAD_JSON).when(F.col("texto").isNull(), NO_TEXT)
              .when(wrong("dado_p") | wrong("dado_c"), BAD_TOKENS))
    kept = [c for c in responses.columns if c != column]
    judged = read.withColumn("motivo", reason)
    accepted = F.col("motivo").isNull()
    return judged.select(
        *kept, F.when(accepted, F.col("texto")).alias("texto"),
        F.when(accepted, count("dado_p")).alias("prompt_tokens"),
        F.when(accepted, count("dado_c")).alias("completion_tokens"), "motivo")
