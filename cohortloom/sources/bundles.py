"""JSON document set: one document per patient, replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUNDLE_SCHEMA = (
    "paciente_id string, bundle_id string, synthea_runtime string, modulo_synthea string, procedimiento string, "
    "fecha_cirugia string, edad int, genero string, comorbilidades array<string>, complicacion_encounter boolean, "
    "generado_ts string"
)


def write_bundles(profiles: DataFrame, path: str) -> None:
    """One JSON document per line. Overwriting the data set leaves no documents of an
    earlier, larger run behind."""
    profiles.withColumns({
        "fecha_cirugia": F.date_format("fecha_cirugia", "yyyy-MM-dd"),
        "generado_ts": F.date_format("generado_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    }).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Explicit schema, no inference pass; a malformed document fails the job."""
    return spark.read.schema(BUNDLE_SCHEMA).option("mode", "FAILFAST").json(path).withColumns({
        "fecha_cirugia": F.to_date("fecha_cirugia"),
        "generado_ts": F.to_timestamp("generado_ts"),
    })
