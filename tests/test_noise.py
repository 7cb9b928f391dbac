import hashlib

import pytest
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions.noise_text import add_noise, register_functions
from cohortloom.operators import noise
from cohortloom.operators.sets import content_difference
from cohortloom.plans import quality

RUN = __import__("datetime").datetime(2026, 1, 1)


def turns(spark, sizes: dict[str, int], partitions: int = 3):
    rows = [
        (f"dlg_{case}_{i}", case, "pac", 1, i, ("agente", "paciente")[i % 2], f"Texto número {i} del caso {case}, no sé más",
         "amarillo", "evasivo", "m", "m")
        for case, n in sizes.items() for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "dialogo_id string, caso_id string, paciente_id string, dia_postop int, turno_idx int, hablante string, "
              "texto string, label_ground_truth string, estilo_paciente string, modelo_paciente string, modelo_agente string"
    ).repartition(partitions)


def words_of(*parts):
    digest = hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) / 2 ** 32 for k in range(8)]


def key_of(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def test_speech_errors_against_brute_force(spark):
    texts = ["uno dos  tres cuatro cinco ", "", " ", "palabra " * 40, "áéíóú ñandú 日本語テキスト", "a b c d e f g h i j k"]
    for level in (1, 3, 5):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(add_noise("t", "ruido_stt", level, 9)).collect()]
        expected = []
        for text in texts:
            key, out = key_of("inject_noise_udf", text, "ruido_stt", level, 9), []
            for i, word in enumerate(text.split(" ")):
                if word and words_of(key, i // 8)[i % 8] < min(0.9, 0.06 * level):
                    cut = words_of(key, "corte", i)
                    if len(word) > 3 and cut[0] < 0.5:
                        word = word[:2 + int(cut[1] * (len(word) - 2))] + "-"
                    else:
                        word = "[inaudible]"
                out.append(word)
            expected.append(" ".join(out))
        assert got == expected


def test_idioms(spark):
    df = spark.createDataFrame([("Mucho Dolor hoy",), ("mucho dolor y estoy bien, no sé",), ("nada",)], "t string")
    rows = [r[0] for r in df.select(add_noise("t", "modismo_regional", 5, 1)).collect()]
    assert rows[0] == "Mucho Dolor hoy"  # found in another case: counts, stays
    assert rows[1] == "durísimo y estoy bacano, no le sé decir"  # chance 1.0, three allowed
    assert rows[2].split(" ")[-1] in ref.IDIOM_FALLBACK and rows[2].startswith("nada ")
    low = df.select(add_noise("t", "modismo_regional", 1, 1)).collect()[1][0]
    assert sum(phrase in low for phrase in ("durísimo", "bacano", "no le sé decir")) <= 1


def test_ambiguous_replaces_from_four_on(spark):
    df = spark.createDataFrame([("hola",)], "t string")
    assert df.select(add_noise("t", "respuesta_ambigua", 3, 1)).first()[0].startswith("hola ... ")
    assert df.select(add_noise("t", "respuesta_ambigua", 4, 1)).first()[0] in ref.AMBIGUOUS


def test_bad_arguments_fail(spark):
    with pytest.raises(ValueError):
        add_noise("t", "ruido_stt", 6, 1)
    with pytest.raises(ValueError):
        add_noise("t", ref.THIRD_PARTY, 3, 1)
    df = spark.createDataFrame([("hola", "otro", 3), ("hola", "ruido_stt", 0)], "t string, k string, i int")
    for at in (0, 1):
        row = df.where(F.col("i") == (3, 0)[at])
        with pytest.raises(Exception, match="not a text-level|must be between"):
            row.select(add_noise("t", "k", "i", 1)).collect()


def test_registered_function_equals_the_column(spark):
    register_functions(spark)
    df = turns(spark, {"a": 40})
    for kind in ref.TEXT_NOISE:
        both = df.select(add_noise("texto", kind, 3, 42).alias("c"), F.expr(f"add_noise(texto, '{kind}', 3, 42)").alias("s"))
        assert both.where("c <> s").count() == 0


@pytest.mark.parametrize("level", [0, 1, 2, 3, 4, 5, 6])
def test_layer2_and_log(spark, level):
    layer1 = turns(spark, {"a": 30, "b": 12, "c": 1})
    marked = noise.annotate_noise(layer1, level, 42)
    layer2 = noise.layer2_rows(marked, RUN).cache()
    log = noise.noise_log_rows(marked, 42, RUN).cache()
    touched = layer2.where("intensidad_ruido IS NOT NULL")
    assert log.count() == touched.count() == log.select("mapping_id").distinct().count()
    assert quality.silent_changes(layer2, log).isEmpty()
    assert quality.label_drift(layer1, layer2).isEmpty()
    assert {r["tipo_ruido"] for r in log.select("tipo_ruido").distinct().collect()} <= set(noise.eligible_types(level))
    if level in (0, 6):
        assert log.isEmpty() and layer2.count() == 43
    for case in "abc":
        rows = layer2.where(F.col("caso_id") == case).orderBy("turno_idx").collect()
        assert [r["turno_idx"] for r in rows] == list(range(len(rows)))
        for before, row in zip(rows, rows[1:]):
            if row["hablante"] == "tercero":
                assert before["dialogo_id_capa1"] == row["dialogo_id_capa1"] and before["intensidad_ruido"] is None


def test_third_party_leaves_the_original_clean(spark):
    layer1 = turns(spark, {"a": 200})
    layer2 = noise.layer2_rows(noise.annotate_noise(layer1, 5, 3), RUN)
    guests = layer2.where("hablante = 'tercero'")
    assert guests.count() > 10
    originals = layer2.join(guests.select("dialogo_id_capa1"), "dialogo_id_capa1", "left_semi").where("hablante <> 'tercero'")
    changed = originals.join(layer1.select(F.col("dialogo_id").alias("dialogo_id_capa1"), F.col("texto").alias("t")),
                             "dialogo_id_capa1").where("texto <> t")
    assert changed.isEmpty() and originals.count() == guests.count()


def test_numbering_is_exact_across_ranges(spark, monkeypatch):
    """Groups longer than one range, with gaps and insertions, against a plain count."""
    layer1 = turns(spark, {"hot": 400, "b": 9, "c": 33}).where("turno_idx % 7 <> 3")
    marked = noise.annotate_noise(layer1, 4, 42)
    expected = noise.layer2_rows(marked, RUN)
    monkeypatch.setattr(noise, "TURN_RANGE", 16)
    got = noise.layer2_rows(marked, RUN)
    assert tuple(content_difference(got, expected).first()) == (0, 0)
    numbers = [r[0] for r in got.where("caso_id = 'hot'").orderBy("turno_idx").select("turno_idx").collect()]
    assert numbers == list(range(len(numbers))) and len(numbers) > 343


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_result_does_not_depend_on_partitioning(spark, partitions):
    reference = noise.layer2_rows(noise.annotate_noise(turns(spark, {"a": 60, "b": 20}), 3, 42), RUN)
    other = noise.layer2_rows(noise.annotate_noise(turns(spark, {"b": 20, "a": 60}, partitions), 3, 42), RUN)
    assert tuple(content_difference(reference, other).first()) == (0, 0)


def test_seed_matters(spark):
    layer1 = turns(spark, {"a": 60})
    one, two = (noise.layer2_rows(noise.annotate_noise(layer1, 3, s), RUN) for s in (1, 2))
    assert tuple(content_difference(one, two).first()) != (0, 0)
