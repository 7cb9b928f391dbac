"""Text noise as SQL expressions: ``add_noise(text, type, intensity, seed)``.

All draws are keyed by (text, type, intensity, seed), so equal texts change
equally. Arguments are SQL expressions (usually column names), which lets the
same definition serve as a column and as a registered SQL function.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cohortloom import reference_data as ref
from cohortloom.functions.draws import Draws, hex_threshold, sql_text

INTENSITIES = (1, 2, 3, 4, 5)


def _bind(value: str, name: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` inside ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _digest(*parts: str) -> str:
    return f"sha2(concat_ws('|', {', '.join(f'cast({p} AS STRING)' for p in parts)}), 256)"


def _hex_word(d: str, k: str) -> str:
    return f"substring({d}, cast(8 * ({k}) + 1 AS INT), 8)"


def _json(value, kind: str) -> str:
    return f"from_json({sql_text(json.dumps(value, ensure_ascii=False))}, '{kind}')"


def _pick(key: str, k: int, options: list[str]) -> str:
    return Draws(key).choice_sql(k, options)


def speech_errors(text: str, level: str, key: str) -> str:
    """Each non-empty word is hit with min(0.9, 0.06 x intensity): half of the hit words
    longer than three characters are cut short, the others become inaudible.

    Words are tested against digests that serve eight words each, as hex text;
    only hit words pay for a digest of their own.
    """
    limits = ", ".join(sql_text(hex_threshold(min(0.9, 0.06 * i))) for i in INTENSITIES)
    cut = Draws("c_").uniform_sql(1)
    damaged = _bind(_digest(key, "'corte'", "i_"), "c_", f"""
        CASE WHEN length(w_) > 3 AND {_hex_word('c_', '0')} < '{hex_threshold(0.5)}'
             THEN concat(substring(w_, 1, cast(2 + floor({cut} * (length(w_) - 2)) AS INT)), '-')
             ELSE '{ref.INAUDIBLE}' END""")
    block = "element_at(blocks_, cast(i_ div 8 AS INT) + 1)"
    words = f"""array_join(transform(words_, (w_, i_) ->
        CASE WHEN w_ <> '' AND {_hex_word(block, 'i_ % 8')} < limit_ THEN {damaged} ELSE w_ END), ' ')"""
    blocks = f"transform(sequence(0, cast((size(words_) - 1) div 8 AS INT)), b_ -> {_digest(key, 'b_')})"
    return _bind(f"split({text}, ' ', -1)", "words_", _bind(
        blocks, "blocks_", _bind(f"element_at(array({limits}), {level})", "limit_", words)))


def idioms(text: str, level: str, key: str, idiom_map: dict[str, str] | None = None) -> str:
    """Map entries in order, each phrase found being applied with 0.5 + 0.1 x intensity, at
    most 1 + intensity / 2 of them; a filler word is added if none was applied.

    A phrase counts as found whatever its case, while only its exact form is
    replaced, so a capitalised phrase counts as applied and stays.
    """
    idiom_map = ref.IDIOMS if idiom_map is None else idiom_map
    # Word 7 draws the filler, so entries from the eighth on use the words after it.
    entries = [{"nr": at + (at > 6), "frase": phrase, "modismo": idiom} for at, (phrase, idiom) in enumerate(idiom_map.items())]
    allowed = f"least({len(idiom_map)}, 1 + {level} div 2)"
    chance = f"(0.5D + 0.1D * {level})"
    # The lower-case copy is part of the state: lower() is costly on accented text and is
    # due again only after a replacement.
    replaced = "replace(s_.texto, e_.frase, e_.modismo)"
    return f"""aggregate({_json(entries, 'array<struct<nr: int, frase: string, modismo: string>>')},
        named_struct('texto', {text}, 'baja', lower({text}), 'n', 0),
        (s_, e_) -> CASE WHEN s_.n < {allowed} AND contains(s_.baja, e_.frase)
                              AND {Draws(key).uniform_sql('e_.nr')} < {chance}
                         THEN named_struct('texto', {replaced}, 'baja', lower({replaced}), 'n', s_.n + 1)
                         ELSE s_ END,
        s_ -> CASE WHEN s_.n = 0 THEN concat(s_.texto, ' ', {_pick(key, 7, ref.IDIOM_FALLBACK)}) ELSE s_.texto END)"""


def ambiguous(text: str, level: str, key: str) -> str:
    phrase = _pick(key, 0, ref.AMBIGUOUS)
    return f"CASE WHEN {level} >= 4 THEN {phrase} ELSE concat({text}, ' ... ', {phrase}) END"


def contradiction(text: str, level: str, key: str) -> str:
    return f"concat({text}, ' ', {_pick(key, 0, ref.CONTRADICTIONS)})"


def missing_answer(text: str, level: str, key: str) -> str:
    return _pick(key, 0, ref.FILLERS)


Change = Callable[[str, str, str], str]
CHANGES: dict[str, Change] = dict(zip(
    ref.TEXT_NOISE, (speech_errors, idioms, ambiguous, contradiction, missing_answer)))


def key_sql(text: str, kind: str, level: str, seed: str) -> str:
    """What all draws of a noisy text are keyed by."""
    return _digest("'inject_noise_udf'", text, kind, level, seed)


def noise_sql(text: str, kind: str, level: str, seed: str, changes: dict[str, Change], key: str | None = None) -> str:
    """Any text-level type at any intensity 1..5; other values fail on the row. ``key`` is a column that holds
    ``key_sql`` already: the changes are then compiled with the row instead of being evaluated within a lambda."""
    cases = " ".join(f"WHEN '{name}' THEN {change(text, level, key or 'key_')}" for name, change in changes.items())
    dispatched = f"CASE {kind} {cases} ELSE raise_error(concat('not a text-level noise type: ', {kind})) END"
    noisy = dispatched if key else _bind(key_sql(text, kind, level, seed), "key_", dispatched)
    bad_level = f"raise_error(concat('intensity must be between 1 and 5: ', cast({level} AS STRING)))"
    return f"CASE WHEN {level} BETWEEN 1 AND 5 THEN {noisy} ELSE {bad_level} END"


def add_noise(
    text: str, kind: str, intensity: int | str, seed: int, idiom_map: dict[str, str] | None = None,
    key: str | None = None
) -> Column:
    """Noise on the expression ``text``. ``kind`` is a type name or the column that holds it,
    ``intensity`` a number or a column, ``key`` the column of ``key_sql`` if there is one. Wrong names and
    numbers fail at once."""
    if isinstance(intensity, int) and intensity not in INTENSITIES:
        raise ValueError("intensity must be between 1 and 5")
    if kind == ref.THIRD_PARTY:
        raise ValueError(f"{kind!r} is not a text-level noise type")
    changes = dict(CHANGES)
    if idiom_map is not None:
        changes["modismo_regional"] = lambda t, i, k: idioms(t, i, k, idiom_map)
    if kind in changes:
        changes, kind = {kind: changes[kind]}, sql_text(kind)
    return F.expr(noise_sql(text, kind, str(intensity), str(seed), changes, key))


def register_functions(spark: SparkSession) -> None:
    """Make ``add_noise(texto, tipo, intensidad, seed)`` callable from SQL.

    A SQL function: the analyzer inlines its body, so it stays inside the JVM.
    """
    body = noise_sql("texto", "tipo", "intensidad", "seed", CHANGES)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION add_noise(texto STRING, tipo STRING, intensidad INT, seed INT) "
        f"RETURNS STRING RETURN {body}")
