"""Seeded draws as column expressions.

One SHA-256 over the ``|``-joined seed parts gives 64 hex digits, read as eight
32-bit words, so a row needs one digest for up to eight draws. Words from number 8
on come from further digests, one per eight words, keyed by the first and their
number. The result depends on the key only, never on partitioning or row order. Seed parts must be
non-null: ``concat_ws`` leaves nulls out.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 2.0 ** -32


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def digest(*parts) -> Column:
    return F.sha2(F.concat_ws("|", *[as_column(p).cast("string") for p in parts]), 256)


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Draws:
    """The draws of the digest column ``name``, each one SQL expression; any number of them.

    Limits of a draw may be numbers or column names. Words, indexes and choices are wrapped
    in ``coalesce`` because they are never null: the optimizer then adds no null
    filter on drawn join keys, which would compute the digest a second time.
    """

    def __init__(self, name: str = "d") -> None:
        self.name = name

    def word_sql(self, k: int | str) -> str:
        if isinstance(k, int):
            if k < 0:
                raise ValueError("word numbers start at 0")
            source = self.name if k < 8 else f"sha2(concat({self.name}, '|{k // 8}'), 256)"
            digits = f"substring({source}, {8 * (k % 8) + 1}, 8)"
        else:
            further = f"sha2(concat({self.name}, '|', cast(({k}) div 8 AS STRING)), 256)"
            digits = (f"CASE WHEN ({k}) < 8 THEN substring({self.name}, 8 * ({k}) + 1, 8) "
                      f"ELSE substring({further}, cast(8 * (({k}) % 8) + 1 AS INT), 8) END")
        return f"coalesce(cast(conv({digits}, 16, 10) AS BIGINT), 0L)"

    def uniform_sql(self, k: int | str) -> str:
        return f"({self.word_sql(k)} * {UNIT!r}D)"

    def index_sql(self, k: int, size: int | str) -> str:
        return f"coalesce(cast(floor({self.uniform_sql(k)} * {size}) AS INT), 0)"

    def real_sql(self, k: int, low, high) -> str:
        return f"({low} + ({high} - {low}) * {self.uniform_sql(k)})"

    def word(self, k: int = 0) -> Column:
        """A long in 0..2**32-1; half of the values exceed INT."""
        return F.expr(self.word_sql(k))

    def uniform(self, k: int = 0) -> Column:
        return F.expr(self.uniform_sql(k))

    def below(self, k: int, p) -> Column:
        return F.expr(f"{self.uniform_sql(k)} < {p}")

    def index(self, k: int, size: int) -> Column:
        """0..size-1"""
        return F.expr(self.index_sql(k, size))

    def int_between(self, k: int, low, high) -> Column:
        """Integer in low..high, both ends included."""
        return F.expr(f"cast({low} + floor({self.uniform_sql(k)} * ({high} - {low} + 1)) AS INT)")

    def pick(self, k: int, options: Sequence[str] | str) -> Column:
        """Even choice from a list, or from the array column named ``options``;
        an option listed twice is twice as likely."""
        return F.expr(self.pick_sql(k, options))

    def pick_sql(self, k: int, options: Sequence[str] | str) -> str:
        if isinstance(options, str):
            return f"element_at({options}, {self.index_sql(k, f'size({options})')} + 1)"
        values = f"from_json({sql_text(json.dumps(list(options), ensure_ascii=False))}, 'array<string>')"
        return f"coalesce(element_at({values}, {self.index_sql(k, len(options))} + 1), {sql_text(options[0])})"


    def choice_sql(self, k: int, options: Sequence[str]) -> str:
        """``pick_sql`` from a short list by word 0..7, told from the digits alone: option j stands above the j-th of
        equal parts of all words, so neither a number nor an array is made for the row."""
        if not 0 <= k < 8:
            raise ValueError("a choice by digits reads words 0 to 7")
        digits = f"substring({self.name}, {8 * k + 1}, 8)"
        parts = [f"{-(-at * 2 ** 32 // len(options)):08x}" for at in range(len(options))]
        above = " ".join(f"WHEN {digits} >= '{parts[at]}' THEN {sql_text(options[at])}"
                         for at in range(len(options) - 1, 0, -1))
        return f"CASE {above} ELSE {sql_text(options[0])} END" if above else sql_text(options[0])

    def choice(self, k: int, options: Sequence[str]) -> Column:
        return F.expr(self.choice_sql(k, options))


def one_decimal_sql(x: str) -> str:
    return f"(floor(({x}) * 10.0D + 0.5D) / 10.0D)"


def stable_seed(*parts) -> Column:
    """First word of the digest of ``parts``."""
    return F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("long")


def hex_threshold(p: float) -> str:
    """Smallest 8-digit word that is *not* below ``p``.

    Eight lower-case hex digits sort like the number they stand for, so
    ``hex_word < hex_threshold(p)`` is ``uniform < p`` without any conversion.
    """
    if not 0.0 <= p < 1.0:
        raise ValueError("probability must be in [0, 1)")
    return f"{math.ceil(p * 2 ** 32):08x}"


def constant_array(values: Sequence, element: str = "string") -> Column:
    """A literal array; one JSON literal that the optimizer folds while planning."""
    return F.from_json(F.lit(json.dumps(list(values), ensure_ascii=False)), f"array<{element}>")
