"""Text helpers: blank test, word count, template extraction and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """Null, empty or only Unicode white space (``trim`` would strip spaces only)."""
    return text.isNull() | ~text.rlike(r"(?U)[^\s\x1c-\x1f]")


def word_count_sql(column: str) -> str:
    """Blank-separated words of a column."""
    return f"(length({column}) - length(replace({column}, ' ', '')) + 1)"


def word_count(value: str) -> int:
    """The same of a constant."""
    return value.count(" ") + 1


def first_block(document: str) -> str:
    """Lines between the first fence of a prompt document and the next; a fence may name a language."""
    held: list[str] | None = None
    for line in document.splitlines():
        if held is None:
            held = [] if line.startswith("```") else None
        elif line.rstrip() == "```":
            return "\n".join(held)
        else:
            held.append(line)
    raise ValueError("the prompt document has no fenced template block")


def pieces(template: str) -> list[str]:
    """Text and slot names in turn, starting and ending with text."""
    text, *opened = template.split("{{")
    out = [text]
    for part in opened:
        name, closed, text = part.partition("}}")
        if not closed:
            raise ValueError(f"unclosed slot: {part[:20]!r}")
        out += [name.strip(), text]
    return out


def slots(template: str) -> list[str]:
    return pieces(template)[1::2]


def render(template: str, columns: dict[str, Column]) -> Column:
    """Template with ``{{a.b}}`` slots as one ``concat``.

    Slots are replaced in a single pass, so a value that itself looks like a
    slot stays as it is. An unknown slot is an error on the driver.
    """
    found = pieces(template)
    unknown = sorted(set(found[1::2]) - set(columns))
    if unknown:
        raise KeyError(f"template slots without a column: {unknown}")
    return F.concat(*[
        columns[piece].cast("string") if at % 2 else F.lit(piece)
        for at, piece in enumerate(found)
    ])


def percent_text(part: Column, total: Column) -> Column:
    """``part / total`` as a percentage with one decimal, from integers only."""
    scaled, base = part * 2000 + total, total * 2
    tenths = ((scaled - scaled % base) / base).cast("long")
    return F.concat(((tenths - tenths % 10) / 10).cast("long").cast("string"), F.lit("."),
                    (tenths % 10).cast("string"), F.lit("%"))
