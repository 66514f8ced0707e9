"""Mapfile lines: fields, metadata items and path mappings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapledger.functions.text import after_first, strip


def fields(line: Column) -> Column:
    """Trimmed pipe-separated fields of a line."""
    return F.transform(F.split(strip(line), r"\|", -1), strip)


def field(line_fields: Column, position: int) -> Column:
    return F.get(line_fields, position)


def metadata(line_fields: Column, key: str) -> Column:
    """Value of a ``key=value`` item after the third field; the last one counts."""
    items = F.slice(line_fields, F.lit(4), F.greatest(F.size(line_fields) - F.lit(3), F.lit(0)))
    hits = F.filter(items, lambda x: x.contains("=") & (strip(F.substring_index(x, "=", 1)) == key))
    return strip(after_first(F.try_element_at(hits, F.lit(-1)), "="))


def size_value(text: Column) -> Column:
    """Integer text to bigint; null when it is not an integer or does not fit."""
    return F.when(
        text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint")
    )


def size_error(text: Column) -> Column:
    # Fixed value: message format.
    return F.when(
        size_value(text).isNull(),
        F.concat(F.lit("invalid literal for int() with base 10: '"), text, F.lit("'")),
    )


def mapped_path(path: Column, mappings: Iterable[tuple[str, str]], strict: bool = False) -> Column:
    """Apply the first matching prefix mapping to a path.

    The default form also maps the root itself and joins target and remainder with
    one slash. The strict form needs something below the root and keeps the target as written.
    """
    cases: list[tuple[Column, Column]] = []
    for source, target in mappings:
        if strict:
            rest = F.substr(path, F.lit(len(source) + 1))
            cases.append((path.startswith(source + "/"), F.concat(F.lit(target), rest)))
        else:
            root = source.rstrip("/")
            rest = F.substr(path, F.lit(len(root) + 1))
            cases.append((path == source, F.lit(target)))
            cases.append((path.startswith(root + "/"), F.concat(F.lit(target.rstrip("/")), rest)))
    if not cases:
        return path
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out.otherwise(path)


def rewritten_line(line: Column, mappings: Iterable[tuple[str, str]], strict: bool = False) -> Column:
    """The line with its path field mapped; lines with too few fields stay as they are."""
    source = strip(line) if strict else F.rtrim(line, F.lit("\n"))
    cells = F.split(source, r"\|", -1)
    path = mapped_path(strip(F.get(cells, 1)), mappings, strict)
    rebuilt = F.array_join(
        F.concat(
            F.slice(cells, 1, 1),
            F.array(F.concat(F.lit(" "), path, F.lit(" "))),
            F.slice(cells, F.lit(3), F.greatest(F.size(cells) - F.lit(2), F.lit(0))),
        ),
        "|",
    )
    return F.when(F.size(cells) >= (3 if strict else 2), rebuilt).otherwise(line)
