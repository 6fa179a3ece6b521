"""Filling text formats with columns."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F


def fill(template: str, **columns: Column) -> Column:
    """``template`` with each ``{name}`` replaced by a column; NULL if any of them is NULL."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(columns[name])
    return F.concat(*parts)


def fill_sql(template: str, **texts: str) -> str:
    """``fill`` as SQL text: each ``{name}`` replaced by an SQL expression."""
    parts = []
    for text, name, _, _ in string.Formatter().parse(template):
        if text:
            parts.append(sql_literal(text))
        if name:
            parts.append(texts[name])
    return f"concat({', '.join(parts)})"


def sql_literal(value: str) -> str:
    """Text as a literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(*names: str) -> str:
    """A dotted name of Spark SQL."""
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def literal_text(column: Column) -> Column:
    """Text for use between single quotes in a statement."""
    return F.replace(column, F.lit("'"), F.lit("''"))


def identifier(column: Column, quoted: bool = False) -> Column:
    """An identifier, as is or in double quotes."""
    if not quoted:
        return column
    return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))


def dotted_name(*parts: Column, quoted: bool = False) -> Column:
    """``a.b.c``; NULL if a part is NULL."""
    texts = [identifier(p, quoted) for p in parts]
    return F.concat(texts[0], *(c for t in texts[1:] for c in (F.lit("."), t)))


def is_blank(column: Column) -> Column:
    """True for NULL, empty and whitespace-only text."""
    return F.coalesce(~column.rlike(r"\S"), F.lit(True))
