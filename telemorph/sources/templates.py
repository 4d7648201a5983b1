"""Texts with ``«name»`` places, filled from columns or from SQL expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pieces(template: str) -> list[str]:
    return re.split(r"«(\w+)»", template)


def fill(template: str, **columns: Column) -> Column:
    """The template as a column expression."""
    parts = _pieces(template)
    return F.concat(*[columns[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def fill_sql(template: str, **expressions: str) -> str:
    """The template as an SQL text expression."""
    parts = _pieces(template)
    pieces = [f"CAST({expressions[p]} AS VARCHAR)" if i % 2 else "'" + p.replace("'", "''") + "'" for i, p in enumerate(parts)]
    return "(" + " || ".join(pieces) + ")"
