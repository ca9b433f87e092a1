"""Small string helpers: limited split, substring test, JSON field access."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import col_of


def split_first(c, sep: str) -> tuple[Column, Column]:
    """Split at the first occurrence of a literal separator.

    Returns ``(head, rest)``; ``rest`` is NULL when the separator is absent
    and keeps any later separators.
    """
    parts = F.split(col_of(c), re.escape(sep), 2)
    return F.get(parts, 0), F.get(parts, 1)


def contains(c, needle: str) -> Column:
    """Literal substring test (NULL for a NULL input)."""
    return F.contains(col_of(c), F.lit(needle))


def json_field(c, name: str) -> Column:
    """Text of a top-level JSON field (NULL if missing or the text is not JSON)."""
    return F.get_json_object(col_of(c), f"$.{name}")
