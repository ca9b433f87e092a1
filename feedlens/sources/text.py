"""Line-oriented text scans: key/value lines split at the first tab."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_key_value(
    spark: SparkSession, paths: str | Sequence[str], *, sep: str = "\t", key: str = "key", value: str = "value", escaped: bool = False
) -> DataFrame:
    """One row per line: ``key`` up to the first ``sep``, ``value`` the rest.

    A line without the separator is all key, with an empty value; later
    separators stay inside the value. ``escaped`` undoes the escapes of
    ``write_key_value``.
    """
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    parts = F.split(F.col("value"), re.escape(sep), 2)  # a literal separator, not a pattern
    cells = F.get(parts, 0), F.coalesce(F.get(parts, 1), F.lit(""))
    if escaped:
        cells = tuple(_plain(c, sep) for c in cells)
    return lines.select(cells[0].alias(key), cells[1].alias(value))


def _plain(cell: Column, sep: str) -> Column:
    """A cell without its escapes: pieces between escaped backslashes hold the other escapes."""

    def piece(c: Column) -> Column:
        for mark, plain in (("\\n", "\n"), ("\\r", "\r"), ("\\s", sep)):
            c = F.replace(c, F.lit(mark), F.lit(plain))
        return c

    joined = F.array_join(F.transform(F.split(cell, re.escape("\\\\")), piece), "\\")
    return F.when(cell != F.lit("\\N"), joined)
