"""JSON-lines scans (the category dictionary)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import DICTIONARY_SCHEMA


def read_dictionary(
    spark: SparkSession, paths: str | Sequence[str], *, schema: T.StructType = DICTIONARY_SCHEMA
) -> DataFrame:
    """``{"id": "1", "category": "..."}`` per line, as ``id string, category string``.

    The schema is explicit: no inference pass and no ``_corrupt_record``
    column appearing when a bad line exists (bad lines read as NULLs).
    """
    return spark.read.schema(schema).json(list(paths) if not isinstance(paths, str) else paths)
