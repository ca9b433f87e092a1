"""Shared helpers of the operators: Arrow text access, lineage cuts, query columns.

Texts travel as Arrow batches; a batch is worked through in slices of at most
``SLICE_BYTES`` of text (or one row, if longer), so the memory of a task
follows the longest single text and not the batch.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import scratch_path

SLICE_BYTES = 2 << 20

# Words of the text contracts, on UTF-8 bytes whose A-Z are lower-cased: the
# digits, a-z and every byte of a code point above 127.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Consecutive row ranges ``(i, j)`` of at most ``limit`` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def texts(column: pa.Array):
    """The UTF-8 bytes of every row, in order; a null counts as empty text."""
    raw, off = utf8(column)
    view = memoryview(raw)
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        yield bytes(view[a:b])


def words(text: bytes) -> list[bytes]:
    """Words of a text under the word rule of the contracts (A-Z lower-cased)."""
    return WORD.findall(text.lower())


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """``names``, each with as many underscores behind it as it takes to be no column of ``df`` (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
