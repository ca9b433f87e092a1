"""CSV feed scans.

``read_feed`` is the one entry point for the row-oriented feed files:

* names from an explicit all-string schema (no inference pass over the data,
  no type drift between files);
* ``header=True`` skips the first line of every file;
* ``mode='DROPMALFORMED'`` drops records with the wrong number of fields. It
  is combined with ``columnPruning=false``: with pruning on, Spark parses only
  the selected columns and cannot see that a record is too short or too long,
  so the kept rows would depend on the projection;
* quoting is RFC 4180 (``quote='"'``, ``escape='"'``): commas inside quotes
  are data and ``""`` inside a quoted cell is one quote character;
* ``multi_line=False`` keeps files splittable; a quoted line break then
  splits a record: pieces with the wrong number of fields are dropped, but a
  break in the last column leaves a first piece that looks whole and is kept
  with that cell cut. ``True`` reads such records whole, at the price of one
  task per file;
* an empty cell is NULL, a quoted empty cell (``""``) is the empty string.

Several paths go to one reader call, which plans them as one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FEED_SCHEMA


def read_feed(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema: T.StructType | None = FEED_SCHEMA,
    header: bool = True,
    sep: str = ",",
    mode: str = "DROPMALFORMED",
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = False,
    enforce_schema: bool = True,
) -> DataFrame:
    """Read one or more CSV feed files as all-string columns.

    With ``schema`` the columns are named by position. ``enforce_schema=False``
    checks the header line of every file against the schema names and fails
    on a mismatch instead. ``schema=None`` takes the names from the header
    (all columns strings, no type inference); read files whose column order
    differs one by one and combine them with ``union_feeds`` (by name).
    """
    reader = spark.read if schema is None else spark.read.schema(schema).option("enforceSchema", enforce_schema)
    reader = (
        reader.option("header", header)
        .option("sep", sep)
        .option("mode", mode)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("nullValue", "\0")  # no cell holds it: only an unquoted empty cell is NULL
        .option("columnPruning", mode != "DROPMALFORMED")
    )
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_feed_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema: T.StructType = FEED_SCHEMA,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: the rows ``read_feed`` keeps, and the lines it drops.

    ``kept`` has the columns of ``schema``. ``rejected`` has ``file`` (the path),
    ``line`` (the record as it stands in the file) and ``cells`` (what was
    parsed of it, by column). Every record is in one of them. The records of a
    scan are counted beside any action with ``operators.counted``.
    """
    corrupt = "_rejected_line"
    if corrupt in schema.names:
        raise ValueError(f"{corrupt!r} is the name of the reader's own column")
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True)]))
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("nullValue", "\0")
        .option("columnPruning", False)
        .csv(list(paths) if not isinstance(paths, str) else paths)
    )
    cells = [F.col(f"`{n}`") for n in schema.names]
    # Spark refuses a scan of the rejected line alone; this condition always holds and reads a cell beside it.
    parsed = parsed.where(F.length(F.coalesce(cells[0], F.lit(""))) >= 0)
    kept = parsed.where(F.col(corrupt).isNull()).select(*cells)
    bad = parsed.where(F.col(corrupt).isNotNull())
    return kept, bad.select(F.col("_metadata.file_path").alias("file"), F.col(corrupt).alias("line"), F.struct(*cells).alias("cells"))


def read_named_feed(
    spark: SparkSession,
    path: str,
    *,
    sep: str = ",",
    mode: str = "DROPMALFORMED",
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = False,
) -> DataFrame:
    """Read one CSV feed (a file, or a folder of files) as string columns named by its own header.

    The names come from the header of the first file; every further file is
    checked against them and fails the read when its header differs. Feeds of
    different column order are read one by one and meet in ``union_feeds``.
    """
    first = spark.read.option("header", True).option("sep", sep).option("quote", quote).option("escape", escape)
    names = first.option("multiLine", multi_line).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    return read_feed(
        spark, path, schema=schema, sep=sep, mode=mode, quote=quote, escape=escape, multi_line=multi_line, enforce_schema=False
    )


def read_positional(
    spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], *, sep: str = ","
) -> DataFrame:
    """Headerless text split naively on ``sep`` into named string fields by position.

    Quotes get no special meaning, a header line stays a data row, missing
    trailing fields are NULL and extra fields are ignored (``PERMISSIVE``).
    """
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    reader = (
        spark.read.schema(schema)
        .option("header", False)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
    )
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)
