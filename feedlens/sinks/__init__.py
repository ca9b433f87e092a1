"""Sinks: CSV files, managed tables, CTAS, key/value text lines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    header: bool = True,
    single_file: bool = False,
    sep: str = ",",
    file_records: int = 0,
    options: dict[str, str] | None = None,
) -> None:
    """Write CSV with RFC 4180 quoting (``escape='"'``), readable by ``read_feed``.

    ``single_file`` moves the rows to one writer task first; use it only for
    bounded results (a summary, a top-k list), never for a fact table. It is
    a ``repartition(1)``, not a ``coalesce(1)``: a coalesce is narrow and
    would pull the stage that computes the result (e.g. the final top-k
    stage) into that one task as well, while the repartition keeps that
    stage parallel and shuffles only the finished rows.
    ``mode='errorifexists'`` fails when the path exists. ``file_records`` bounds the
    rows of a file (0: no bound), as one task reads a compressed file. ``options`` are further
    options of the writer, such as ``compression``.
    """
    out = df.repartition(1) if single_file else df
    (
        out.write.mode(mode)
        .option("header", header)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", file_records)
        .options(**(options or {}))
        .csv(path)
    )


def write_table(df: DataFrame, name: str, *, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Save as a managed table (replaced with ``mode='overwrite'``)."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def create_table_as(df: DataFrame, name: str, *, fmt: str = "parquet") -> None:
    """``CREATE TABLE name AS SELECT``: fails when the table already exists."""
    view = f"_ctas_src_{abs(hash(name))}"
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(f"CREATE TABLE {name} USING {fmt} AS SELECT * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def write_key_value(df: DataFrame, path: str, key: str, value: str, *, sep: str = "\t", mode: str = "overwrite") -> None:
    """One text line per row: ``key<sep>value`` (values rendered as text).

    Backslash, line feed and carriage return are written as ``\\\\``, ``\\n`` and
    ``\\r``, a ``sep`` inside the key as ``\\s`` and NULL as ``\\N``, so that
    every row is one line that ``read_key_value(..., escaped=True)`` gives back.
    """

    def cell(c: str, extra: tuple = ()):
        out = F.col(c).cast("string")
        for plain, put in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), *extra):
            out = F.replace(out, F.lit(plain), F.lit(put))
        return F.coalesce(out, F.lit("\\N"))

    line = F.concat(cell(key, ((sep, "\\s"),)), F.lit(sep), cell(value))
    df.select(line.alias("value")).write.mode(mode).text(path)


def publish(df: DataFrame, root: str, *, fmt: str = "parquet") -> str:
    """Write ``df`` as a new version under ``root`` and make it the current one; returns its folder.

    The rows go to a folder of their own; only when they are all there is the
    file ``root/current``, which names that folder, replaced by an atomic rename. Until then, and after a
    failure, readers see the version before, whole. Earlier versions stay where they are.
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{root}/{version}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    fresh, current = hadoop.Path(f"{root}/.{version}"), hadoop.Path(f"{root}/current")
    out = fresh.getFileSystem(conf).create(fresh, True)
    out.write(bytearray(version.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fresh.getFileSystem(conf).getUri(), conf).rename(fresh, current, how)
    return f"{root}/{version}"


def read_published(spark: SparkSession, root: str, *, fmt: str = "parquet") -> DataFrame:
    """The current version under ``root``."""
    root = root.rstrip("/")
    version = spark.read.text(f"{root}/current").first()["value"]
    return spark.read.format(fmt).load(f"{root}/{version}")


__all__ = ["create_table_as", "publish", "read_published", "write_csv", "write_key_value", "write_table"]
