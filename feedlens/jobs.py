"""Batch jobs over real inputs: CSV feeds (one per country) and a JSON-lines dictionary.

Each job reads its inputs with the feed / dictionary sources, runs one
analytic and writes its result: CSV with a header (one file for the bounded
results), and optionally a managed table. Run them with
``python -m feedlens <job> ...`` or through ``spark-submit``.

========================  =====================================================
job                       result
========================  =====================================================
classify                  P1 (``--semantics string``) or P2 (``numeric``)
top-tags                  P3 (``--by name``) or P4 / P5 (``--by id``,
                          ``--render bracket|count_first``)
union                     P6, or P7 with ``--first-per-key``
========================  =====================================================
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import counted
from .plans import analytics as A
from .sinks import create_table_as, write_csv, write_key_value, write_table
from .schema import AVERAGE_COMMENTS, CLASSIFICATION, FEED_COLUMNS, VIDEOS_NUMBER
from .sources import read_dictionary, read_feed, read_named_feed, read_positional


def _frames(spark: SparkSession, feeds: Sequence[str], read_options: dict | None) -> list[DataFrame]:
    opts = dict(read_options or {})
    if opts.pop("reader", "csv") == "positional":
        # plain text split on commas by position; the header line stays a data row
        return [read_positional(spark, p, FEED_COLUMNS) for p in feeds]
    return [read_named_feed(spark, p, **opts) for p in feeds]


def classify(
    spark: SparkSession, feeds: Sequence[str], *, semantics: str = "string", read_options: dict | None = None
) -> DataFrame:
    frames = _frames(spark, feeds, read_options)
    if semantics == "string":
        return A.avg_comments_classification(frames)
    if semantics == "numeric":
        return A.classification_nonempty(frames)
    raise ValueError(f"unknown semantics {semantics!r}")


def top_tags(
    spark: SparkSession,
    feeds: Sequence[str],
    dictionary: str,
    *,
    by: str = "name",
    render: str = "bracket",
    k: int = 10,
    read_options: dict | None = None,
) -> DataFrame:
    frames = _frames(spark, feeds, read_options)
    names = read_dictionary(spark, dictionary)
    if by == "name":
        return A.top_tags_by_category_name(frames, names, k=k)
    if by == "id":
        if render == "count_first":
            return A.top_tags_count_first(frames, names, k=k)
        return A.top_tags_by_category_id(frames, names, k=k)
    raise ValueError(f"unknown grouping {by!r}")


def union(
    spark: SparkSession, feeds: Sequence[str], *, first_per_key: bool = False, read_options: dict | None = None
) -> DataFrame:
    frames = _frames(spark, feeds, read_options)
    return A.trending_union_first(frames) if first_per_key else A.trending_union(frames)


def _key_value(result: DataFrame, job: str) -> DataFrame:
    """``key, value`` of a result's text lines: class and average, category and list, or video id and its CSV record."""
    if job == "classify":
        key = F.concat(F.col(CLASSIFICATION), F.lit(" videos:"), F.col(VIDEOS_NUMBER).cast("string"), F.lit(" - average comments: "))
        return result.select(key.alias("key"), F.col(AVERAGE_COMMENTS).alias("value"))
    if job == "top-tags":
        return result.select(F.col("category").alias("key"), F.col("top10_tags").alias("value"))
    record = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return result.select(F.col("video_id").alias("key"), F.to_csv(F.struct(*FEED_COLUMNS), record).alias("value"))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="feedlens", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("classify", "top-tags", "union"):
        s = sub.add_parser(name)
        s.add_argument("--feeds", nargs="+", required=True, help="CSV feed files or folders")
        s.add_argument("--out", required=True, help="output folder (CSV with header)")
        s.add_argument("--mode", default="overwrite", choices=("overwrite", "errorifexists"))
        s.add_argument("--table", help="also save the result as this table")
        s.add_argument("--no-show", dest="show", action="store_false", help="do not print bounded results")
        s.add_argument("--single-file", action="store_true", help="one output file (always so for classify)")
        s.add_argument("--multi-line", action="store_true", help="quoted cells may contain line breaks")
        s.add_argument("--format", default="csv", choices=("csv", "kv"), help="kv: one 'key<TAB>value' text line per row")
        s.add_argument("--escape", default='"', help="escape character inside quoted cells (default: \")")
        s.add_argument(
            "--reader",
            default="csv",
            choices=("csv", "positional"),
            help="positional: split lines on commas by position, no quoting, header line kept as data",
        )
        if name == "classify":
            s.add_argument("--semantics", default="string", choices=("string", "numeric"))
        if name == "top-tags":
            s.add_argument("--dictionary", required=True, help="JSON-lines dictionary {id, category}")
            s.add_argument("--by", default="name", choices=("name", "id"))
            s.add_argument("--render", default="bracket", choices=("bracket", "count_first"))
            s.add_argument("--k", type=int, default=10)
        if name == "union":
            s.add_argument("--first-per-key", action="store_true")
    return p


def run(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Parse arguments, run the job, write its outputs; returns the result DataFrame."""
    args = _parser().parse_args(argv)
    if spark is None:
        from .session import get_session

        spark = get_session(app=f"feedlens-{args.job}")
    opts = {"multi_line": args.multi_line, "escape": args.escape, "reader": args.reader}
    if args.job == "classify":
        result, bounded = classify(spark, args.feeds, semantics=args.semantics, read_options=opts), True
    elif args.job == "top-tags":
        result = top_tags(
            spark, args.feeds, args.dictionary, by=args.by, render=args.render, k=args.k, read_options=opts
        )
        bounded = False  # one row per category of the feed, known or not
    else:
        result = union(spark, args.feeds, first_per_key=args.first_per_key, read_options=opts)
        bounded = False
    # The plan runs once, in its first write; that write also counts its rows.
    counting, rows = counted(result)
    source = counting
    if args.table:
        # The table first, then the text files from it: the table never depends on what text can hold.
        if args.mode == "errorifexists":
            create_table_as(counting, args.table)
        else:
            write_table(counting, args.table)
        source = spark.table(args.table)
    single = bounded or args.single_file
    if args.format == "kv":
        lines = _key_value(source, args.job)
        write_key_value(lines.repartition(1) if single else lines, args.out, "key", "value", mode=args.mode)
    else:
        write_csv(source, args.out, mode=args.mode, single_file=single)
    print(f"{args.job}: {rows.get['rows']} rows written to {args.table or args.out}")
    if args.job != "union" and args.show:
        # What was written is read back: showing it does not run the plan again.
        written = source if args.table else spark.read.text(args.out) if args.format == "kv" else read_feed(spark, args.out, schema=None)
        written.show(truncate=False)
    return result
