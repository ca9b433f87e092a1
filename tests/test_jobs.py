"""The batch jobs over files: golden fixture in, CSV (and tables) out."""

from __future__ import annotations

import glob
import os
import uuid

import pytest
from pyspark.sql.utils import AnalysisException

from feedlens import jobs
from feedlens.schema import CLASSIFICATION_SCHEMA, FEED_SCHEMA, all_string_schema
from feedlens.sinks import write_csv
from feedlens.sources import read_feed

from . import golden


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    return golden.write_feeds(root), golden.write_dictionary(root), root


def test_classify_job(spark, files, capsys):
    feeds, _, root = files
    out = os.path.join(root, "classification")
    table = f"classification_{uuid.uuid4().hex[:8]}"
    jobs.run(["classify", "--feeds", *feeds, "--out", out, "--table", table], spark=spark)
    shown = capsys.readouterr().out
    assert f"classify: 3 rows written to {table}" in shown and "neutral" in shown
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) == 1
    rows = [tuple(r) for r in read_feed(spark, out, schema=CLASSIFICATION_SCHEMA).collect()]
    assert rows == [("neutral", 3, 4.0), ("good", 2, 5.5), ("bad", 2, 1.0)]
    assert spark.table(table).count() == 3


def test_top_tags_job_by_id_errorifexists(spark, files):
    feeds, dictionary, root = files
    out = os.path.join(root, "by-id")
    table = f"tags_{uuid.uuid4().hex[:8]}"
    args = ["top-tags", "--feeds", *feeds, "--dictionary", dictionary, "--out", out, "--by", "id",
            "--render", "count_first", "--mode", "errorifexists", "--table", table]
    jobs.run(args, spark=spark)
    rows = {r.category_id: r.top10_tags
            for r in read_feed(spark, out, schema=all_string_schema(["category_id", "category", "top10_tags"])).collect()}
    assert rows["10"] == "[4->rock, 1->live, 1->pop]"
    with pytest.raises(AnalysisException):
        jobs.run(args, spark=spark)


def test_union_job_first_per_key(spark, files):
    feeds, _, root = files
    out = os.path.join(root, "union")
    jobs.run(["union", "--feeds", *feeds, "--out", out, "--first-per-key"], spark=spark)
    ids = sorted(r.video_id for r in read_feed(spark, out, schema=FEED_SCHEMA).collect())
    assert ids == ["v1", "v2", "v3", "v4", "v5"]


def test_union_job_with_table_reads_back_written_files(spark, files):
    feeds, _, root = files
    out = os.path.join(root, "union-table")
    table = f"union_{uuid.uuid4().hex[:8]}"
    jobs.run(["union", "--feeds", *feeds, "--out", out, "--table", table], spark=spark)
    assert spark.table(table).count() == 6
    assert sorted(spark.table(table).columns) == sorted(FEED_SCHEMA.fieldNames())


def test_top_tags_job_key_value_lines(spark, files):
    feeds, dictionary, root = files
    out = os.path.join(root, "kv")
    jobs.run(["top-tags", "--feeds", *feeds, "--dictionary", dictionary, "--out", out, "--by", "id",
              "--format", "kv", "--no-show"], spark=spark)
    lines = sorted(open(p).read() for p in glob.glob(os.path.join(out, "part-*")))
    text = "".join(lines).splitlines()
    assert "Music\t[rock#4, live#1, pop#1]" in text
    assert "\t[lost#1, pop#1]" in text  # unknown id: empty name
    assert len(text) == 5


def test_classify_and_union_key_value_lines(spark, files):
    feeds, _, root = files
    lines = {}
    for job in ("classify", "union"):
        out = os.path.join(root, f"kv-{job}")
        jobs.run([job, "--feeds", *feeds, "--out", out, "--format", "kv", "--no-show"], spark=spark)
        lines[job] = [line for p in glob.glob(os.path.join(out, "part-*")) for line in open(p).read().splitlines()]
    assert sorted(lines["classify"]) == [
        "bad videos:2 - average comments: \t1.0", "good videos:2 - average comments: \t5.5", "neutral videos:3 - average comments: \t4.0"
    ]
    assert len(lines["union"]) == 6 and all(x.split("\t")[1].startswith(x.split("\t")[0] + ",") for x in lines["union"])


def test_positional_reader(spark, files):
    feeds, dictionary, root = files
    out = os.path.join(root, "positional")
    result = jobs.run(["top-tags", "--feeds", *feeds, "--dictionary", dictionary, "--out", out,
                       "--reader", "positional", "--no-show"], spark=spark)
    got = {r.category: r.top10_tags for r in result.collect()}
    # rows without quoted commas read as with the CSV reader; the header rows carry no known id
    assert got["Music"] == "rock#4,live#1,pop#1"
    assert "category" not in got


def _feed_rows(spark, columns, **cells):
    base = dict.fromkeys(FEED_SCHEMA.fieldNames(), "x") | {
        "video_id": "v", "likes": "100", "dislikes": "1", "comment_count": "4", "views": "3000000000",
        "comments_disabled": "False", "ratings_disabled": "False",
    } | cells
    return spark.createDataFrame([tuple(base[c] for c in columns)], all_string_schema(list(columns)))


def test_names_come_from_each_header(spark, tmp_dir):
    names = FEED_SCHEMA.fieldNames()
    swapped = [{"likes": "dislikes", "dislikes": "likes"}.get(n, n) for n in names]
    for folder, columns in (("a", names), ("b", swapped)):
        write_csv(_feed_rows(spark, columns), os.path.join(tmp_dir, folder))
    rows = jobs.classify(spark, [os.path.join(tmp_dir, f) for f in "ab"]).collect()
    assert {r.Classification: r.VideosNumber for r in rows} == {"neutral": 0, "good": 2, "bad": 0}


def test_union_job_table_keeps_line_breaks_and_large_counts(spark, tmp_dir):
    feed, out, table = os.path.join(tmp_dir, "feed"), os.path.join(tmp_dir, "out"), f"union_{uuid.uuid4().hex[:8]}"
    cells = {"title": " two\nlines ", "description": "line1\nline2", "tags": "", "comment_count": "3000000000"}
    rows = _feed_rows(spark, FEED_SCHEMA.fieldNames(), **cells).union(_feed_rows(spark, FEED_SCHEMA.fieldNames()))
    write_csv(rows, feed)
    jobs.run(["union", "--feeds", feed, "--out", out, "--multi-line", "--table", table], spark=spark)
    want = sorted(map(tuple, rows.collect()))
    assert sorted(map(tuple, spark.table(table).select(*rows.columns).collect())) == want
    assert sorted(map(tuple, read_feed(spark, out, multi_line=True).select(*rows.columns).collect())) == want
    spark.sql(f"DROP TABLE {table}")
