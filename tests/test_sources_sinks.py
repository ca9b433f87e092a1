"""Sources (CSV traps, positional text, key/value, JSON) and sinks (modes, single file, tables)."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from feedlens import sinks
from feedlens.schema import CLASSIFICATION_SCHEMA, all_string_schema
from feedlens.sources import read_dictionary, read_feed, read_key_value, read_positional

SAMPLE = (
    "id,cat,tags,likes,flag\n"
    "1,10,a|b,5,False\n"
    '2,10,"x|""q r""|""z""",6,False\n'
    "3,24,,7,True\n"
    "4,24,c,8,False\n"
    "5,23,d\n"  # 3 fields
    "6,23,e,9,False,extra\n"  # 6 fields
    '7,23,"line\nbreak",10,False\n'  # quoted line break
    "8,1,f,11,False\n"
)
SCHEMA = all_string_schema(["id", "cat", "tags", "likes", "flag"])


@pytest.fixture()
def sample(tmp_dir):
    p = os.path.join(tmp_dir, "sample.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(SAMPLE)
    return p


def test_dropmalformed_independent_of_projection(spark, sample):
    df = read_feed(spark, sample, schema=SCHEMA)
    full = sorted(r.id for r in df.collect())
    assert full == ["1", "2", "3", "4", "8"]
    assert df.count() == 5
    assert sorted(r.id for r in df.select("id", "likes").collect()) == full


def test_quotes_empty_cells_and_line_breaks(spark, sample):
    by_id = {r.id: r for r in read_feed(spark, sample, schema=SCHEMA).collect()}
    assert by_id["2"].tags == 'x|"q r"|"z"'
    assert by_id["3"].tags is None
    multi = {r.id: r for r in read_feed(spark, sample, schema=SCHEMA, multi_line=True).collect()}
    assert multi["7"].tags == "line\nbreak"
    assert sorted(multi) == ["1", "2", "3", "4", "7", "8"]


def test_backslash_escape_keeps_quotes_verbatim(spark, sample):
    by_id = {r.id: r for r in read_feed(spark, sample, schema=SCHEMA, escape="\\").collect()}
    assert by_id["2"].tags == '"x|""q r""|""z"""'


def test_multiple_paths_one_reader(spark, tmp_dir):
    paths = []
    for i in range(3):
        p = os.path.join(tmp_dir, f"f{i}.csv")
        with open(p, "w") as f:
            f.write("id,cat,tags,likes,flag\n" + "".join(f"{i}{j},1,t,1,False\n" for j in range(4)))
        paths.append(p)
    assert read_feed(spark, paths, schema=SCHEMA).count() == 12


def test_positional_text_keeps_header_and_splits_naively(spark, tmp_dir):
    p = os.path.join(tmp_dir, "plain.txt")
    with open(p, "w") as f:
        f.write('a,b,c\n1,"x,y",3\n4,5\n')
    rows = [tuple(r) for r in read_positional(spark, p, ["f1", "f2", "f3"]).collect()]
    assert rows == [("a", "b", "c"), ("1", '"x', 'y"'), ("4", "5", None)]


def test_key_value_split_at_first_tab(spark, tmp_dir):
    p = os.path.join(tmp_dir, "kv.txt")
    with open(p, "w") as f:
        f.write("10\trock#4\n23\ta\tb\nlonely\n")
    rows = [tuple(r) for r in read_key_value(spark, p).collect()]
    assert rows == [("10", "rock#4"), ("23", "a\tb"), ("lonely", "")]


def test_json_dictionary_explicit_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dict.json")
    with open(p, "w") as f:
        f.write('{"id":"1","category":"Film & Animation"}\nnot json\n{"id":"10","category":"Music"}\n')
    df = read_dictionary(spark, p)
    assert df.columns == ["id", "category"]
    assert sorted((r.id or "", r.category or "") for r in df.collect()) == [
        ("", ""),
        ("1", "Film & Animation"),
        ("10", "Music"),
    ]


def _result(spark):
    return spark.createDataFrame(
        [("neutral", 3, 4.0), ("good", 2, 5.5), ("bad", 0, None)], CLASSIFICATION_SCHEMA
    )


def test_csv_single_file_overwrite_roundtrip(spark, tmp_dir):
    out = os.path.join(tmp_dir, "classification")
    df = _result(spark)
    sinks.write_csv(df, out, single_file=True)
    sinks.write_csv(df, out, single_file=True)
    assert len(glob.glob(os.path.join(out, "part-*.csv"))) == 1
    back = read_feed(spark, out, schema=CLASSIFICATION_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_csv_errorifexists(spark, tmp_dir):
    out = os.path.join(tmp_dir, "once")
    sinks.write_csv(_result(spark), out, mode="errorifexists")
    with pytest.raises(AnalysisException):
        sinks.write_csv(_result(spark), out, mode="errorifexists")


def test_tables_overwrite_and_ctas(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex[:8]}"
    sinks.write_table(_result(spark), name)
    sinks.write_table(_result(spark).limit(1), name)
    assert spark.table(name).count() == 1
    ctas = f"c_{uuid.uuid4().hex[:8]}"
    sinks.create_table_as(_result(spark), ctas)
    assert spark.table(ctas).count() == 3
    with pytest.raises(AnalysisException):
        sinks.create_table_as(_result(spark), ctas)


def test_key_value_sink_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("rock", 4), ("pop", 1)], "tag string, n bigint")
    out = os.path.join(tmp_dir, "kv")
    sinks.write_key_value(df, out, "tag", "n")
    back = read_key_value(spark, out, key="tag", value="n")
    assert sorted(tuple(r) for r in back.collect()) == [("pop", "1"), ("rock", "4")]


def test_header_names_and_union_by_name(spark, tmp_dir):
    from feedlens.operators import union_feeds

    a = os.path.join(tmp_dir, "a.csv")
    b = os.path.join(tmp_dir, "b.csv")
    with open(a, "w") as f:
        f.write("video_id,likes,tags\nv1,5,x|y\n")
    with open(b, "w") as f:
        f.write("tags,video_id,likes\nz,v2,7\n")
    frames = [read_feed(spark, p, schema=None) for p in (a, b)]
    rows = sorted(tuple(r) for r in union_feeds(frames).select("video_id", "likes", "tags").collect())
    assert rows == [("v1", "5", "x|y"), ("v2", "7", "z")]
    # positional union would mix the columns up
    mixed = sorted(tuple(r) for r in union_feeds(frames, by_name=False).collect())
    assert ("z", "v2", "7") in mixed


def test_enforce_schema_rejects_reordered_header(spark, tmp_dir):
    p = os.path.join(tmp_dir, "reordered.csv")
    with open(p, "w") as f:
        f.write("cat,id,tags,likes,flag\n10,1,a,5,False\n")
    with pytest.raises(Exception):
        read_feed(spark, p, schema=SCHEMA, enforce_schema=False).collect()
    assert read_feed(spark, p, schema=SCHEMA).first().id == "10"  # positional by default


def test_union_with_missing_columns(spark):
    from feedlens.operators import union_feeds

    a = spark.createDataFrame([("v1", "x")], "video_id string, tags string")
    b = spark.createDataFrame([("v2",)], "video_id string")
    with pytest.raises(Exception):
        union_feeds([a, b]).collect()
    rows = sorted(tuple(r) for r in union_feeds([a, b], allow_missing_columns=True).collect())
    assert rows == [("v1", "x"), ("v2", None)]


def test_key_value_literal_separator(spark, tmp_dir):
    p = os.path.join(tmp_dir, "pipes.txt")
    with open(p, "w") as f:
        f.write("10|rock|4\n")
    rows = [tuple(r) for r in read_key_value(spark, p, sep="|").collect()]
    assert rows == [("10", "rock|4")]


def test_csv_roundtrip_keeps_cells(spark, tmp_dir):
    rows = [("  lead", "trail  ", ""), ("", None, " "), (None, 'a "q", b', "\ttab\t"), ("line\nbreak", "x", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    out = os.path.join(tmp_dir, "cells")
    sinks.write_csv(df, out)
    back = read_feed(spark, out, schema=df.schema, multi_line=True)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))


def test_key_value_roundtrip_keeps_every_row(spark, tmp_dir):
    rows = [(None, "v1"), ("", ""), ("a\tb", "c\td"), ("x\ny", "z\r\n"), ("\\N", "\\n \\\\ \\s"), ("k", None)]
    out = os.path.join(tmp_dir, "escaped")
    sinks.write_key_value(spark.createDataFrame(rows, "k string, v string"), out, "k", "v")
    back = read_key_value(spark, out, escaped=True)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))


def test_rejected_lines_and_kept_rows_are_all_lines(spark, tmp_dir):
    from feedlens.operators import counted
    from feedlens.sources import read_feed, read_feed_checked

    lines = ["id,cat,tags", '1,a,"x,y"', "2,b", "3,c,z,extra", '4,"d ""q""",', ",,", "5,e,w"]
    path = f"{tmp_dir}/feed.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    schema = all_string_schema(["id", "cat", "tags"])
    kept, rejected = read_feed_checked(spark, path, schema=schema)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, read_feed(spark, path, schema=schema).collect()))
    assert sorted(r.line for r in rejected.collect()) == ["2,b", "3,c,z,extra"]
    assert {r.cells.id for r in rejected.collect()} == {"2", "3"} and rejected.select("file").distinct().count() == 1
    assert kept.count() + rejected.count() == len(lines) - 1
    assert [r.id for r in kept.select("id").where("id = '5'").collect()] == ["5"]  # a pruned read keeps the same rows
    whole, seen = counted(kept, with_tags=F.count("tags"))
    assert len(whole.collect()) == 4 and seen.get == {"rows": 4, "with_tags": 2}


def test_publish_switches_whole_versions(spark, tmp_dir):
    from feedlens.sinks import publish, read_published

    root = f"{tmp_dir}/published"
    one, two = spark.range(3), spark.range(10, 15)
    first = publish(one, root)
    assert sorted(r.id for r in read_published(spark, root).collect()) == [0, 1, 2]
    reader = read_published(spark, root)
    publish(two, root)
    assert sorted(r.id for r in read_published(spark, root).collect()) == [10, 11, 12, 13, 14]
    assert sorted(r.id for r in reader.collect()) == [0, 1, 2]  # a reader of the earlier version is not disturbed
    with pytest.raises(Exception, match="stopped"):
        publish(spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stopped"))).otherwise(F.col("id").cast("string")).alias("id")), root)
    assert sorted(r.id for r in read_published(spark, root).collect()) == [10, 11, 12, 13, 14]
    assert sorted(r.id for r in spark.read.parquet(first).collect()) == [0, 1, 2]
