"""The analytics on the golden fixture, read through the CSV and JSON sources."""

from __future__ import annotations

import pytest

from feedlens.plans import analytics as A
from feedlens.plans import sql as SQL
from feedlens.sources import read_dictionary, read_feed

from . import golden


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("golden"))
    feeds = [read_feed(spark, p) for p in golden.write_feeds(root)]
    dictionary = read_dictionary(spark, golden.write_dictionary(root))
    return feeds, dictionary


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_feeds_read_whole(inputs):
    feeds, _ = inputs
    assert [f.count() for f in feeds] == [3, 3, 4]
    v6 = [r for r in feeds[2].collect() if r.video_id == "v6"][0]
    assert v6.comment_count is None and v6.tags == "A,B"


def test_p1_classification_string_semantics(inputs):
    feeds, _ = inputs
    out = A.avg_comments_classification(feeds).collect()
    # fixed order and 3 rows; sum / count(*) (v6's NULL comments count in the divisor)
    assert [(r.Classification, r.VideosNumber, r.AverageComments) for r in out] == [
        ("neutral", 3, 4.0),
        ("good", 2, 5.5),
        ("bad", 2, 1.0),
    ]


def test_p1_empty_input_keeps_three_classes(inputs):
    feeds, _ = inputs
    empty = feeds[0].limit(0)
    out = A.avg_comments_classification(empty).collect()
    assert [(r.Classification, r.VideosNumber, r.AverageComments) for r in out] == [
        ("neutral", 0, None),
        ("good", 0, None),
        ("bad", 0, None),
    ]


def test_p2_classification_numeric_semantics(inputs):
    feeds, _ = inputs
    out = A.classification_nonempty(feeds)
    assert rows(out, "Classification", "VideosNumber", "AverageComments") == [
        ("bad", 2, 1.0),
        ("good", 2, 5.5),
        ("neutral", 2, 6.0),
    ]
    assert A.classification_nonempty(feeds[0].limit(0)).count() == 0


def test_p3_top_tags_by_name(inputs):
    feeds, dictionary = inputs
    expected = [
        ("Comedy", "a,b#2,#tag#1"),
        ("Entertainment", "#2,[none]#1,show#1"),
        ("Music", "rock#4,live#1,pop#1"),
    ]
    assert rows(A.top_tags_by_category_name(feeds, dictionary), "category", "top10_tags") == expected
    pre = A.top_tags_by_category_name(feeds, dictionary, pre_aggregate=True)
    assert rows(pre, "category", "top10_tags") == expected
    sql = SQL.top_tags_by_category_name(dictionary.sparkSession, feeds[0].unionByName(feeds[1]).unionByName(feeds[2]), dictionary)
    assert rows(sql, "category", "top10_tags") == expected


def test_p4_top_tags_by_id(inputs):
    feeds, dictionary = inputs
    out = A.top_tags_by_category_id(feeds, dictionary)
    assert rows(out, "category_id", "category", "top10_tags") == [
        ("10", "Music", "[rock#4, live#1, pop#1]"),
        ("23", "Comedy", "[#tag#1, a,b#1]"),
        ("24", "Entertainment", "[[none]#1, show#1]"),
        ("34", "Comedy", "[a,b#1]"),
        ("99", "", "[lost#1, pop#1]"),
    ]


def test_p5_count_first(inputs):
    feeds, dictionary = inputs
    out = A.top_tags_count_first(feeds, dictionary)
    assert rows(out, "category_id", "top10_tags") == [
        ("10", "[4->rock, 1->live, 1->pop]"),
        ("23", "[1->#tag, 1->a,b]"),
        ("24", "[1->[none], 1->show]"),
        ("34", "[1->a,b]"),
        ("99", "[1->lost, 1->pop]"),
    ]


def test_p6_p7_union(inputs):
    feeds, _ = inputs
    union = A.trending_union(feeds)
    assert sorted(r.video_id for r in union.collect()) == ["v1", "v1", "v2", "v3", "v4", "v5"]
    first = A.trending_union_first(feeds).collect()
    assert sorted(r.video_id for r in first) == ["v1", "v2", "v3", "v4", "v5"]
    v1 = [r for r in first if r.video_id == "v1"][0]
    assert v1.trending_date == "18.13.11" and v1.tags == "rock|pop"  # smallest row wins


def test_duplicate_dictionary_ids(spark, inputs):
    feeds, dictionary = inputs
    doubled = dictionary.unionByName(spark.createDataFrame([("10", "Musik")], "id string, category string"))
    # by name: the inner join fans out, so id 10's tags count under both names
    by_name = dict(rows(A.top_tags_by_category_name(feeds, doubled), "category", "top10_tags"))
    assert by_name["Musik"] == by_name["Music"] == "rock#4,live#1,pop#1"
    # by id: one deterministic name per id (the greatest)
    by_id = dict(rows(A.top_tags_by_category_id(feeds, doubled), "category_id", "category"))
    assert by_id["10"] == "Musik"
