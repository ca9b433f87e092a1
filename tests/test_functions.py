"""Column expressions against small in-Python references."""

from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from feedlens.functions import (
    classify,
    flags_all_false,
    flags_none_true,
    int_parsable,
    ratio,
    render_entries,
    split_drop_trailing,
    split_first,
    split_keep_empty,
    to_int,
    zero_guard_numeric,
    zero_guard_string,
)


def one_col(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def drop_trailing_reference(s: str) -> list[str]:
    """Split on '|' dropping trailing empty pieces; an input without '|' is returned whole."""
    if "|" not in s:
        return [s]
    parts = s.split("|")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_split_examples(spark):
    values = ["a|b||", "|a", "||", "", "abc", None, "Rock|Live|rock"]
    out = one_col(spark, values).select(
        "v", split_keep_empty("v").alias("keep"), split_drop_trailing("v").alias("drop")
    ).collect()
    got = {r.v: (r.keep, r.drop) for r in out}
    assert got["a|b||"] == (["a", "b", "", ""], ["a", "b"])
    assert got["|a"] == (["", "a"], ["", "a"])
    assert got["||"] == (["", "", ""], [])
    assert got[""] == ([""], [""])
    assert got["abc"] == (["abc"], ["abc"])
    assert got[None] == (None, None)


@settings(max_examples=5, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet="ab|#,", max_size=8), min_size=1, max_size=30))
def test_split_matches_reference(spark, values):
    out = one_col(spark, values).select(
        "v", split_keep_empty("v").alias("keep"), split_drop_trailing("v").alias("drop")
    ).collect()
    for r in out:
        assert r.keep == r.v.split("|")
        assert r.drop == drop_trailing_reference(r.v)


def test_zero_guards_and_ratio(spark):
    df = spark.createDataFrame(
        [("60", "10"), ("7", "0"), ("0", "0"), ("5", "0.0"), ("5", "00"), ("50", "n/a"), ("NaN", "1"), ("x", "1")],
        "likes string, dislikes string",
    )
    rows = df.select(
        zero_guard_string("dislikes").alias("gs"),
        zero_guard_numeric("dislikes").alias("gn"),
        ratio("likes", zero_guard_string("dislikes")).alias("rs"),
        ratio("likes", zero_guard_numeric("dislikes")).alias("rn"),
    ).collect()
    assert [r.gs for r in rows] == ["10", "1", "1", "0.0", "00", "n/a", "1", "1"]
    assert [r.gn for r in rows] == [10.0, 1.0, 1.0, 1.0, 1.0, None, 1.0, 1.0]
    # the string guard misses '0.0' and '00': division by zero gives NULL
    assert [r.rs for r in rows] == [6.0, 7.0, 0.0, None, None, None, None, None]
    assert [r.rn for r in rows] == [6.0, 7.0, 0.0, 5.0, 5.0, None, None, None]


def test_classify_boundaries(spark):
    values = [3.999, 4.0, 5.0, 6.0, 6.0001, None, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "r double")
    got = [r.c for r in df.select(classify("r").alias("c")).collect()]
    assert got == ["bad", "neutral", "neutral", "neutral", "good", None, "good", "bad"]


def test_flag_semantics(spark):
    df = spark.createDataFrame(
        [("False", "False"), ("True", "False"), ("False", None), ("false", "False"), (None, None)], "a string, b string"
    )
    rows = df.select(flags_all_false("a", "b").alias("f"), flags_none_true("a", "b").alias("n")).collect()
    assert [r.f for r in rows] == [True, False, False, False, False]
    assert [r.n for r in rows] == [True, False, True, True, True]


def test_strict_int_parse(spark):
    values = ["12", "+5", "-3", "12.0", " 5", "2147483647", "2147483648", "", None, "1e3", "9223372036854775807", "9223372036854775808"]
    rows = one_col(spark, values).select(to_int("v").alias("i"), int_parsable("v").alias("ok")).collect()
    assert [r.i for r in rows] == [12, 5, -3, None, None, 2147483647, 2147483648, None, None, None, 2**63 - 1, None]
    assert [r.ok for r in rows] == [True, True, True, False, False, True, True, False, False, False, True, False]


def test_split_first(spark):
    head, rest = split_first("v", "#")
    rows = one_col(spark, ["Brand#2", "a#b#c", "none", None]).select(head.alias("h"), rest.alias("r")).collect()
    assert [(r.h, r.r) for r in rows] == [("Brand", "2"), ("a", "b#c"), ("none", None), (None, None)]


def test_renderings(spark):
    df = spark.createDataFrame(
        [([(4, "rock"), (1, "live")],)], "e array<struct<n: bigint, tag: string>>"
    )
    r = df.select(
        render_entries("e", "hash").alias("h"),
        render_entries("e", "bracket").alias("b"),
        render_entries("e", "count_first").alias("c"),
    ).first()
    assert (r.h, r.b, r.c) == ("rock#4,live#1", "[rock#4, live#1]", "[4->rock, 1->live]")


def test_ratio_nan_is_unclassified(spark):
    df = spark.createDataFrame([("Infinity", "Infinity"), ("NaN", "2")], "likes string, dislikes string")
    rows = df.select(ratio("likes", "dislikes").alias("r")).collect()
    assert all(r.r is None or not math.isnan(r.r) for r in rows)
    assert [r.r for r in rows] == [None, None]


def test_lower_after_marker_filter(spark):
    from feedlens.operators import explode_tags

    df = spark.createDataFrame([("1", "[none]|[NONE]|A")], "category_id string, tags string")
    assert sorted(r.tag for r in explode_tags(df, ["category_id"]).collect()) == ["[none]", "a"]
