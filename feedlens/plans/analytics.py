"""End-to-end analytics, each one lazy DataFrame plan.

========================  ==========================================================
function                  result
========================  ==========================================================
avg_comments_classification  3 rows (neutral, good, bad): count, sum/count(*) comments
classification_nonempty   non-empty classes under numeric semantics, parsable rows only
top_tags_by_category_name  per category name: ``tag#n,tag#n`` (10 most frequent)
top_tags_by_category_id   per category id, named last: ``[tag#n, ...]``
top_tags_count_first      per category id, named last: ``[n->tag, ...]``
trending_union            union of feeds, enabled and parsable rows only
trending_union_first      one row per video id of ``trending_union``
top_words_by_lang         per language: ``word#n,...`` over whole document texts
========================  ==========================================================

All take the feeds as one DataFrame or a list of DataFrames (bag union).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import (
    attach_name,
    class_rows_numeric,
    class_rows_string,
    dedupe_dictionary,
    explode_tags,
    first_per_key,
    fits_broadcast,
    keep_enabled,
    parsable_rows,
    render_top,
    summarize_by_class,
    summarize_fixed_classes,
    tag_counts,
    union_feeds,
)
from ..schema import FEED_COLUMNS, TOP_K
from ..session import stored


def avg_comments_classification(feeds) -> DataFrame:
    """Classification with string semantics; always the three classes."""
    rows = keep_enabled(union_feeds(feeds), semantics="string")
    return summarize_fixed_classes(class_rows_string(rows))


def classification_nonempty(feeds) -> DataFrame:
    """Classification with numeric semantics over rows whose used cells parse; non-empty classes."""
    rows = keep_enabled(union_feeds(feeds), semantics="not_true")
    rows = parsable_rows(rows, doubles=("likes", "dislikes"), ints=("comment_count",))
    return summarize_by_class(class_rows_numeric(rows))


def top_tags_by_category_name(
    feeds, dictionary: DataFrame, *, k: int = TOP_K, fmt: str = "hash", pre_aggregate: bool | None = None
) -> DataFrame:
    """Top tags per category *name* (ids sharing a name are merged; unknown ids dropped).

    Default plan: broadcast the (size-checked) dictionary into the scan
    stage, then a single shuffle on ``(category, tag)``. When the dictionary
    is too large to broadcast (or ``pre_aggregate=True``), tags are counted
    per ``(category_id, tag)`` first and the much smaller counts are joined
    and re-summed by name; repeated ids multiply the counts exactly as they
    multiply rows in the join-first plan. The counts are written first, as
    that join counts the rows of every id to find the hot ones.
    """
    feed = union_feeds(feeds).select("category_id", "tags")
    if pre_aggregate is None:
        pre_aggregate = not fits_broadcast(dictionary)
    if pre_aggregate:
        by_id = stored(tag_counts(explode_tags(feed, ["category_id"]), ["category_id"]), "tags-by-id")
        named = attach_name(by_id, dictionary, how="inner", broadcast=False)
        counts = named.groupBy("category", "tag").agg(F.sum("n").alias("n"))
    else:
        named = attach_name(feed, dictionary, how="inner", broadcast=True)
        counts = tag_counts(explode_tags(named, ["category"]), ["category"])
    return render_top(counts, ["category"], k, fmt=fmt, out="top10_tags")


def _top_tags_by_id(feeds, dictionary: DataFrame, k: int, fmt: str) -> DataFrame:
    feed = union_feeds(feeds).select("category_id", "tags")
    tags = explode_tags(feed, ["category_id"], keep_trailing_empty=False)
    lists = render_top(tag_counts(tags, ["category_id"]), ["category_id"], k, fmt=fmt)
    # Measured before the aggregate, which then runs once, in the join: one name an id is no more than that.
    # A list has one row an id, so no id is hot.
    named = attach_name(lists, dedupe_dictionary(dictionary), how="left", default="", broadcast=fits_broadcast(dictionary), hot_rows=None)
    return named.select("category_id", "category", "top10_tags")


def top_tags_by_category_id(feeds, dictionary: DataFrame, *, k: int = TOP_K) -> DataFrame:
    """Top tags per category *id*, named after the cut (unknown ids named ``''``)."""
    return _top_tags_by_id(feeds, dictionary, k, "bracket")


def top_tags_count_first(feeds, dictionary: DataFrame, *, k: int = TOP_K) -> DataFrame:
    """As ``top_tags_by_category_id`` with entries rendered ``n->tag``."""
    return _top_tags_by_id(feeds, dictionary, k, "count_first")


def trending_union(feeds) -> DataFrame:
    """Union of the feeds keeping enabled rows whose dislikes and comments parse as integers."""
    rows = keep_enabled(union_feeds(feeds), semantics="not_true")
    return parsable_rows(rows, ints=("dislikes", "comment_count")).select(*FEED_COLUMNS)


def trending_union_first(feeds) -> DataFrame:
    """``trending_union`` collapsed to one row per video id (deterministic pick)."""
    return first_per_key(trending_union(feeds), "video_id")


def top_words_by_lang(documents: DataFrame, *, k: int = TOP_K) -> DataFrame:
    """Top words per language over whole texts (split on single spaces, lower-cased)."""
    words = explode_tags(documents.select("lang", "text"), ["lang"], col="text", pattern=" ", drop_value=None)
    counts = tag_counts(words, ["lang"])
    return render_top(counts, ["lang"], k, fmt="hash", out="top10_words")
