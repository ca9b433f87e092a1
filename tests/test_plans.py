"""Physical-plan properties: pruning, pushdown, partial aggregation, bounded broadcasts, no Python."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from feedlens.operators import attach_name, first_per_key
from feedlens.plans import catalog
from feedlens.schema import FEED_COLUMNS
from feedlens.sources import testbed

from .conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_of(df, mode="simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_top_tags_plan(spark):
    df = catalog.queries()["top_tags_by_category_name"](spark, SF_SMALL)
    p = plan_of(df)
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p  # top-k cut before the shuffle
    assert "BroadcastHashJoin" in p
    assert "partial_count" in p  # combiner before the (category, tag) shuffle
    # the feed scan reads only the columns it needs
    li_scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_shipdate" not in li_scan and "l_returnflag" not in li_scan


def test_classification_plan_is_one_global_aggregate(spark):
    df = catalog.queries()["avg_comments_classification"](spark, SF_SMALL)
    p = plan_of(df)
    assert "Exchange SinglePartition" in p
    assert "hashpartitioning(cls" not in p
    assert "Window" not in p and "SortMergeJoin" not in p
    # the flag filter reaches the scan of lineitem
    li_scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_returnflag" in li_scan and "DataFilters" in li_scan


def test_first_per_key_is_partial_aggregate(spark):
    df = first_per_key(testbed.feed(spark, SF_SMALL), "video_id")
    p = plan_of(df)
    assert "partial_min" in p
    assert "Window" not in p


def test_broadcast_only_within_bound(spark):
    feed = testbed.feed(spark, SF_SMALL).select("category_id", "tags")
    dictionary = testbed.dictionary(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(attach_name(feed, dictionary, broadcast_max_rows=100))
        p = plan_of(attach_name(feed, dictionary, broadcast_max_rows=10))  # 25 ids > 10
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_in_any_plan(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    p = plan_of(df)
    assert not any(node in p for node in PYTHON_NODES), name


def test_dealt_join_equals_plain_join(spark):
    from feedlens.operators import hot_ids

    counts = testbed.feed(spark, SF_SMALL).select("category_id", "tags", "video_id")
    dictionary = testbed.dictionary_with_repeats(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a real shuffle join, as for a big dictionary
    try:
        sizes = {r["category_id"]: r["count"] for r in counts.groupBy("category_id").count().collect()}
        limit = sorted(sizes.values())[len(sizes) // 2]  # the larger half of the ids is hot
        hot = {r["hot_id"]: r["copies"] for r in hot_ids(counts, "category_id", hot_rows=limit).collect()}
        assert hot == {k: -(-n // limit) for k, n in sizes.items() if n > limit} and 0 < len(hot) < len(sizes)
        assert hot_ids(counts, "category_id") is None  # none has a million rows
        assert len(hot_ids(counts, "category_id", hot_rows=1, max_ids=3).collect()) == 3
        plain = attach_name(counts, dictionary, broadcast=False, hot_rows=None)
        dealt = attach_name(counts, dictionary, broadcast=False, hot_rows=limit)
        left = attach_name(counts, dictionary, broadcast=False, hot_rows=limit, how="left", default="")
        p = re.sub(r"#\d+L?", "", plan_of(dealt))
        assert "SortMergeJoin [category_id, _salt]" in p and "BroadcastHashJoin" in p  # the hot ids' list is what is broadcast
        assert "_salt" not in plan_of(plain) and "_salt" not in plan_of(attach_name(counts, dictionary, broadcast=False))
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, dealt.collect()))
        want = counts.join(dictionary.withColumnRenamed("id", "category_id"), "category_id", "left").count()
        assert left.count() == want
        assert "_salt" not in dealt.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sql_twin_has_the_same_plan_shape(spark):
    df = catalog.queries()["top_tags_sql"](spark, SF_SMALL)
    p = plan_of(df)
    assert "WindowGroupLimit" in p and "BroadcastHashJoin" in p and "partial_count" in p


def test_top_k_lists_never_collect_before_the_cut(spark):
    df = catalog.queries()["agg_ordered_list"](spark, SF_SMALL)
    p = plan_of(df)
    # collect_list runs above the window filter (rn <= 10), never directly on the counts
    lines = p.splitlines()
    collect = max(i for i, line in enumerate(lines) if "collect_list" in line)
    cut = min(i for i, line in enumerate(lines) if re.search(r"\(rn#\d+ <= 10\)", line))
    assert collect < cut


def test_sort_multi_key_orders_rows(spark):
    rows = [tuple(r) for r in catalog.queries()["sort_multi_key"](spark, SF_SMALL).collect()]
    assert rows == sorted(rows, key=lambda r: (r[0], -r[2], r[1]))  # category asc, n desc, tag asc
    assert len(rows) > 10


def test_attach_name_rejects_existing_name_column(spark):
    df = spark.createDataFrame([("10", "x")], "category_id string, category string")
    dictionary = spark.createDataFrame([("10", "Music")], "id string, category string")
    with pytest.raises(ValueError):
        attach_name(df, dictionary)


def test_no_default_plan_repartitions_by_number(spark):
    for name in ("trending_union", "top_words_by_lang", "avg_comments_classification", "top_tags_by_category_id"):
        assert "REPARTITION_BY_NUM" not in plan_of(catalog.queries()[name](spark, SF_SMALL)), name


def test_sql_twin_beyond_the_bound_counts_before_the_join(spark):
    from feedlens.plans import sql

    feed, dictionary = testbed.feed(spark, SF_SMALL), testbed.dictionary(spark, SF_SMALL)
    first = sql.top_tags_by_category_name(spark, feed, dictionary, pre_aggregate=True)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, catalog.queries()["top_tags_sql"](spark, SF_SMALL).collect()))
    assert "partial_count" in plan_of(first) or "tags-by-id" in plan_of(first)
    dealt = sql.top_tags_by_category_name(spark, feed, dictionary, pre_aggregate=True, hot_rows=20)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, first.collect()))


def test_only_names_of_hot_ids_are_copied(spark):
    from feedlens.operators.dictionary import _join_dealt, hot_ids

    df = spark.createDataFrame([("1", i) for i in range(90)] + [(None, i) for i in range(50)] + [("2", 1), ("3", 2)], "category_id string, v int")
    names = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), ("9", "d")], "category_id string, category string")
    hot = hot_ids(df, "category_id", hot_rows=40)
    assert sorted(map(tuple, hot.collect()), key=str) == [("1", 3), (None, 2)]
    out = _join_dealt(df, names, hot, on="category_id", how="left")
    assert out.count() == 180 + 50 + 1 + 1
    copied = [line for line in plan_of(out, "extended").splitlines() if "Generate explode" in line]
    assert copied  # a generator, no cross join
    assert "CartesianProduct" not in plan_of(out)


def test_slices_of_one_input_are_one_scan(spark):
    from feedlens.operators import union_of_slices

    p = plan_of(catalog.queries()["union_all_feeds"](spark, SF_SMALL))
    assert sum("lineitem.parquet" in line for line in p.splitlines()) == 1 and "Union" not in p
    feed = testbed.feed_with_region(spark, SF_SMALL)
    n = {r: feed.where(feed.region == r).count() for r in testbed.REGIONS}
    assert union_of_slices(feed, "region", ["CA", "US", "CA", "none"]).count() == 2 * n["CA"] + n["US"]


def test_trailing_separators_are_trimmed_without_a_regex(spark):
    p = plan_of(catalog.queries()["top_tags_by_category_id"](spark, SF_SMALL))
    assert "regexp_replace" not in p and "rtrim" in p.lower() or "trim(trailing" in p.lower()


def test_plan_building_measures_the_dictionary_once(spark):
    from feedlens.plans import analytics

    feed, dictionary = testbed.feed(spark, SF_SMALL), testbed.dictionary(spark, SF_SMALL)
    for build in (analytics.top_tags_by_category_name, analytics.top_tags_by_category_id):
        group = f"jobs-{build.__name__}"
        spark.sparkContext.setJobGroup(group, group)
        build(feed, dictionary)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) <= 3, (build.__name__, len(jobs))  # one query: its broadcast, its aggregate and the result


def test_broadcast_bound_counts_bytes(spark):
    from feedlens.operators import fits_broadcast

    one = spark.createDataFrame([("1", "x" * 1000)], "id string, category string")
    assert fits_broadcast(one, 1, 1001) and not fits_broadcast(one, 1, 1000) and not fits_broadcast(one, 0)


def test_cache_reuse_releases_its_cache(spark):
    catalog.queries()["cache_reuse"](spark, SF_SMALL).collect()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def _feed_tables(tmp_dir, rows: int = 60) -> str:
    """``lineitem`` and ``part`` of ``rows`` line items, suppliers of every region among them."""
    rng = range(rows)
    lineitem = {"l_orderkey": [i // 3 for i in rng], "l_partkey": [i % 4 for i in rng], "l_suppkey": list(rng), "l_linenumber": [1 + i % 7 for i in rng],
                **{c: [float(i % 5) for i in rng] for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")},
                "l_returnflag": ["N"] * rows, "l_linestatus": ["O"] * rows, "l_shipdate": [dt.datetime(2020, 1, 1 + i % 28) for i in rng]}
    lineitem["l_linenumber"] = pa.array(lineitem["l_linenumber"], pa.int32())
    part = {"p_partkey": [0, 1, 2, 3], "p_name": ["a, b", 'c "d"', None, ""], "p_brand": ["B#1"] * 4, "p_type": ["t"] * 4}
    for name, columns in (("lineitem", lineitem), ("part", part)):
        pq.write_table(pa.table(columns), os.path.join(tmp_dir, f"{name}.parquet"))
    return tmp_dir


def test_region_feeds_are_compressed_files_of_bounded_size(spark, tmp_dir, monkeypatch):
    sf = _feed_tables(tmp_dir)
    monkeypatch.setattr(catalog, "FILE_RECORDS", 6)
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    folders = catalog.write_region_feeds(spark, sf)
    assert spark.conf.get(writers) == before
    for folder in folders:
        names = [n for n in os.listdir(folder) if n.startswith("part-")]
        assert len(names) >= 4 and all(n.endswith(".csv.gz") for n in names)  # 20 rows a region
    key = lambda row: tuple((x is not None, x) for x in row)
    want = sorted((tuple(r) for r in testbed.feed(spark, sf).collect()), key=key)
    for name in ("scan_csv_header", "scan_multi_path"):
        got = catalog.queries()[name](spark, sf)
        assert sorted((tuple(r) for r in got.select(*FEED_COLUMNS).collect()), key=key) == want
        assert all(f.endswith(".csv.gz") for f in got.inputFiles())


def test_first_per_key_of_the_feed_takes_shuffled_rows(spark, tmp_dir):
    df = catalog.queries()["first_per_key"](spark, _feed_tables(tmp_dir))
    assert "BroadcastHashJoin" not in plan_of(df)  # wide rows would come in tasks of a whole scan of narrow ones
    assert df.count() == 20
