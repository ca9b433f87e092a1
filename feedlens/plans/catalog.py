"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus their SQL oracle.

Every query reads the driver tables of ``sf_dir`` (or files Spark writes
from them) in full, so its work grows with the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .. import jobs, sinks
from .. import sources as S
from ..functions import (
    contains,
    in_range,
    json_field,
    ratio,
    render_entries,
    split_first,
    tag_with_count,
    zero_guard_numeric,
    zero_guard_string,
)
from ..operators import (
    attach_name,
    class_rows_string,
    dedupe_dictionary,
    explode_tags,
    first_per_key,
    keep_enabled,
    longest_list,
    parsable_rows,
    ranked_lists,
    running_list,
    tag_counts,
    top_k,
    union_feeds,
    union_of_slices,
    with_class,
)
from ..schema import (
    CLASS_ORDER,
    CLASSIFICATION,
    CLASSIFICATION_SCHEMA,
    FEED_COLUMNS,
    VIDEOS_NUMBER,
    all_string_schema,
)
from ..session import scratch_path
from ..sources import testbed
from ..streaming import read_feed_stream, start_top_tags
from . import analytics as A
from . import oracle as O
from . import sql as SQL

Query = Callable[[SparkSession, str], DataFrame]

# Feed files: fast compression, and the rows of one file.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
FILE_RECORDS = 1_000_000

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)


# --------------------------------------------------------------------------- analytics


@register("avg_comments_classification", O.p1_sql())
def q_avg_comments_classification(spark, sf_dir):
    return A.avg_comments_classification(testbed.feed(spark, sf_dir))


@register("classification_nonempty", O.p2_sql())
def q_classification_nonempty(spark, sf_dir):
    return A.classification_nonempty(testbed.feed(spark, sf_dir))


@register("top_tags_by_category_name", O.p3_sql())
def q_top_tags_by_category_name(spark, sf_dir):
    return A.top_tags_by_category_name(testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))


@register("top_tags_by_category_id", O.p4_sql())
def q_top_tags_by_category_id(spark, sf_dir):
    return A.top_tags_by_category_id(testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))


@register("top_tags_count_first", O.p4_sql(count_first=True))
def q_top_tags_count_first(spark, sf_dir):
    return A.top_tags_count_first(testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))


@register("top_tags_preaggregated", O.p3_sql())
def q_top_tags_preaggregated(spark, sf_dir):
    """P3 through its large-dictionary plan: count by (id, tag), salted shuffle join, re-sum by name."""
    return A.top_tags_by_category_name(
        testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir), pre_aggregate=True
    )


# The testbed feed is already the union of the three regional feeds, read in
# one scan; slicing it per region and unioning back would read it three times.


@register("trending_union", O.p6_sql())
def q_trending_union(spark, sf_dir):
    return A.trending_union(testbed.feed(spark, sf_dir))


@register("trending_union_first", O.p7_sql())
def q_trending_union_first(spark, sf_dir):
    return A.trending_union_first(testbed.feed(spark, sf_dir))


@register("top_words_by_lang", O.top_words_sql())
def q_top_words_by_lang(spark, sf_dir):
    return A.top_words_by_lang(testbed.documents(spark, sf_dir))


# --------------------------------------------------------------------------- helpers


def _named_tag_counts(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir).select("category_id", "tags")
    named = attach_name(feed, testbed.dictionary(spark, sf_dir), how="inner")
    return tag_counts(explode_tags(named, ["category"]), ["category"])


def _id_tag_counts(spark, sf_dir, keep_trailing_empty=True):
    feed = testbed.feed(spark, sf_dir).select("category_id", "tags")
    tags = explode_tags(feed, ["category_id"], keep_trailing_empty=keep_trailing_empty)
    return tag_counts(tags, ["category_id"])


def write_region_feeds(spark, sf_dir) -> list[str]:
    """The feed as one CSV directory per region (single scan, partitioned write), in the format of ``write_csv``.

    Compressed, in files of at most ``FILE_RECORDS`` rows, as a compressed file is read by one task. Every
    task holds the files of all regions open: rows are not sorted by region, which would spill large tasks.
    """
    root = scratch_path(spark, "feeds")
    rows = testbed.feed_with_region(spark, sf_dir)
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, str(len(testbed.REGIONS) + 1))  # at the number itself Spark begins to sort
    try:
        (
            rows.write.mode("overwrite")
            .partitionBy("region")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .options(**GZIP)
            .option("maxRecordsPerFile", FILE_RECORDS)
            .csv(root)
        )
    finally:
        spark.conf.set(writers, before)
    return [f"{root}/region={r}" for r in testbed.REGIONS]


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def _taken(spark, name: str) -> DataFrame:
    """The rows of a table made for one call, from the scratch folder; the table itself is dropped."""
    path = scratch_path(spark, "table-rows")
    spark.table(name).write.parquet(path)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


def _expect_failure(action, what: str, condition: str) -> None:
    try:
        action()
    except AnalysisException as e:
        if e.getCondition() != condition:
            raise
        return
    raise AssertionError(f"{what} should have failed")


# --------------------------------------------------------------------------- sources


@register("scan_csv_header", O.union_all_feeds_sql())
def q_scan_csv_header(spark, sf_dir):
    """Names from each feed's header: one region's files hold the columns in another order."""
    first, *others = write_region_feeds(spark, sf_dir)
    turned = scratch_path(spark, "feed-turned")
    sinks.write_csv(S.read_feed(spark, first).select(*reversed(FEED_COLUMNS)), turned, file_records=FILE_RECORDS, options=GZIP)
    return union_feeds([S.read_named_feed(spark, p) for p in (*others, turned)])


@register("scan_multi_path", O.union_all_feeds_sql())
def q_scan_multi_path(spark, sf_dir):
    return S.read_feed(spark, write_region_feeds(spark, sf_dir))


@register("scan_csv_dropmalformed", O.scan_csv_dropmalformed_sql())
def q_scan_csv_dropmalformed(spark, sf_dir):
    path, names = _write_some_malformed(spark, sf_dir)
    df = S.read_feed(spark, path, schema=all_string_schema(names), header=False)
    return df.select("video_id", "likes")  # a pruned projection must still drop malformed lines


@register("scan_csv_rejected", O.scan_csv_rejected_sql())
def q_scan_csv_rejected(spark, sf_dir):
    """The dropped lines as they stand in the file, and (line NULL) how many rows are kept."""
    path, names = _write_some_malformed(spark, sf_dir)
    kept, rejected = S.read_feed_checked(spark, path, schema=all_string_schema(names), header=False)
    lines = rejected.select("line").unionByName(kept.select(F.lit(None).cast("string").alias("line")))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _write_some_malformed(spark, sf_dir) -> tuple[str, list[str]]:
    """(folder, field names) of a text feed in which some lines are too short or too long."""
    feed = testbed.feed(spark, sf_dir)
    c = F.col
    c_id = F.coalesce("category_id", F.lit(""))  # an empty field, so the line keeps its length
    # Five fields per line; 'n/a' dislikes are left out (4 fields) and tag
    # cells ending in '||' add two fields (6 or 7): both kinds are malformed.
    fields = F.when(c("dislikes") == "n/a", F.concat_ws(",", "video_id", c_id, "likes", "comments_disabled"))
    fields = fields.otherwise(F.concat_ws(",", "video_id", c_id, "likes", "dislikes", "comments_disabled"))
    line = F.when(F.endswith(c("tags"), F.lit("||")), F.concat(fields, F.lit(",x,y"))).otherwise(fields)
    path = scratch_path(spark, "malformed")
    feed.select(line.alias("value")).write.text(path)
    return path, ["video_id", "category_id", "likes", "dislikes", "comments_disabled"]


@register("scan_csv_quoted", O.scan_csv_quoted_sql())
def q_scan_csv_quoted(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir)
    c = F.col
    # A NULL cell is an unquoted empty field.
    quoted_tags = F.coalesce(F.concat(F.lit('"'), F.regexp_replace(c("tags"), r"\|", ","), F.lit('"')), F.lit(""))
    title = F.replace(c("title"), F.lit('"'), F.lit('""'))
    quoted_title = F.coalesce(F.concat(F.lit('"'), title, F.lit(' ""'), c("category_id"), F.lit('"""')), F.lit(""))
    line = F.concat_ws(",", c("video_id"), quoted_tags, quoted_title, c("likes"))
    path = scratch_path(spark, "quoted")
    feed.select(line.alias("value")).write.text(path)
    schema = all_string_schema(["video_id", "tag_text", "quoted_title", "likes"])
    return S.read_feed(spark, path, schema=schema, header=False)


@register("scan_text_schema", O.scan_text_schema_sql())
def q_scan_text_schema(spark, sf_dir):
    path = scratch_path(spark, "supplier")
    supplier = testbed.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    supplier.select([F.col(c).cast("string") for c in supplier.columns]).write.option("header", True).csv(path)
    return S.read_positional(spark, path, ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


@register("scan_json_lines", O.scan_json_lines_sql())
def q_scan_json_lines(spark, sf_dir):
    path = scratch_path(spark, "dictionary")
    part = testbed.table(spark, sf_dir, "part")
    part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_brand").alias("category")).write.json(path)
    return S.read_dictionary(spark, path)


@register("scan_key_value", O.scan_key_value_sql())
def q_scan_key_value(spark, sf_dir):
    counts = _id_tag_counts(spark, sf_dir)
    path = scratch_path(spark, "kv")
    value = F.concat_ws("\t", "tag", F.col("n").cast("string"))
    sinks.write_key_value(counts.select("category_id", value.alias("v")), path, "category_id", "v")
    return S.read_key_value(spark, path, escaped=True)


# --------------------------------------------------------------------------- sinks


@register("sink_text_kv", O.sink_text_kv_sql())
def q_sink_text_kv(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir).select("category_id", "tags")
    per_tag = tag_counts(explode_tags(feed, ["category_id"]), [])
    path = scratch_path(spark, "tag-kv")
    sinks.write_key_value(per_tag, path, "tag", "n")
    back = S.read_key_value(spark, path, key="tag", value="n", escaped=True)
    return back.select("tag", F.col("n").cast("bigint").alias("n"))


@register("sink_text_kv_escapes", O.sink_text_kv_escapes_sql())
def q_sink_text_kv_escapes(spark, sf_dir):
    """NULL keys and line breaks survive the key/value lines."""
    counts = _id_tag_counts(spark, sf_dir)
    path = scratch_path(spark, "kv-escapes")
    value = F.concat_ws("\n", "tag", F.col("n").cast("string"))
    sinks.write_key_value(counts.select("category_id", value.alias("v")), path, "category_id", "v")
    return S.read_key_value(spark, path, escaped=True)


def _three_rows(spark) -> DataFrame:
    """What an overwriting write has to replace."""
    return spark.createDataFrame([("old", 0, 0.0)] * 3, CLASSIFICATION_SCHEMA)


@register("sink_csv_single_file", O.p1_sql())
def q_sink_csv_single_file(spark, sf_dir):
    result = A.avg_comments_classification(testbed.feed(spark, sf_dir))
    path = scratch_path(spark, "classification-csv")
    sinks.write_csv(_three_rows(spark), path, single_file=True)
    sinks.write_csv(result, path, single_file=True)  # overwrite replaces
    return S.read_feed(spark, path, schema=CLASSIFICATION_SCHEMA)


@register("sink_csv_errorifexists", O.p3_sql())
def q_sink_csv_errorifexists(spark, sf_dir):
    result = A.top_tags_by_category_name(testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))
    path = scratch_path(spark, "top-tags-csv")
    sinks.write_csv(result, path, mode="errorifexists", single_file=True)
    _expect_failure(lambda: sinks.write_csv(result, path, mode="errorifexists"), "second write", "PATH_ALREADY_EXISTS")
    return S.read_feed(spark, path, schema=all_string_schema(["category", "top10_tags"]))


@register("sink_table_overwrite", O.p2_sql())
def q_sink_table_overwrite(spark, sf_dir):
    result = A.classification_nonempty(testbed.feed(spark, sf_dir))
    # A fresh name per call: a managed table of an earlier session may have
    # left its folder in the warehouse without being in this session's catalog.
    name = _table_name("feedlens_comments_classification")
    sinks.write_table(_three_rows(spark), name)
    sinks.write_table(result, name)  # overwrite replaces
    return _taken(spark, name)


@register("sink_publish", O.p3_sql())
def q_sink_publish(spark, sf_dir):
    """P3 published over an earlier result; a publish that fails on its way leaves the last one readable."""
    root = scratch_path(spark, "published")
    result = A.top_tags_by_category_name(testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))
    sinks.publish(result.limit(0), root)
    sinks.publish(result, root)
    broken = testbed.dictionary(spark, sf_dir).select(F.col("category"), F.raise_error(F.lit("stopped")).cast("string").alias("top10_tags"))
    try:
        sinks.publish(broken, root)
    except Exception as e:
        if "stopped" not in str(e):
            raise
    else:
        raise AssertionError("the broken result should not have been published")
    return sinks.read_published(spark, root)


@register("sink_ctas", O.p4_sql())
def q_sink_ctas(spark, sf_dir):
    result = A.top_tags_by_category_id(testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))
    name = _table_name("feedlens_tags_by_category")
    sinks.create_table_as(result, name)
    _expect_failure(lambda: sinks.create_table_as(result, name), "second CREATE TABLE AS SELECT", "TABLE_OR_VIEW_ALREADY_EXISTS")
    return _taken(spark, name)


# --------------------------------------------------------------------------- projections, local rows, sort, cache


@register("local_rows", O.local_rows_sql())
def q_local_rows(spark, sf_dir):
    classes = spark.createDataFrame(
        [(name, i + 1) for i, name in enumerate(CLASS_ORDER)], f"{CLASSIFICATION} string, position int"
    )
    rows = class_rows_string(keep_enabled(testbed.feed(spark, sf_dir), semantics="string"))
    counts = rows.groupBy(F.col("cls").alias(CLASSIFICATION)).agg(F.count(F.lit(1)).alias("n"))
    # The local side has exactly len(CLASS_ORDER) rows: a proven broadcast bound.
    out = F.broadcast(classes).join(counts, CLASSIFICATION, "left")
    return out.select(CLASSIFICATION, "position", F.coalesce("n", F.lit(0)).alias(VIDEOS_NUMBER))


@register("project_rename", O.project_rename_sql())
def q_project_rename(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir)
    return feed.select("video_id", "category_id", "tags").withColumnRenamed("tags", "tag_list").toDF(
        "video", "category_id", "tag_list"
    )


@register("sort_multi_key", O.sort_multi_key_sql())
def q_sort_multi_key(spark, sf_dir):
    counts = _named_tag_counts(spark, sf_dir)
    return counts.orderBy(F.col("category").asc(), F.col("n").desc(), F.col("tag").asc())


@register("cache_reuse", O.cache_reuse_sql())
def q_cache_reuse(spark, sf_dir):
    rows = class_rows_string(keep_enabled(testbed.feed(spark, sf_dir), semantics="string")).select("cls").cache()
    parts = [
        rows.filter(F.col("cls") == name).agg(F.count(F.lit(1)).alias(VIDEOS_NUMBER)).select(
            F.lit(name).alias(CLASSIFICATION), VIDEOS_NUMBER
        )
        for name in CLASS_ORDER
    ]
    path = scratch_path(spark, "class-counts")
    try:
        union_feeds(parts).write.parquet(path)  # three rows; the cache goes with the last use
    finally:
        rows.unpersist()
    return spark.read.parquet(path)


# --------------------------------------------------------------------------- filters and expressions


@register("filter_flags_false", O.filter_sql(O.FLAGS_FALSE))
def q_filter_flags_false(spark, sf_dir):
    rows = keep_enabled(testbed.feed(spark, sf_dir), semantics="string")
    return rows.select("video_id", "comments_disabled", "ratings_disabled", "likes")


@register("filter_flags_not_true", O.filter_sql(O.FLAGS_NOT_TRUE))
def q_filter_flags_not_true(spark, sf_dir):
    rows = keep_enabled(testbed.feed(spark, sf_dir), semantics="not_true")
    return rows.select("video_id", "comments_disabled", "ratings_disabled", "likes")


@register("filter_parsable", O.filter_parsable_sql())
def q_filter_parsable(spark, sf_dir):
    rows = parsable_rows(testbed.feed(spark, sf_dir), ints=("dislikes", "comment_count"))
    return rows.select("video_id", "dislikes", "comment_count")


def _str_ratio(feed):
    return feed.withColumn("ratio", ratio("likes", zero_guard_string("dislikes")))


@register("filter_ratio_range", O.filter_ratio_range_sql())
def q_filter_ratio_range(spark, sf_dir):
    rows = _str_ratio(testbed.feed(spark, sf_dir))
    return rows.filter(in_range("ratio")).select("video_id", "likes", "dislikes", "ratio")


@register("zero_guard_string", O.zero_guard_string_sql())
def q_zero_guard_string(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir)
    return feed.select("video_id", "dislikes", zero_guard_string("dislikes").alias("dislikes_guarded"))


@register("zero_guard_numeric", O.zero_guard_numeric_sql())
def q_zero_guard_numeric(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir)
    return feed.select("video_id", "dislikes", zero_guard_numeric("dislikes").alias("dislikes_guarded"))


@register("ratio_expr", O.ratio_expr_sql())
def q_ratio_expr(spark, sf_dir):
    return _str_ratio(testbed.feed(spark, sf_dir)).select("video_id", "likes", "dislikes", "ratio")


@register("ratio_classify", O.ratio_classify_sql())
def q_ratio_classify(spark, sf_dir):
    return with_class(testbed.feed(spark, sf_dir), semantics="string").select("video_id", "cls")


# --------------------------------------------------------------------------- aggregates


@register("agg_count_by_class", O.agg_count_by_class_sql())
def q_agg_count_by_class(spark, sf_dir):
    rows = with_class(keep_enabled(testbed.feed(spark, sf_dir), semantics="string"), semantics="string")
    cls = F.col("cls")
    return rows.agg(
        F.count(F.lit(1)).alias("enabled"),
        *[F.count_if(cls == F.lit(name)).alias(name) for name in CLASS_ORDER],
        F.count_if(cls.isNull()).alias("unclassified"),
    )


@register("agg_sum_over_count", O.agg_sum_over_count_sql())
def q_agg_sum_over_count(spark, sf_dir):
    rows = class_rows_string(keep_enabled(testbed.feed(spark, sf_dir), semantics="string"))
    return (
        rows.filter(F.col("cls").isNotNull())
        .groupBy(F.col("cls").alias(CLASSIFICATION))
        .agg(
            (F.sum("comments") / F.count(F.lit(1))).alias("sum_over_count"),
            F.avg("comments").alias("avg_parsed"),
        )
    )


@register("agg_group_count", O.agg_group_count_sql())
def q_agg_group_count(spark, sf_dir):
    return _named_tag_counts(spark, sf_dir)


# --------------------------------------------------------------------------- joins


@register("join_broadcast_inner", O.join_broadcast_inner_sql())
def q_join_broadcast_inner(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir).select("video_id", "category_id")
    return attach_name(feed, testbed.dictionary(spark, sf_dir), how="inner").select(
        "video_id", "category_id", "category"
    )


def _rows_per_id(spark, sf_dir):
    return testbed.feed(spark, sf_dir).groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))


@register("join_left_default_name", O.join_left_default_name_sql())
def q_join_left_default_name(spark, sf_dir):
    out = attach_name(_rows_per_id(spark, sf_dir), testbed.dictionary(spark, sf_dir), how="left", default="")
    return out.select("category_id", "category", "n")


@register("join_dedup_dictionary", O.join_dedup_dictionary_sql())
def q_join_dedup_dictionary(spark, sf_dir):
    names = dedupe_dictionary(testbed.dictionary_with_repeats(spark, sf_dir))
    return attach_name(_rows_per_id(spark, sf_dir), names, how="inner").select("category_id", "category", "n")


# --------------------------------------------------------------------------- strings, arrays, JSON


@register("explode_tags_keep_empty", O.explode_sql(True))
def q_explode_tags_keep_empty(spark, sf_dir):
    return explode_tags(testbed.feed(spark, sf_dir), ["category_id"])


@register("explode_tags_drop_trailing", O.explode_sql(False))
def q_explode_tags_drop_trailing(spark, sf_dir):
    return explode_tags(testbed.feed(spark, sf_dir), ["category_id"], keep_trailing_empty=False)


@register("string_lower_concat", O.string_lower_concat_sql())
def q_string_lower_concat(spark, sf_dir):
    counts = _id_tag_counts(spark, sf_dir)
    return counts.select("category_id", tag_with_count("tag", "n").alias("item"))


@register("split_limit", O.split_limit_sql())
def q_split_limit(spark, sf_dir):
    part = testbed.table(spark, sf_dir, "part")
    bh, br = split_first("p_brand", "#")
    nh, nr = split_first("p_name", " ")
    return part.select(
        "p_partkey", bh.alias("brand_head"), br.alias("brand_rest"), nh.alias("name_head"), nr.alias("name_rest")
    )


@register("string_contains", O.string_contains_sql())
def q_string_contains(spark, sf_dir):
    feed = testbed.feed(spark, sf_dir)
    return feed.select(
        "video_id",
        "tags",
        contains("tags", "||").alias("has_empty_tail"),
        contains("tags", "Brand#").alias("has_brand"),
    )


@register("json_extract_field", O.json_extract_field_sql())
def q_json_extract_field(spark, sf_dir):
    events = testbed.table(spark, sf_dir, "events")
    return events.select("event_id", json_field("props", "k").alias("k"))


# --------------------------------------------------------------------------- windows, top-k, lists


@register("window_row_number", O.window_row_number_sql())
def q_window_row_number(spark, sf_dir):
    return top_k(_named_tag_counts(spark, sf_dir), ["category"], keep_rank=True)


@register("topk_per_group", O.topk_per_group_sql())
def q_topk_per_group(spark, sf_dir):
    return top_k(_named_tag_counts(spark, sf_dir), ["category"]).select("category", "tag", "n")


@register("topk_by_category_id", O.topk_by_category_id_sql())
def q_topk_by_category_id(spark, sf_dir):
    counts = _id_tag_counts(spark, sf_dir, keep_trailing_empty=False)
    return top_k(counts, ["category_id"]).select("category_id", "tag", "n")


def _running(spark, sf_dir):
    return running_list(_named_tag_counts(spark, sf_dir), ["category"])


@register("window_running_list", O.window_running_list_sql())
def q_window_running_list(spark, sf_dir):
    return _running(spark, sf_dir).select("category", "tag", "n", F.array_join("running", ",").alias("running"))


@register("window_running_list_peers", O.window_running_list_peers_sql())
def q_window_running_list_peers(spark, sf_dir):
    """Tags of one count in a category share one list."""
    lists = running_list(_id_tag_counts(spark, sf_dir), ["category_id"], peers=True)
    return lists.select("category_id", "tag", "n", F.array_join("running", ",").alias("running"))


@register("agg_max_array", O.agg_max_array_sql())
def q_agg_max_array(spark, sf_dir):
    longest = longest_list(_running(spark, sf_dir), ["category"], col="running")
    return longest.select("category", F.array_join("running", ",").alias("top10_tags"))


@register("agg_ordered_list", O.agg_ordered_list_sql())
def q_agg_ordered_list(spark, sf_dir):
    lists = ranked_lists(_named_tag_counts(spark, sf_dir), ["category"])
    return lists.select("category", render_entries("entries", "bracket").alias("top10_tags"))


# --------------------------------------------------------------------------- set operations, first per key, SQL


@register("union_all_feeds", O.union_all_feeds_sql())
def q_union_all_feeds(spark, sf_dir):
    """The feeds of all regions, which here are slices of one input: one scan, not one a region."""
    return union_of_slices(testbed.feed_with_region(spark, sf_dir), "region", testbed.REGIONS).select(*FEED_COLUMNS)


@register("union_separate_feeds", O.union_all_feeds_sql())
def q_union_separate_feeds(spark, sf_dir):
    """Three inputs of their own, one scan each."""
    return union_feeds(testbed.feeds_by_region(spark, sf_dir)).select(*FEED_COLUMNS)


@register("first_per_key", O.first_per_key_feed_sql())
def q_first_per_key(spark, sf_dir):
    """The partial aggregate sorts whole rows: shuffled ones come in tasks small enough to do it in memory."""
    return first_per_key(testbed.feed(spark, sf_dir, shuffled=True), "video_id")


@register("top_tags_sql", O.p3_sql())
def q_top_tags_sql(spark, sf_dir):
    return SQL.top_tags_by_category_name(spark, testbed.feed(spark, sf_dir), testbed.dictionary(spark, sf_dir))


# --------------------------------------------------------------------------- streaming


@register("top_tags_streaming", O.p3_sql())
def q_top_tags_streaming(spark, sf_dir):
    """P3 through Structured Streaming: the feed arrives as CSV files."""
    inbox = scratch_path(spark, "feed-inbox")
    sinks.write_csv(testbed.feed(spark, sf_dir), inbox)
    out = scratch_path(spark, "top-tags-stream")
    stream = read_feed_stream(spark, inbox)
    query = start_top_tags(stream, testbed.dictionary(spark, sf_dir), out, available_now=True)
    query.awaitTermination()  # available-now ends by itself
    if query.exception() is not None:
        raise query.exception()
    result = S.read_feed(spark, out, schema=all_string_schema(["category", "top10_tags", "epoch"]))
    return result.select("category", "top10_tags")


# --------------------------------------------------------------------------- the jobs over files


def write_dictionary_json(spark, sf_dir) -> str:
    path = scratch_path(spark, "dictionary-json")
    testbed.dictionary(spark, sf_dir).write.json(path)
    return path


@register("classification_from_files", O.p1_sql())
def q_classification_from_files(spark, sf_dir):
    """P1 as the job runs it: three CSV feed files (one per country) read and unioned."""
    return jobs.classify(spark, write_region_feeds(spark, sf_dir))


@register("top_tags_from_files", O.p3_sql())
def q_top_tags_from_files(spark, sf_dir):
    """P3 as the job runs it: three CSV feed files and a JSON-lines dictionary."""
    return jobs.top_tags(spark, write_region_feeds(spark, sf_dir), write_dictionary_json(spark, sf_dir))


@register("top_tags_by_id_from_files", O.p4_sql())
def q_top_tags_by_id_from_files(spark, sf_dir):
    """P4 as the job runs it: three CSV feed files and a JSON-lines dictionary, grouped by id."""
    return jobs.top_tags(
        spark, write_region_feeds(spark, sf_dir), write_dictionary_json(spark, sf_dir), by="id"
    )


@register("union_from_files", O.union_from_files_sql())
def q_union_from_files(spark, sf_dir):
    """P6 as the job runs it, with a table: padding, line breaks, '' and NULL survive both outputs."""
    description = F.when(F.endswith("video_id", F.lit("1")), F.lit("")).when(
        ~F.endswith("video_id", F.lit("2")), F.concat("description", F.lit("\nmore"))
    )
    feed = testbed.feed(spark, sf_dir).withColumn("title", F.concat(F.lit(" "), "title", F.lit("\n ")))
    inbox, out, name = scratch_path(spark, "union-feed"), scratch_path(spark, "union-csv"), _table_name("feedlens_union")
    sinks.write_csv(feed.withColumn("description", description), inbox)
    jobs.run(["union", "--feeds", inbox, "--out", out, "--table", name, "--multi-line"], spark=spark)
    spark.sql(f"DROP TABLE {name}")
    return S.read_named_feed(spark, out, multi_line=True)  # the text files were written from the table
