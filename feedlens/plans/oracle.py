"""Independent SQL formulation of every registered query (DuckDB dialect).

These strings are the correctness oracle: they run in DuckDB over the same
parquet tables (pre-registered views ``lineitem``, ``part``, ``nation``,
``region``, ``supplier``, ``events``, ``documents``) and must give the same
rows as the Spark plans. Shared CTEs (``feed``, ``dict``, tag counts) are
spelled once here and combined per query.
"""

from __future__ import annotations

FEED_SQL = """
select
  case l_suppkey % 3 when 0 then 'CA' when 1 then 'GB' else 'US' end as region,
  cast(l_orderkey as varchar) as video_id,
  strftime(l_shipdate, '%y.%d.%m') as trending_date,
  case when l_linenumber = 4 then '  ' || p_name || ', "new" ' else p_name end as title,
  'channel ' || cast(l_suppkey as varchar) as channel_title,
  case when l_partkey % 53 <> 0 then cast(l_suppkey % 30 as varchar) end as category_id,
  strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as publish_time,
  case when l_partkey % 59 = 0 then null when l_partkey % 59 = 1 then '' when l_partkey % 59 = 2 then '[NONE]'
       when l_tax = 0 then '[none]'
       when l_linenumber = 7 then replace(p_name, ' ', '|') || '|' || p_brand || '||'
       else replace(p_name, ' ', '|') || '|' || p_brand end as tags,
  cast(cast(floor(l_extendedprice) as bigint) + case when l_suppkey % 7 = 0 then 3000000000 else 0 end as varchar) as views,
  case l_partkey % 61 when 0 then 'Infinity' when 1 then 'NaN' else cast(cast(trunc(l_quantity) as integer) as varchar) end as likes,
  case when l_partkey % 97 = 0 then 'n/a'
       else cast(cast(round(l_discount * 100) as integer) as varchar) end as dislikes,
  case when l_linenumber = 6 then null when l_linenumber = 5 then cast(l_partkey + 3000000000 as varchar) else cast(l_partkey as varchar) end as comment_count,
  'thumb/' || cast(l_orderkey as varchar) || '.jpg' as thumbnail_link,
  case when l_returnflag = 'R' then 'True'
       when l_returnflag = 'A' and l_linenumber = 3 then 'false' else 'False' end as comments_disabled,
  case when l_linestatus = 'F' and l_linenumber = 1 then 'True'
       when l_linestatus = 'F' and l_linenumber = 2 then null else 'False' end as ratings_disabled,
  'False' as video_error_or_removed,
  p_type as description
from lineitem join part on l_partkey = p_partkey
"""

DICT_SQL = """
select cast(n_nationkey as varchar) as id, r_name as category
from nation join region on n_regionkey = r_regionkey
"""

FEED_COLS = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags, views, likes, "
    "dislikes, comment_count, thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, "
    "description"
)

# Parsing helpers, as SQL expressions over a column name.


def dbl(c: str) -> str:
    return f"try_cast({c} as double)"


def int_ok(c: str) -> str:
    return f"(coalesce(regexp_full_match({c}, '[+-]?[0-9]+'), false) and try_cast({c} as bigint) is not null)"


def dbl_ok(c: str) -> str:
    return f"({dbl(c)} is not null)"


def ratio_sql(num: str, den: str) -> str:
    """num/den as double; NULL on parse failure, division by zero or NaN."""
    q = f"(case when {dbl(den)} = 0 then null else {dbl(num)} / {dbl(den)} end)"
    return f"(case when isnan({q}) then null else {q} end)"


def class_sql(r: str) -> str:
    return (
        f"(case when {r} > 6 then 'good' when {r} < 4 then 'bad' "
        f"when {r} between 4 and 6 then 'neutral' end)"
    )


FLAGS_FALSE = "(comments_disabled = 'False' and ratings_disabled = 'False')"
FLAGS_NOT_TRUE = (
    "(not (comments_disabled is not distinct from 'True') and not (ratings_disabled is not distinct from 'True'))"
)
DISLIKES_STR_GUARD = "(case when dislikes = '0' then '1' else dislikes end)"
DISLIKES_NUM_GUARD = f"(case when {dbl('dislikes')} = 0 then 1.0 else {dbl('dislikes')} end)"


def with_ctes(body: str, **ctes: str) -> str:
    """``WITH feed AS (...), dict AS (...), <ctes> <body>``."""
    parts = [f"feed as ({FEED_SQL})", f"dict as ({DICT_SQL})"]
    parts += [f"{name} as ({sql})" for name, sql in ctes.items()]
    return "with " + ",\n".join(parts) + "\n" + body


# Explode variants.
EXPLODE_KEEP = "select {key}, unnest(string_split(tags, '|')) as tag from {src}"
EXPLODE_DROP_TRAILING = (
    "select {key}, unnest(case when tags = '' then [''] "
    "when regexp_replace(tags, '\\|+$', '') = '' then []::varchar[] "
    "else string_split(regexp_replace(tags, '\\|+$', ''), '|') end) as tag from {src}"
)


def tag_rows(key: str, src: str, keep_trailing: bool = True) -> str:
    """(key, tag) rows: split, drop the exact '[none]' piece, lower-case."""
    pattern = EXPLODE_KEEP if keep_trailing else EXPLODE_DROP_TRAILING
    exploded = pattern.format(key=key, src=src)
    return f"select {key}, lower(tag) as tag from ({exploded}) x where tag <> '[none]'"


def tag_count_sql(key: str, src: str, keep_trailing: bool = True) -> str:
    return f"select {key}, tag, count(*) as n from ({tag_rows(key, src, keep_trailing)}) t group by {key}, tag"


def ranked_sql(key: str, counts: str) -> str:
    return f"select *, row_number() over (partition by {key} order by n desc, tag) as rn from ({counts}) c"


def top_sql(key: str, counts: str, k: int = 10) -> str:
    return f"select {key}, tag, n from ({ranked_sql(key, counts)}) r where rn <= {k}"


def render_hash(key: str, top: str, out: str = "top10_tags") -> str:
    return (
        f"select {key}, string_agg(tag || '#' || cast(n as varchar), ',' order by n desc, tag) as {out} "
        f"from ({top}) t group by {key}"
    )


def render_bracket(key: str, top: str, count_first: bool = False) -> str:
    item = "cast(n as varchar) || '->' || tag" if count_first else "tag || '#' || cast(n as varchar)"
    return (
        f"select {key}, '[' || string_agg({item}, ', ' order by n desc, tag) || ']' as top10_tags "
        f"from ({top}) t group by {key}"
    )


NAMED_FEED = "(select f.*, d.category from feed f join dict d on f.category_id = d.id)"
DEDUP_DICT = "(select id, max(category) as category from dict group by id)"


def p1_sql() -> str:
    rows = (
        f"select {class_sql(ratio_sql('likes', DISLIKES_STR_GUARD))} as cls, {dbl('comment_count')} as comments "
        f"from feed where {FLAGS_FALSE}"
    )
    body = (
        "select k.Classification, coalesce(g.n, 0) as VideosNumber, "
        "g.s / nullif(g.n, 0) as AverageComments "
        "from (values ('neutral'), ('good'), ('bad')) k(Classification) "
        "left join (select cls, count(*) as n, sum(comments) as s from rows where cls is not null group by cls) g "
        "on g.cls = k.Classification"
    )
    return with_ctes(body, rows=rows)


def p2_rows_sql() -> str:
    ok = " and ".join([dbl_ok("likes"), dbl_ok("dislikes"), int_ok("comment_count")])
    return (
        f"select {class_sql(ratio_sql('likes', DISLIKES_NUM_GUARD))} as cls, "
        f"cast(comment_count as bigint) as comments from feed where {FLAGS_NOT_TRUE} and {ok}"
    )


def p2_sql() -> str:
    body = (
        "select cls as Classification, count(*) as VideosNumber, "
        "cast(sum(comments) as double) / count(*) as AverageComments "
        "from rows where cls is not null group by cls"
    )
    return with_ctes(body, rows=p2_rows_sql())


def p3_sql() -> str:
    counts = tag_count_sql("category", NAMED_FEED)
    return with_ctes(render_hash("category", top_sql("category", counts)))


def p4_sql(count_first: bool = False) -> str:
    counts = tag_count_sql("category_id", "feed", keep_trailing=False)
    lists = render_bracket("category_id", top_sql("category_id", counts), count_first)
    body = (
        "select l.category_id, coalesce(d.category, '') as category, l.top10_tags "
        f"from lists l left join {DEDUP_DICT} d on l.category_id = d.id"
    )
    return with_ctes(body, lists=lists)


def p6_where() -> str:
    return f"{FLAGS_NOT_TRUE} and {int_ok('dislikes')} and {int_ok('comment_count')}"


def p6_sql() -> str:
    return with_ctes(f"select {FEED_COLS} from feed where {p6_where()}")


def first_per_key_sql(src: str, key: str, order_cols: str) -> str:
    order = ", ".join(f"{c.strip()} nulls first" for c in order_cols.split(","))
    return (
        f"select {FEED_COLS} from (select *, row_number() over (partition by {key} order by {order}) as _rn "
        f"from {src}) x where _rn = 1"
    )


def p7_sql() -> str:
    rest = ", ".join(c.strip() for c in FEED_COLS.split(",") if c.strip() != "video_id")
    body = first_per_key_sql(f"(select {FEED_COLS} from feed where {p6_where()})", "video_id", rest)
    return with_ctes(body)


def top_words_sql() -> str:
    words = "select lang, lower(unnest(string_split(text, ' '))) as tag from documents"
    counts = f"select lang, tag, count(*) as n from ({words}) w group by lang, tag"
    return render_hash("lang", top_sql("lang", counts), out="top10_words")


# --------------------------------------------------------------------------- operator-level queries

NAMED_TAG_COUNTS = tag_count_sql("category", NAMED_FEED)
ID_TAG_COUNTS = tag_count_sql("category_id", "feed")
STR_RATIO = ratio_sql("likes", DISLIKES_STR_GUARD)


def feed_select(cols: str, where: str | None = None) -> str:
    return with_ctes(f"select {cols} from feed" + (f" where {where}" if where else ""))


def scan_csv_dropmalformed_sql() -> str:
    # Well-formed lines only: a missing dislikes field ('n/a' rows) or two extra
    # fields (tags ending in '||') make a line malformed.
    return feed_select("video_id, likes", "dislikes <> 'n/a' and not coalesce(suffix(tags, '||'), false)")


def scan_csv_rejected_sql() -> str:
    bad = "dislikes = 'n/a' or coalesce(suffix(tags, '||'), false)"
    fields = "concat_ws(',', video_id, coalesce(category_id, ''), likes, case when dislikes <> 'n/a' then dislikes end, comments_disabled)"
    line = f"case when {bad} then {fields} || case when suffix(tags, '||') then ',x,y' else '' end end"
    return with_ctes(f"select line, count(*) as n from (select {line} as line from feed) t group by line")


def scan_csv_quoted_sql() -> str:
    return feed_select(
        "video_id, replace(tags, '|', ',') as tag_text, title || ' \"' || category_id || '\"' as quoted_title, likes"
    )


def scan_text_schema_sql() -> str:
    return (
        "select 's_suppkey' as s_suppkey, 's_name' as s_name, 's_nationkey' as s_nationkey, "
        "'s_acctbal' as s_acctbal union all "
        "select cast(s_suppkey as varchar), s_name, cast(s_nationkey as varchar), cast(s_acctbal as varchar) "
        "from supplier"
    )


def scan_json_lines_sql() -> str:
    return "select cast(p_partkey as varchar) as id, p_brand as category from part"


def scan_key_value_sql() -> str:
    return with_ctes(f"select category_id as key, tag || chr(9) || cast(n as varchar) as value from ({ID_TAG_COUNTS}) c")


def sink_text_kv_sql() -> str:
    return with_ctes(
        f"select tag, count(*) as n from ({tag_rows('category_id', 'feed')}) t group by tag"
    )


def sink_text_kv_escapes_sql() -> str:
    return with_ctes(f"select category_id as key, tag || chr(10) || cast(n as varchar) as value from ({ID_TAG_COUNTS}) c")


def union_from_files_sql() -> str:
    cols = FEED_COLS.replace(" title,", " ' ' || title || chr(10) || ' ' as title,").replace(
        "description", "case right(video_id, 1) when '1' then '' when '2' then null else description || chr(10) || 'more' end as description"
    )
    return with_ctes(f"select {cols} from feed where {p6_where()}")


def local_rows_sql() -> str:
    counts = f"select {class_sql(STR_RATIO)} as cls, count(*) as n from feed where {FLAGS_FALSE} group by 1"
    body = (
        "select k.Classification, k.position, coalesce(c.n, 0) as VideosNumber "
        "from (values ('neutral', 1), ('good', 2), ('bad', 3)) k(Classification, position) "
        "left join counts c on c.cls = k.Classification"
    )
    return with_ctes(body, counts=counts)


def project_rename_sql() -> str:
    return feed_select("video_id as video, category_id, tags as tag_list")


def sort_multi_key_sql() -> str:
    return with_ctes(f"select category, tag, n from ({NAMED_TAG_COUNTS}) c")


def class_count_sql() -> str:
    """Per class row counts under string semantics, all three classes."""
    return local_rows_sql().replace("k.Classification, k.position, ", "k.Classification, ")


def filter_sql(where: str) -> str:
    return feed_select("video_id, comments_disabled, ratings_disabled, likes", where)


def filter_parsable_sql() -> str:
    return feed_select("video_id, dislikes, comment_count", f"{int_ok('dislikes')} and {int_ok('comment_count')}")


def filter_ratio_range_sql() -> str:
    return feed_select(f"video_id, likes, dislikes, {STR_RATIO} as ratio", f"{STR_RATIO} between 4 and 6")


def zero_guard_string_sql() -> str:
    return feed_select(f"video_id, dislikes, {DISLIKES_STR_GUARD} as dislikes_guarded")


def zero_guard_numeric_sql() -> str:
    return feed_select(f"video_id, dislikes, {DISLIKES_NUM_GUARD} as dislikes_guarded")


def ratio_expr_sql() -> str:
    return feed_select(f"video_id, likes, dislikes, {STR_RATIO} as ratio")


def ratio_classify_sql() -> str:
    return feed_select(f"video_id, {class_sql(STR_RATIO)} as cls")


def agg_count_by_class_sql() -> str:
    cls = class_sql(STR_RATIO)
    return feed_select(
        f"count(*) as enabled, cast(count_if({cls} = 'neutral') as bigint) as neutral, "
        f"cast(count_if({cls} = 'good') as bigint) as good, cast(count_if({cls} = 'bad') as bigint) as bad, "
        f"cast(count_if({cls} is null) as bigint) as unclassified",
        FLAGS_FALSE,
    )


def agg_sum_over_count_sql() -> str:
    rows = f"select {class_sql(STR_RATIO)} as cls, {dbl('comment_count')} as comments from feed where {FLAGS_FALSE}"
    body = (
        "select cls as Classification, sum(comments) / count(*) as sum_over_count, avg(comments) as avg_parsed "
        "from rows where cls is not null group by cls"
    )
    return with_ctes(body, rows=rows)


def join_broadcast_inner_sql() -> str:
    return with_ctes("select f.video_id, f.category_id, d.category from feed f join dict d on f.category_id = d.id")


def join_left_default_name_sql() -> str:
    return with_ctes(
        "select c.category_id, coalesce(d.category, '') as category, c.n from "
        "(select category_id, count(*) as n from feed group by category_id) c "
        "left join dict d on c.category_id = d.id"
    )


def join_dedup_dictionary_sql() -> str:
    repeats = "select * from dict union all select cast(n_nationkey as varchar) as id, n_name as category from nation"
    body = (
        "select c.category_id, d.category, c.n from "
        "(select category_id, count(*) as n from feed group by category_id) c "
        "join (select id, max(category) as category from repeats group by id) d on c.category_id = d.id"
    )
    return with_ctes(body, repeats=repeats)


def explode_sql(keep_trailing: bool) -> str:
    return with_ctes(tag_rows("category_id", "feed", keep_trailing))


def string_lower_concat_sql() -> str:
    return with_ctes(f"select category_id, tag || '#' || cast(n as varchar) as item from ({ID_TAG_COUNTS}) c")


def split_limit_sql() -> str:
    def head_rest(col: str, sep: str, head: str, rest: str) -> str:
        pos = f"strpos({col}, '{sep}')"
        return (
            f"case when {pos} > 0 then substr({col}, 1, {pos} - 1) else {col} end as {head}, "
            f"case when {pos} > 0 then substr({col}, {pos} + 1) end as {rest}"
        )

    return (
        f"select p_partkey, {head_rest('p_brand', '#', 'brand_head', 'brand_rest')}, "
        f"{head_rest('p_name', ' ', 'name_head', 'name_rest')} from part"
    )


def string_contains_sql() -> str:
    return feed_select("video_id, tags, contains(tags, '||') as has_empty_tail, contains(tags, 'Brand#') as has_brand")


def json_extract_field_sql() -> str:
    return "select event_id, json_extract_string(props, '$.k') as k from events"


def agg_group_count_sql() -> str:
    return with_ctes(f"select category, tag, n from ({NAMED_TAG_COUNTS}) c")


def window_row_number_sql() -> str:
    return with_ctes(
        f"select category, tag, n, cast(rn as integer) as rn from ({ranked_sql('category', NAMED_TAG_COUNTS)}) r "
        "where rn <= 10"
    )


def topk_per_group_sql() -> str:
    return with_ctes(top_sql("category", NAMED_TAG_COUNTS))


def topk_by_category_id_sql() -> str:
    return with_ctes(top_sql("category_id", tag_count_sql("category_id", "feed", keep_trailing=False)))


def window_running_list_sql() -> str:
    top = f"select *, row_number() over (partition by category order by n desc, tag) as rn from ({top_sql('category', NAMED_TAG_COUNTS)}) t"
    body = (
        "select a.category, a.tag, a.n, string_agg(b.tag || '#' || cast(b.n as varchar), ',' order by b.rn) as running "
        "from top a join top b on a.category = b.category and b.rn <= a.rn group by a.category, a.tag, a.n"
    )
    return with_ctes(body, top=top)


def window_running_list_peers_sql() -> str:
    body = (
        "select a.category_id, a.tag, a.n, string_agg(b.tag || '#' || cast(b.n as varchar), ',' order by b.n desc, b.tag) as running "
        "from top a join top b on a.category_id is not distinct from b.category_id and b.n >= a.n group by a.category_id, a.tag, a.n"
    )
    return with_ctes(body, top=top_sql("category_id", tag_count_sql("category_id", "feed")))


def agg_max_array_sql() -> str:
    return p3_sql()


def agg_ordered_list_sql() -> str:
    return with_ctes(render_bracket("category", top_sql("category", NAMED_TAG_COUNTS)))


def union_all_feeds_sql() -> str:
    return feed_select(FEED_COLS)


def first_per_key_feed_sql() -> str:
    rest = ", ".join(c.strip() for c in FEED_COLS.split(",") if c.strip() != "video_id")
    return with_ctes(first_per_key_sql("feed", "video_id", rest))


def cache_reuse_sql() -> str:
    return class_count_sql()
