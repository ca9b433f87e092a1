"""The top-tags analytic written as Spark SQL over temporary views.

Same plan as the DataFrame version (Catalyst produces the same physical
operators: broadcast join, partial/final count, ``WindowGroupLimit``), kept
as text for users who work in SQL. Beyond the broadcast bound the tags are
counted by id before the join, so the raw feed is never shuffled by id, and the
counts of hot ids are dealt over several tasks as in ``operators.attach_name``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators import fits_broadcast, hot_ids
from ..operators.dictionary import HOT_ROWS
from ..schema import TOP_K
from ..session import stored

COUNTS_JOIN_FIRST = """
WITH named AS (
  SELECT /*+ BROADCAST(d) */ d.category, f.tags
  FROM {feed} f JOIN {dictionary} d ON f.category_id = d.id
), tag_rows AS (
  SELECT category, lower(tag) AS tag
  FROM named LATERAL VIEW explode(split(tags, '[|]')) t AS tag
  WHERE tag != '[none]'
), counts AS (
  SELECT category, tag, count(*) AS n FROM tag_rows GROUP BY category, tag
)"""

COUNTS_BY_ID = """
WITH tag_rows AS (
  SELECT category_id, lower(tag) AS tag
  FROM {feed} LATERAL VIEW explode(split(tags, '[|]')) t AS tag
  WHERE tag != '[none]'
)
SELECT category_id, tag, count(*) AS n FROM tag_rows GROUP BY category_id, tag
"""

# by_id: the counts above; hot: the ids that hold too many of them for one task.
COUNTS_NAMED = """
WITH dealt AS (
  SELECT /*+ BROADCAST(h) */ b.category_id, b.tag, b.n,
         pmod(xxhash64(b.category_id, b.tag), coalesce(h.copies, 1L)) AS salt
  FROM {by_id} b LEFT JOIN {hot} h ON b.category_id <=> h.hot_id
), names AS (
  SELECT /*+ BROADCAST(h) */ d.id, d.category, explode(sequence(0L, coalesce(h.copies, 1L) - 1)) AS salt
  FROM {dictionary} d LEFT JOIN {hot} h ON d.id <=> h.hot_id
), counts AS (
  SELECT m.category, s.tag, sum(s.n) AS n
  FROM dealt s JOIN names m ON s.category_id = m.id AND s.salt = m.salt GROUP BY m.category, s.tag
)"""

RANKED_LISTS = """, ranked AS (
  SELECT category, tag, n, row_number() OVER (PARTITION BY category ORDER BY n DESC, tag ASC) AS rn
  FROM counts
)
SELECT category,
       array_join(
         transform(sort_array(collect_list(struct(-n AS k, tag))), e -> concat(e.tag, '#', CAST(-e.k AS STRING))),
         ',') AS top10_tags
FROM ranked
WHERE rn <= {k}
GROUP BY category
"""


def top_tags_by_category_name(
    spark: SparkSession, feed: DataFrame, dictionary: DataFrame, *, k: int = TOP_K, pre_aggregate: bool | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``category, top10_tags`` (``tag#n,tag#n``) from SQL text over temp views."""
    suffix = uuid.uuid4().hex[:8]
    views = {"feed": feed, "dictionary": dictionary}
    if pre_aggregate is None:
        pre_aggregate = not fits_broadcast(dictionary)
    named = {name: f"{name}_{suffix}" for name in ("feed", "dictionary", "by_id", "hot")}
    try:
        for name, df in views.items():
            df.createOrReplaceTempView(named[name])
        if pre_aggregate:
            by_id = stored(spark.sql(COUNTS_BY_ID.format(**named)), "tags-by-id")
            hot = hot_ids(by_id, "category_id", hot_rows=hot_rows)
            by_id.createOrReplaceTempView(named["by_id"])
            (spark.createDataFrame([], "hot_id string, copies bigint") if hot is None else hot).createOrReplaceTempView(named["hot"])
        text = (COUNTS_NAMED if pre_aggregate else COUNTS_JOIN_FIRST) + RANKED_LISTS
        # spark.sql analyzes at once: the result keeps the resolved plan, not the view names.
        return spark.sql(text.format(k=int(k), **named))
    finally:
        for name in named.values():
            spark.catalog.dropTempView(name)
