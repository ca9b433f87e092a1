"""The feed and the category dictionary, derived from the driver's parquet tables.

The analytics take a feed of sixteen string columns and an ``(id, category)``
dictionary. On the driver tables the feed is ``lineitem`` joined with
``part`` (one feed row per line item), and the dictionary maps every nation
key to its region name, so several ids share one name. The mapping is chosen
so the edge cases of the analytics occur in bulk: unparsable and zero
dislikes, NULL comment counts, disabled flags, ``[none]``, NULL and empty
cells, trailing empty tags, upper-case tags with ``#``, NULL ids and ids
without a dictionary entry, infinite likes, padded and quoted titles.

Both scans are read column-pruned; the join is planned by Spark (a broadcast
of ``part`` only when its statistics say it is small, else a sort-merge join
with adaptive skew handling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEED_COLUMNS

REGIONS = ("CA", "GB", "US")


# The feed mapping, as SQL expressions over ``lineitem`` joined with ``part``.
FEED_EXPRESSIONS = {
    "region": "CASE l_suppkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'GB' ELSE 'US' END",
    "video_id": "CAST(l_orderkey AS STRING)",
    "trending_date": "date_format(l_shipdate, 'yy.dd.MM')",
    # padded cells with commas and quotes
    "title": "CASE WHEN l_linenumber = 4 THEN concat('  ', p_name, ', \"new\" ') ELSE p_name END",
    "channel_title": "concat('channel ', CAST(l_suppkey AS STRING))",
    # ids 25..29 have no dictionary entry; some rows have no id at all
    "category_id": "CASE WHEN l_partkey % 53 <> 0 THEN CAST(l_suppkey % 30 AS STRING) END",
    "publish_time": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\")",
    # NULL, '', '[NONE]' and '[none]' cells, trailing empty tags on line 7, upper case and '#' from the brand
    "tags": "CASE WHEN l_partkey % 59 = 0 THEN NULL WHEN l_partkey % 59 = 1 THEN '' WHEN l_partkey % 59 = 2 THEN '[NONE]' "
    "WHEN l_tax = 0 THEN '[none]' WHEN l_linenumber = 7 THEN concat(p_tags, '||') ELSE p_tags END",
    # views and comments above 2^31 in bulk
    "views": "CAST(CAST(floor(l_extendedprice) AS BIGINT) + CASE WHEN l_suppkey % 7 = 0 THEN 3000000000 ELSE 0 END AS STRING)",
    "likes": "CASE l_partkey % 61 WHEN 0 THEN 'Infinity' WHEN 1 THEN 'NaN' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
    "dislikes": "CASE WHEN l_partkey % 97 = 0 THEN 'n/a' "
    "ELSE CAST(CAST(round(l_discount * 100) AS INT) AS STRING) END",  # 0..10 and unparsable
    "comment_count": "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 5 "
    "THEN CAST(l_partkey + 3000000000 AS STRING) ELSE CAST(l_partkey AS STRING) END",
    "thumbnail_link": "concat('thumb/', CAST(l_orderkey AS STRING), '.jpg')",
    # Flags: mostly 'True'/'False', plus lower-case text and NULLs, on which
    # "equals 'False'" and "not equal to 'True'" disagree.
    "comments_disabled": "CASE WHEN l_returnflag = 'R' THEN 'True' "
    "WHEN l_returnflag = 'A' AND l_linenumber = 3 THEN 'false' ELSE 'False' END",
    "ratings_disabled": "CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 'True' "
    "WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN NULL ELSE 'False' END",
    "video_error_or_removed": "'False'",
    "description": "p_type",
}

LINEITEM_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


def feed_with_region(spark: SparkSession, sf_dir: str, *, shuffled: bool = False) -> DataFrame:
    """The whole feed (all regions) plus a ``region`` column.

    ``shuffled`` joins the parts by a shuffle even where they could be broadcast: the wide feed rows then
    come in tasks of the size of a shuffle partition, not of a scan of the narrow line items.
    """
    li = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
    # Per-part values are built on the part side, once per part instead of once per line item.
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_type", "concat(replace(p_name, ' ', '|'), '|', p_brand) AS p_tags"
    )
    if shuffled:
        part = part.hint("shuffle_hash")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.selectExpr(*[f"{expr} AS {name}" for name, expr in FEED_EXPRESSIONS.items()])


def feed(spark: SparkSession, sf_dir: str, *, shuffled: bool = False) -> DataFrame:
    """The whole feed (the union of all regions) with the sixteen feed columns; ``shuffled`` as in ``feed_with_region``."""
    return feed_with_region(spark, sf_dir, shuffled=shuffled).select(*FEED_COLUMNS)


def feeds_by_region(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """One feed per region, as separate inputs (each its own scan)."""
    full = feed_with_region(spark, sf_dir)
    return [full.filter(F.col("region") == r).select(*FEED_COLUMNS) for r in REGIONS]


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, category)``: nation key -> region name (25 ids, 5 names)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("r_name").alias("category")
    )


def dictionary_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary plus a second name per id (the nation name): every id repeats."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("category")
    )
    return dictionary(spark, sf_dir).unionByName(nation)
