"""Schemas and fixed values of the feed analytics.

The feed is a row-oriented text table with sixteen string columns, one file
per country. Numbers stay strings until a single normalising projection
parses them with ``try_cast`` (``functions.casts``), so a malformed cell turns
into NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must stay equal to the analytics being reproduced.
# ---------------------------------------------------------------------------
FEED_COLUMNS = (
    "video_id",
    "trending_date",
    "title",
    "channel_title",
    "category_id",
    "publish_time",
    "tags",
    "views",
    "likes",
    "dislikes",
    "comment_count",
    "thumbnail_link",
    "comments_disabled",
    "ratings_disabled",
    "video_error_or_removed",
    "description",
)
# Engagement classes by likes/dislikes ratio: bad < 4 <= neutral <= 6 < good.
RATIO_LOW = 4
RATIO_HIGH = 6
NEUTRAL, GOOD, BAD = "neutral", "good", "bad"
CLASS_ORDER = (NEUTRAL, GOOD, BAD)  # order of the rows in the classification result
FLAG_TRUE, FLAG_FALSE = "True", "False"
NO_TAGS = "[none]"  # marker for "no tags", compared before lower-casing
TAG_SEPARATOR = r"\|"  # tags cell is "a|b|c"
TOP_K = 10
# Result column names of the classification.
CLASSIFICATION, VIDEOS_NUMBER, AVERAGE_COMMENTS = "Classification", "VideosNumber", "AverageComments"
# ---------------------------------------------------------------------------

FEED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FEED_COLUMNS])

DICTIONARY_SCHEMA = T.StructType(
    [T.StructField("id", T.StringType(), True), T.StructField("category", T.StringType(), True)]
)

CLASSIFICATION_SCHEMA = T.StructType(
    [
        T.StructField(CLASSIFICATION, T.StringType(), True),
        T.StructField(VIDEOS_NUMBER, T.LongType(), True),
        T.StructField(AVERAGE_COMMENTS, T.DoubleType(), True),
    ]
)


def all_string_schema(names) -> T.StructType:
    """Explicit schema of nullable string columns, in the given order."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])
