"""DataFrame-in, DataFrame-out operators."""

from .classify import (
    class_rows_numeric,
    class_rows_string,
    summarize_by_class,
    summarize_fixed_classes,
    with_class,
)
from .dictionary import BROADCAST_MAX_ROWS, attach_name, dedupe_dictionary, fits_broadcast, hot_ids
from .feed import counted, first_per_key, keep_enabled, parsable_rows, union_feeds, union_of_slices
from .tags import explode_tags, ranked_lists, render_top, tag_counts, top_k
from .windows import longest_list, running_list

__all__ = [
    "BROADCAST_MAX_ROWS",
    "attach_name",
    "class_rows_numeric",
    "class_rows_string",
    "counted",
    "dedupe_dictionary",
    "explode_tags",
    "first_per_key",
    "fits_broadcast",
    "hot_ids",
    "keep_enabled",
    "longest_list",
    "parsable_rows",
    "ranked_lists",
    "render_top",
    "running_list",
    "summarize_by_class",
    "summarize_fixed_classes",
    "tag_counts",
    "top_k",
    "union_feeds",
    "union_of_slices",
    "with_class",
]
