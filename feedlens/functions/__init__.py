"""Column-level building blocks (built-in Spark expressions only, no UDFs)."""

from .casts import col_of, double_parsable, int_parsable, to_bigint, to_double, to_int
from .engagement import (
    classify,
    flags_all_false,
    flags_none_true,
    in_range,
    ratio,
    zero_guard_numeric,
    zero_guard_string,
)
from .tags import (
    RENDERINGS,
    ranked_entries,
    render_entries,
    split_drop_trailing,
    split_keep_empty,
    split_stripped,
    strip_trailing,
    tag_with_count,
)
from .text import contains, json_field, split_first

__all__ = [
    "RENDERINGS",
    "classify",
    "col_of",
    "contains",
    "double_parsable",
    "flags_all_false",
    "flags_none_true",
    "in_range",
    "int_parsable",
    "json_field",
    "ranked_entries",
    "ratio",
    "render_entries",
    "split_drop_trailing",
    "split_first",
    "split_keep_empty",
    "split_stripped",
    "strip_trailing",
    "tag_with_count",
    "to_bigint",
    "to_double",
    "to_int",
    "zero_guard_numeric",
    "zero_guard_string",
]
