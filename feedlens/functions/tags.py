"""Tag-cell splitting and top-list rendering (pure Column expressions)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import TAG_SEPARATOR
from .casts import col_of

# The three renderings of a ranked tag list.
#   hash        tag#n,tag#n
#   bracket     [tag#n, tag#n]
#   count_first [n->tag, n->tag]
RENDERINGS = ("hash", "bracket", "count_first")


def split_keep_empty(c, pattern: str = TAG_SEPARATOR) -> Column:
    """Regex split keeping every empty piece, trailing ones included.

    ``'a|b||'`` gives ``['a', 'b', '', '']``; NULL gives NULL (no rows after
    ``explode``); ``''`` gives ``['']``.
    """
    return F.split(col_of(c), pattern)


def split_drop_trailing(c, pattern: str = TAG_SEPARATOR) -> Column:
    """Regex split that drops trailing empty pieces (leading ones are kept).

    ``'a|b||'`` gives ``['a', 'b']``, ``'|a'`` gives ``['', 'a']``, ``'||'``
    gives ``[]`` and ``''`` (no separator at all) gives ``['']``.
    """
    c = col_of(c)
    return split_stripped(c, strip_trailing(c, pattern), pattern)


def strip_trailing(c, pattern: str = TAG_SEPARATOR) -> Column:
    """The cell without the separators at its end.

    A separator of one character (alone, ``[x]`` or ``\\x``) is trimmed; only other patterns need a regex pass.
    """
    c = col_of(c)
    one = re.fullmatch(r"\[([^\\^\]-])\]|\\(\W)|([^\\^$.|?*+()\[\]{}])", pattern)
    if one:
        return F.rtrim(c, F.lit(one[1] or one[2] or one[3]))
    return F.regexp_replace(c, f"(?:{pattern})+$", "")


def split_stripped(cell, stripped, pattern: str = TAG_SEPARATOR) -> Column:
    """``split_drop_trailing`` of ``cell``, of which ``stripped`` is already at hand."""
    cell, stripped = col_of(cell), col_of(stripped)
    return (
        F.when(cell == F.lit(""), F.array(F.lit("")))
        .when(stripped == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pattern))
    )


def tag_with_count(tag, n, sep: str = "#") -> Column:
    """``tag#n`` with the count rendered as decimal text."""
    return F.concat(col_of(tag), F.lit(sep), col_of(n).cast("string"))


def render_entries(entries, fmt: str = "hash") -> Column:
    """Render an ordered ``array<struct<n, tag>>`` as one string."""
    if fmt not in RENDERINGS:
        raise ValueError(f"unknown rendering {fmt!r}; use one of {RENDERINGS}")
    e = col_of(entries)
    if fmt == "hash":
        return F.array_join(F.transform(e, lambda x: tag_with_count(x["tag"], x["n"])), ",")
    if fmt == "bracket":
        body = F.array_join(F.transform(e, lambda x: tag_with_count(x["tag"], x["n"])), ", ")
    else:
        body = F.array_join(
            F.transform(e, lambda x: F.concat(x["n"].cast("string"), F.lit("->"), x["tag"])), ", "
        )
    return F.concat(F.lit("["), body, F.lit("]"))


def ranked_entries(n, tag) -> Column:
    """Aggregate expression: the group's (n, tag) pairs, n descending, tag ascending.

    The sort key is ``(-n, tag)`` so ``sort_array`` gives the ranking order;
    use it only on groups already cut to top-k, which bounds the array.
    """
    keyed = F.sort_array(F.collect_list(F.struct((-col_of(n)).alias("k"), col_of(tag).alias("tag"))))
    return F.transform(keyed, lambda x: F.struct((-x["k"]).alias("n"), x["tag"].alias("tag")))
