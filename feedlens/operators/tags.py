"""Tag operators: explode a tag cell, count per group, top-k per group, render.

Scale notes
-----------
* ``explode`` multiplies rows, so callers project to the grouping key and the
  tag cell first; Catalyst prunes every other column out of the scan.
* ``tag_counts`` is a hash aggregate: a partial count per task before the
  shuffle on ``(group, tag)``; a hot tag costs one row per map task.
* ``top_k`` filters a ``row_number`` window; Spark turns this into a
  ``WindowGroupLimit`` that keeps at most k rows per group on the map side
  before the shuffle on the group key, so a category holding most of the
  tags sends at most ``k`` rows per map task to its reducer.
* every list-building operator (``ranked_lists``, ``render_top``, and
  ``windows.running_list``) applies the top-k cut itself, so no group is
  ever collected whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ranked_entries, render_entries, split_keep_empty, split_stripped, strip_trailing
from ..schema import NO_TAGS, TAG_SEPARATOR, TOP_K


def explode_tags(
    df: DataFrame,
    keys: Sequence[str],
    *,
    col: str = "tags",
    pattern: str = TAG_SEPARATOR,
    keep_trailing_empty: bool = True,
    drop_value: str | None = NO_TAGS,
    lower: bool = True,
    out: str = "tag",
) -> DataFrame:
    """One row per tag: ``keys + [out]``.

    The cell is split on ``pattern``; pieces equal to ``drop_value`` are
    dropped *before* lower-casing (so only the exact marker is removed).
    A NULL cell gives no rows.
    """
    if keep_trailing_empty:
        rows = df.select(*keys, F.explode(split_keep_empty(col, pattern)).alias(out))
    else:
        # Trimmed in a projection of its own: the two uses of the trimmed cell read it there.
        cells = df.select(*keys, F.col(col).alias("_cell"), strip_trailing(col, pattern).alias("_stripped"))
        rows = cells.select(*keys, F.explode(split_stripped("_cell", "_stripped", pattern)).alias(out))
    if drop_value is not None:
        rows = rows.filter(F.col(out) != F.lit(drop_value))
    if lower:
        rows = rows.select(*keys, F.lower(F.col(out)).alias(out))
    return rows


def tag_counts(df: DataFrame, keys: Sequence[str], *, tag: str = "tag", out: str = "n") -> DataFrame:
    """Occurrences per ``(keys, tag)`` as BIGINT."""
    return df.groupBy(*keys, tag).agg(F.count(F.lit(1)).alias(out))


def _rank_window(keys: Sequence[str], *, n: str = "n", tag: str = "tag"):
    """Per-group order: count descending, then tag ascending (a total order)."""
    return Window.partitionBy(*keys).orderBy(F.col(n).desc(), F.col(tag).asc())


def top_k(
    df: DataFrame, keys: Sequence[str], k: int = TOP_K, *, n: str = "n", tag: str = "tag", keep_rank: bool = False
) -> DataFrame:
    """The k most frequent tags per group (ties broken by tag text); ``rn`` is the 1-based rank.

    ``row_number`` followed by ``rn <= k`` is planned as ``WindowGroupLimit``
    (partial, before the shuffle on the group key, and final): no task ever
    holds more than k rows of a group per upstream partition, however large
    the group.
    """
    ranked = df.withColumn("rn", F.row_number().over(_rank_window(keys, n=n, tag=tag)))
    ranked = ranked.filter(F.col("rn") <= F.lit(int(k)))
    return ranked if keep_rank else ranked.drop("rn")


def ranked_lists(
    df: DataFrame, keys: Sequence[str], k: int = TOP_K, *, n: str = "n", tag: str = "tag", out: str = "entries"
) -> DataFrame:
    """One row per group: its top-k ``array<struct<n, tag>>`` in rank order (at most k entries)."""
    top = top_k(df, keys, k, n=n, tag=tag)
    return top.groupBy(*keys).agg(ranked_entries(n, tag).alias(out))


def render_top(
    df: DataFrame,
    keys: Sequence[str],
    k: int = TOP_K,
    *,
    fmt: str = "hash",
    n: str = "n",
    tag: str = "tag",
    out: str = "top10_tags",
) -> DataFrame:
    """One row per group with its top-k list rendered as text (see ``functions.RENDERINGS``)."""
    lists = ranked_lists(df, keys, k, n=n, tag=tag, out="_entries")
    return lists.select(*keys, render_entries("_entries", fmt).alias(out))
